"""Operator 11, phrase collocation mining: Toivonen's sampling with a negative border.

Frequent phrases are those with ``least`` occurrences in a language, and a phrase is frequent only if its first and its
last words but one are. A hashed part of the documents proposes phrases (``SAMPLE_LEAST`` occurrences there are enough).
A full pass then counts, exactly and over all documents, the proposed phrases and their negative border: every phrase
whose two parts are proposed but which is not. If phrases of the border turn out frequent, the sample had missed them,
and another full pass counts what they in turn make possible, until no pass finds a new frequent phrase that can be
made longer. So the sample decides how many passes there are (at most one for each length), and never what is found.

The border is never listed. A pass takes the phrases whose parts have their bits set in a table of ``BITS_WORDS``
64-bit words; that bound holds for any number of phrases, so the table is broadcast. Where bits coincide, more phrases
are counted, as exactly as the others. These passes count 64-bit names, whose first two bits tell the number of words.
Phrases that share a name are counted together, so no frequent one is lost; a last pass counts the phrases behind the
frequent names by their words. Tasks add up what they send, so no second sum is made before the shuffle.

Frequent phrases of two words and more are then scored by their worst cut, those that a longer phrase accounts for are
dropped, and the best of each language are ranked by ranges, so that no task sorts a whole language.

Defined results: null text counts as empty, null language as ``und``; ids may be null or repeated, each row counts; a
text of any length is worked through in stretches that overlap by three words; an empty table or one without
frequent phrases gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm import words as W
from cohortflow.llm.common import ship, slices, stored, text_of
from cohortflow.operators.windows import rank_within

LONGEST, LEAST, MOST = 4, 30, 2000
#: A longer phrase with so many percent of a phrase's occurrences accounts for it.
COVERED = 80
#: One in so many documents is in the sample; a phrase that occurs so often there is proposed.
SAMPLE_PART, SAMPLE_LEAST = 4, 5
BITS_WORDS = 1 << 19
#: Names, or different phrases, that a task holds before it sends them on added up, and rows that it sends at once.
HELD, SENT = 1 << 21, 1 << 17
#: Tasks for each core in the last pass. Each task may meet every frequent phrase, so more tasks would send more rows.
TASKS = 3
#: Bytes that are worked through at once; a word is never cut.
TOGETHER = 1 << 20
#: Parts that a language is ranked in first.
PARTS = 64
SEPARATORS = b" \t.,;:!?\n\x0b\x0c\r"
_SEPARATOR, _WORD = re.compile(b"[" + re.escape(SEPARATORS) + b"]"), re.compile(b"[^" + re.escape(SEPARATORS) + b"]+")
_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@cache
def _tables():
    """Of each byte: itself with A to Z lowered, its kind (0 of a word, 1 white space, 2 between pieces), two random numbers."""
    import numpy as np

    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.zeros(256, np.uint8)
    kind[list(SEPARATORS)] = 2
    kind[list(b" \t")] = 1
    return lower, kind, np.random.default_rng(11).integers(1, 2**63, (2, 256)).astype(np.uint64)


def stretches(data: bytes, size: int = TOGETHER) -> Iterator[tuple[bytes, int]]:
    """The text in stretches, each with the next words that a phrase may go on in, and where these begin."""
    at = 0
    while at < len(data):
        end = len(data)
        if at + size < end and (cut := _SEPARATOR.search(data, at + size)):
            end = cut.end()
        tail = end
        for _ in range(LONGEST - 1):
            tail = m.end() if (m := _WORD.search(data, tail)) else len(data)
        yield data[at:tail], end - at
        at = end


class Grams:
    """The words of a stretch and the phrases that begin in it; with ``both``, phrases of one name can be told apart."""

    def __init__(self, data: bytes, own: int, seed: int, both: bool = True):
        import numpy as np

        lower, kind, numbers = _tables()
        byte = lower[np.frombuffer(data + b" ", np.uint8)]
        of = kind[byte]
        inside = np.concatenate([[False], of == 0])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self.own = int(np.searchsorted(starts, own))
        self.count = len(starts)
        if not self.count:
            return
        self.piece = np.cumsum(of == 2)[starts]
        # the words, each with one space after it
        keep = inside[1:].copy()
        keep[ends] = True
        byte[ends] = 32
        self.text = byte[keep]
        self.at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        place = np.arange(len(self.text)) - np.repeat(self.at[:-1], np.diff(self.at))
        power = np.full(int(np.diff(self.at).max()) + 1, 0x5851F42D4C957F2D, np.uint64)
        power[0] = 1
        power = np.cumprod(power)[place]
        # two independent hashes: the first names a phrase, the second tells whether two share a name
        self.word = [W.mixed(np.add.reduceat(n[self.text] * power, self.at[:-1])) for n in numbers[:1 + both]]
        self.sums = [w + np.uint64(seed) for w in self.word]
        self.n = 1

    def ids(self):
        import numpy as np

        return W.mixed(self.sums[0] + np.uint64(self.n * _STEP[0] % 2**64)) >> np.uint64(2) | np.uint64(self.n - 1 << 62)

    def longer(self):
        """Goes from the phrases of n words to those of n + 1."""
        import numpy as np

        self.sums = [s[:-1] * np.uint64(c) + w[self.n:] for s, w, c in zip(self.sums, self.word, _STEP, strict=False)]
        self.n += 1

    def valid(self):
        """Whether the phrase at each word stays in one piece and begins in the stretch itself."""
        k = self.count - self.n + 1
        ok = self.piece[:k] == self.piece[self.n - 1:]
        ok[self.own:] = False
        return ok

    def counted(self, ids, at):
        """First place and number of each distinct phrase among those at the given places."""
        import numpy as np

        name, other = ids[at], self.sums[1][at]
        order = np.argsort(name)
        new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
        if (~new[1:] & (other[order][1:] != other[order][:-1])).any():  # two phrases of one name
            order = np.lexsort((other, name))
            new = np.concatenate([[True], (name[order][1:] != name[order][:-1]) | (other[order][1:] != other[order][:-1])])
        first = np.flatnonzero(new)
        return at[order[first]], np.diff(np.append(first, len(at)))

    def phrases(self, at):
        """The texts of the phrases at the given places, as an Arrow array."""
        import numpy as np
        import pyarrow as pa

        low = self.at[at]
        size = self.at[at + self.n] - 1 - low
        ends = np.cumsum(size)
        out = self.text[np.repeat(low - ends + size, size) + np.arange(int(ends[-1]))]
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(out)])


def _seed(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _by_language(batches) -> Iterator[tuple[str, bytes, int]]:
    """Language, stretch and its own length; texts of a language are put together, each ending the piece before it."""
    for batch in slices(batches):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, some in texts.items():
            for stretch, own in stretches(b"\n".join(some)):
                yield lang, stretch, own


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().cast("binary").alias("text"))


class Held:
    """Names, added up whenever ``HELD`` of them have come together."""

    def __init__(self):
        self.names, self.size = None, 0

    def add(self, ids):
        """Takes names; gives batches to send on."""
        import numpy as np

        if self.names is None:
            self.names = np.empty(HELD, np.uint64)
        while len(ids):
            some = ids[:len(self.names) - self.size]
            self.names[self.size:self.size + len(some)] = some
            self.size += len(some)
            ids = ids[len(some):]
            if self.size == len(self.names):
                yield from self.rest()

    def rest(self):
        import numpy as np
        import pyarrow as pa

        if self.size:
            names = self.names[:self.size]
            names.sort()
            first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
            f = np.diff(first, append=self.size).astype(np.int32)
            id_ = names[first].view(np.int64)
            for at in range(0, len(id_), SENT):
                yield pa.RecordBatch.from_arrays([pa.array(id_[at:at + SENT]), pa.array(f[at:at + SENT])], ["id", "f"])
        self.size = 0


class Phrases:
    """Counts of one language's phrases; the text of each is taken where it is first met."""

    def __init__(self, lang: str):
        self.lang = lang
        self._clear()

    def _clear(self):
        import numpy as np

        self.id, self.row = np.empty(0, np.uint64), np.empty(0, np.int64)  # by name, and the place in the order they came in
        self.other, self.n, self.f = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int64)
        self.text, self.words, self.met = [], 0, []

    def add(self, g: Grams, ids, at):
        import numpy as np

        at, f = g.counted(ids, at)
        name, other = ids[at], g.sums[1][at]
        if len(self.id):
            place = np.minimum(np.searchsorted(self.id, name), len(self.id) - 1)
            row = self.row[place]
            known = (self.id[place] == name) & (self.other[row] == other) & (self.n[row] == g.n)
            self.f[row[known]] += f[known]
            at, f, name, other = (x[~known] for x in (at, f, name, other))
        if len(at):
            self.met.append((name, other, np.full(len(at), g.n, np.int32), f.astype(np.int64)))
            self.text.append(g.phrases(at))

    def settle(self):
        """Puts the phrases first met in a stretch to the known ones."""
        import numpy as np

        if self.met:
            name, other, n, f = (np.concatenate(x) for x in zip(*self.met, strict=True))
            row = np.concatenate([self.row, np.arange(len(self.f), len(self.f) + len(f))])
            self.other, self.n, self.f = (np.concatenate(x) for x in ((self.other, other), (self.n, n), (self.f, f)))
            name = np.concatenate([self.id, name])
            order = np.argsort(name, kind="stable")
            self.id, self.row, self.met = name[order], row[order], []

    def rest(self):
        import pyarrow as pa

        if self.words:  # as a phrase of no word
            yield pa.RecordBatch.from_arrays([pa.array([self.lang], pa.string()), pa.array([""]), pa.array([0], pa.int32()), pa.array([self.words], pa.int64())],
                                             ["lang", "phrase", "n", "f"])
        at = 0
        for text in self.text:
            end = at + len(text)
            yield pa.RecordBatch.from_arrays([pa.array([self.lang] * len(text), pa.string()), text, pa.array(self.n[at:end]), pa.array(self.f[at:end])],
                                             ["lang", "phrase", "n", "f"])
            at = end
        self._clear()


def _frequent_names(docs: DataFrame, counts, least: int) -> DataFrame:
    return (_input(docs).mapInArrow(counts, "id long, f int").repartition("id")
            .groupBy("id").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("id"))


def _words_of(name: str = "id") -> Column:
    """Number of words of the phrases of a name."""
    return F.call_function("shiftrightunsigned", F.col(name), F.lit(62)).cast("int") + 1


def proposed(docs: DataFrame, part: int = SAMPLE_PART, least: int = SAMPLE_LEAST) -> DataFrame:
    """id (name) of the phrases that occur often enough in the sample."""
    some = docs.where(F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(part)) == 0)

    def counts(batches):
        held = Held()
        for lang, stretch, own in _by_language(batches):
            g = Grams(stretch, own, _seed(lang), False)
            for n in range(1, min(LONGEST, g.count) + 1):
                if n > 1:
                    g.longer()
                yield from held.add(g.ids()[g.valid()])
        yield from held.rest()

    return _frequent_names(some, counts, least)


def bits(ids: DataFrame, words: int = BITS_WORDS):
    """A table of ``words`` numbers in which each id sets one bit."""
    import numpy as np

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    rows = ids.groupBy(F.pmod(F.shiftright("id", 6), F.lit(words)).alias("word")).agg(F.bit_or(bit).alias("set")).toArrow()
    out = np.zeros(words, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("set").to_numpy()
    return out.view(np.uint64)


def _has(table, ids):
    import numpy as np

    return (table[(ids >> np.uint64(6)) & np.uint64(len(table) - 1)] >> (ids & np.uint64(63)) & np.uint64(1)).astype(bool)


def full_pass(docs: DataFrame, parts, new=None, least: int = LEAST) -> DataFrame:
    """id of the frequent phrases whose two parts have bits in ``parts``.

    The first pass also counts all words; a further one, with the bits of the phrases ``new`` since, takes those
    phrases of which at least one part is new.
    """
    tables = docs.sparkSession.sparkContext.broadcast((parts, new))

    def counts(batches):
        parts, new = tables.value
        held = Held()
        for lang, stretch, own in _by_language(batches):
            g = Grams(stretch, own, _seed(lang), False)
            below = None
            for n in range(1, min(LONGEST, g.count) + 1):
                if n > 1:
                    g.longer()
                ids, take = g.ids(), g.valid()
                if n > 1:
                    there = _has(parts, below)
                    take &= there[:-1] & there[1:]
                    if new is not None:
                        fresh = _has(new, below)
                        take &= fresh[:-1] | fresh[1:]
                if n > 1 or new is None:
                    yield from held.add(ids[take])
                below = ids
        yield from held.rest()

    return _frequent_names(docs, counts, least)


def by_words(docs: DataFrame, names, least: int = LEAST) -> DataFrame:
    """lang, phrase, n and f of the frequent phrases with bits in ``names``, and as n = 0 the words of each language."""
    sc = docs.sparkSession.sparkContext
    table, tasks = sc.broadcast(names), TASKS * sc.defaultParallelism

    def counts(batches):
        import numpy as np

        held: dict[str, Phrases] = {}
        for lang, stretch, own in _by_language(batches):
            g = Grams(stretch, own, _seed(lang))
            if not g.count:
                continue
            of = held.setdefault(lang, Phrases(lang))
            of.words += g.own
            for n in range(1, min(LONGEST, g.count) + 1):
                if n > 1:
                    g.longer()
                ids = g.ids()
                at = np.flatnonzero(g.valid() & _has(table.value, ids))
                if len(at):
                    of.add(g, ids, at)
            of.settle()
            if sum(len(p.id) for p in held.values()) >= HELD // 2:
                for p in held.values():
                    yield from p.rest()
        for p in held.values():
            yield from p.rest()

    return (_input(docs).coalesce(tasks).mapInArrow(counts, "lang string, phrase string, n int, f long").repartition("lang", "phrase")
            .groupBy("lang", "phrase", "n").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("n") == 0)))


def frequent_phrases(docs: DataFrame, least: int = LEAST, part: int = SAMPLE_PART, sample_least: int = SAMPLE_LEAST,
                     words: int = BITS_WORDS) -> DataFrame:
    """lang, phrase, n (words) and f of all frequent phrases of up to four words; n = 0: the words of the language."""
    ship(docs.sparkSession)
    candidates = stored(proposed(docs, part, sample_least))
    found = stored(full_pass(docs, bits(candidates, words), None, least))
    new = stored(found.join(candidates, "id", "left_anti"))  # the border's failures
    while not new.where(_words_of() < LONGEST).isEmpty():
        more = full_pass(docs, bits(found, words), bits(new, words), least)
        new = stored(more.join(found, "id", "left_anti"))
        found = found.unionByName(new)
    return by_words(docs, bits(found, words), least)


def _exact(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, covered: int = COVERED, **sampling) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``most`` phrases."""
    frequent = stored(frequent_phrases(docs, least, **sampling))
    known = frequent.where("n > 0")
    w, n = F.split("phrase", " "), F.col("n")
    join = lambda start, size: F.array_join(F.slice(w, start, size), " ")
    cuts = (known.where("n > 1").select("lang", "phrase", "n", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("head"), join(F.col("k") + 1, n).alias("rest")))
    part = lambda name, f: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    score = F.call_function("div", _exact(F.lit(2000000)) * _exact(F.col("a")), _exact(F.col("l")) + _exact(F.col("r")))
    scored = (cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: join(i, m))))
    longer = (known.where("n > 2").select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("top")))
    kept = (scored.join(longer, ["lang", "phrase"], "left")
            .where(F.col("top").isNull() | (_exact(F.lit(100)) * _exact(F.col("top")) < _exact(F.lit(covered)) * _exact(F.col("a")))))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = rank_within(best.drop("rank"), "lang", order, "rank").where(F.col("rank") <= most)
    totals = stored(frequent.where("n = 0").select("lang", F.col("f").alias("total")))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"),
                                              F.col("score").cast("long").alias("score"))
