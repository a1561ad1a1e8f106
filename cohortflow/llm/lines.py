"""Operator 6, line dedup: segment-partition edit join.

Lines within so many edits of one another are linked: one for each ``PER_EDIT`` code points of the shorter line, up to
``EDITS``. Of linked lines the first occurrence, by doc_id and place, stays. If a line is cut into one segment more than
it has edits, a line within these edits has one of the segments unchanged, at a place that is off by little. So each
line is put under its own segments and under the substrings of it that can be a segment of a line as long or a few
edits shorter (the multi-match-aware places). Pairs under one key whose lengths and character counts allow it are
verified by a banded bit-parallel edit distance. Keys of any number of lines are worked through by ``linking``, without
all pairs and without a cap.

All lines with a character that is not white space take part; those of less than ``PER_EDIT`` code points are linked
with equal lines only. Blank lines are left alone. Keys and character counts are made once for each different line.
Lines are told apart by a 64-bit hash.

Defined results: null text counts as empty and stays as it is given; a text ends as its remaining lines joined by
line feeds, and may become empty, but its row stays; null ids come last in the order; rows equal in id and text
are one document and are cut alike; an empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import words as W
from cohortflow.llm.common import guarded, marked, only_marked, ship, slices, stored, text_of
from cohortflow.llm.linking import by_block, linked

EDITS, PER_EDIT = 2, 10
SOME = r"[^ \t\n\x0B\f\r]"
#: Lines hashed at once: so many code points, or one line.
TOGETHER = 1 << 20
_BASE = 0x5851F42D4C957F2D


def segments(size, edits: int):
    """Start and length of each segment of lines of these sizes: as equal as can be, the longer ones last."""
    n = edits + 1
    short, longer = size // n, size % n
    for i in range(n):
        extra = longer - (n - i)
        yield i * short + extra * (extra > 0), short + (extra >= 0)


def allowed(size, edits: int):
    """The edits by which a line may differ from a longer one (a number, or an array of them)."""
    import numpy as np

    return np.minimum(edits, size // PER_EDIT)


def places(size, edits: int):
    """For lines of these sizes: length of the partner, number of the segment, and start and length of the
    substring that could be that segment; with a mask of the lines that have it."""
    for e in range(1, edits + 1):
        for less in range(e + 1):
            fits = allowed(size - less, edits) == e
            for i, (start, width) in enumerate(segments(size - less, e)):
                for off in range(max(-i, less - (e - i)), min(i, less + e - i) + 1):
                    yield size - less, i, start + off, width, fits & (start + off >= 0) & (start + off + width <= size)


def within(a: str, b: str, edits: int) -> bool:
    """Whether b is at most so many edits from a.

    One small integer for each number of edits holds the diagonals reached; a character of ``a`` moves all of
    them at once, and diagonals further off than the edits are not looked at.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    end = 0
    while end < high - low and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[low:len(a) - end], b[low:len(b) - end]
    full = (1 << (2 * edits + 1)) - 1  # bit d: b is d - edits characters ahead
    reached = [0] * (edits + 1)
    reached[0] = 1 << edits
    for e in range(1, edits + 1):
        reached[e] = reached[e - 1] | reached[e - 1] << 1 & full
    for i, ch in enumerate(a):
        same = 0
        for d in range(max(0, edits - i), min(2 * edits, len(b) - 1 - i + edits) + 1):
            if b[i + d - edits] == ch:
                same |= 1 << d
        before, below = 0, 0
        for e in range(edits + 1):
            now = reached[e]
            # a match, a change, a character of a left out, one of b put in
            reached[e] = now & same | before | before >> 1 | below << 1 & full
            before, below = now, reached[e]
        if not below:
            return False
    return bool(reached[edits] >> (len(b) - len(a) + edits) & 1)


def _grouped(lines: list[str]):
    start = size = 0
    for i, t in enumerate(lines):
        if size and size + len(t) > TOGETHER:
            yield lines[start:i]
            start, size = i, 0
        size += len(t)
    if lines:
        yield lines[start:]


def keys(lines: list[str], ids, edits: int):
    """bucket and id of each substring of the lines that is looked up."""
    import numpy as np

    out_b, out_i, at = [], [], 0
    for some in _grouped(lines):
        code = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size = np.fromiter(map(len, some), np.int64, len(some))
        begin = np.cumsum(size) - size
        own = np.asarray(ids[at:at + len(some)], np.int64)
        at += len(some)
        up, down = np.full(len(code) + 1, _BASE, np.uint64), np.full(len(code) + 1, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mixed(code + np.uint64(1)) * up[:-1])])
        for partner, i, start, width, there in places(size, edits):
            low = (begin + start)[there]
            h = (total[low + width[there]] - total[low]) * down[low]
            h ^= W.mixed(partner[there].astype(np.uint64) * np.uint64(64) + np.uint64(i + 1))
            out_b.append(W.mixed(h).view(np.int64))
            out_i.append(own[there])
    return (np.concatenate(out_b), np.concatenate(out_i)) if out_b else (np.empty(0, np.int64), np.empty(0, np.int64))


def signature(lines: list[str]):
    """The number of characters of each of 16 kinds, modulo 256, as two 64-bit numbers for each line."""
    import numpy as np

    out = [np.zeros((0, 2), np.int64)]
    for some in _grouped(lines):
        code = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        kind = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(60)).astype(np.int64)
        of = np.repeat(np.arange(len(some)), np.fromiter(map(len, some), np.int64, len(some)))
        out.append((np.bincount(of * 16 + kind, minlength=16 * len(some)) % 256).astype(np.uint8).reshape(-1, 16).view(np.int64))
    return np.concatenate(out)


def _split(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), line (its number) and x of each line that is not blank."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("row"), F.posexplode(F.split(text_of(), "\n", -1)).alias("line", "x"))
    return rows.where(F.col("x").rlike(SOME))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, row, line and id of each line that is not blank."""
    return _split(docs).select("doc_id", "row", "line", F.xxhash64("x").alias("id"))


def different_lines(docs: DataFrame) -> DataFrame:
    """id and x of each different line that may be linked with another one."""
    return _split(docs).where(F.length("x") >= PER_EDIT).select(F.xxhash64("x").alias("id"), "x").distinct()


def described(different: DataFrame, edits: int) -> DataFrame:
    """id, n (code points), s0 and s1 (signature) and buckets of each line."""

    def found(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches, 5000):
            texts = batch.column("x").to_pylist()
            signs = signature(texts)
            bucket, of = keys(texts, np.arange(len(texts)), edits)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.fromiter(map(len, texts), np.int32, len(texts))), pa.array(signs[:, 0]), pa.array(signs[:, 1]),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bucket[order]))], ["id", "n", "s0", "s1", "buckets"])

    return different.mapInArrow(found, "id long, n int, s0 long, s1 long, buckets array<long>")


def near_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """id and comp of the lines that may have a partner within the edits."""
    different = stored(different_lines(docs))
    about = stored(described(different, edits))
    signs = about.drop("buckets")

    def plausible(x, y):
        # each edit changes two counts by one at most; counts are modulo 256
        apart = F.lit(0)
        for s in ("s0", "s1"):
            for k in range(0, 64, 8):
                d = F.abs(F.shiftrightunsigned(x(s), k).bitwiseAND(F.lit(255)) - F.shiftrightunsigned(y(s), k).bitwiseAND(F.lit(255)))
                apart = apart + F.least(d, 256 - d)
        most = F.least(F.lit(edits), F.floor(F.least(x("n"), y("n")) / PER_EDIT))
        return (F.abs(x("n") - y("n")) <= most) & (apart <= 2 * most)

    def texts(ids: DataFrame) -> DataFrame:
        ids = stored(ids.distinct())
        return stored(only_marked(different, "id", ids).join(ids.toDF("id"), "id").select("id", "x"))

    def linked_pairs(pairs: DataFrame) -> DataFrame:
        def verified(batches):
            import pyarrow as pa

            for batch in batches:
                near = [within(x, y, int(allowed(min(len(x), len(y)), edits)))
                        for x, y in zip(batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist(), strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

        lines = texts(pairs.select(F.explode(F.array("a", "b")).alias("key")))
        return (pairs.join(lines.toDF("a", "line_a"), "a").join(lines.toDF("b", "line_b"), "b")
                .select("a", "b", "line_a", "line_b").mapInArrow(verified, "a long, b long"))

    def linked_blocks(rows: DataFrame) -> DataFrame:
        lines = texts(rows.select(F.col("id").alias("key")))
        return (rows.join(signs, "id").join(lines.withColumnRenamed("x", "line"), "id").repartition("block").sortWithinPartitions("block")
                .mapInArrow(lambda batches: _block_links(batches, edits), "a long, b long"))

    return linked(about.select(F.explode("buckets").alias("bucket"), "id"), signs, plausible, linked_pairs, linked_blocks)


def _block_links(batches, edits: int):
    """Links of the strays of each block, one for each component that a stray is linked with."""
    import numpy as np
    import pyarrow as pa

    for t in by_block(batches):
        ids, comp, n = (t.column(c).to_numpy() for c in ("id", "comp", "n"))
        counts = np.stack([t.column(c).to_numpy() for c in ("s0", "s1")], axis=1).view(np.uint8)
        stray, text = np.asarray(t.column("stray")), t.column("line").to_pylist()
        rows, out = np.flatnonzero(~stray), []
        for x in np.flatnonzero(stray):
            apart = counts[rows] - counts[x]
            most = allowed(np.minimum(n[rows], n[x]), edits)
            near = (comp[rows] != comp[x]) & (abs(n[rows] - n[x]) <= most) & (np.minimum(apart, -apart).sum(axis=1, dtype=int) <= 2 * most)
            joined = set()
            for y, e in zip(rows[near], most[near].tolist(), strict=True):
                if comp[y] not in joined and within(text[x], text[y], e):
                    joined.add(comp[y])
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])


def dropped_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, row and gone (numbers of the lines that go) of each document that loses lines."""
    seen = stored(occurrences(docs))
    comp = near_lines(docs, edits)
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("line"))
    lines = stored(seen.join(comp, "id", "left").select("doc_id", "row", "line", F.coalesce("comp", "id").alias("comp")))
    several = stored(lines.groupBy("comp").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return (lines.join(several, "comp").where(place != F.col("first"))
            .groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("line")).alias("gone")))


def line_dedup(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents with ``text`` cut, and n_lines and n_dropped; all other columns stay."""
    ship(docs.sparkSession)
    docs, back = guarded(docs, ("doc_id", "text"), ("n_lines", "n_dropped"))
    gone = stored(dropped_lines(docs, edits))
    rows = docs.withColumns({"n_lines": F.size(F.split(text_of(), "\n", -1)).cast("long"), "__row": F.xxhash64(text_of())})
    rows = marked(rows, "__row", gone.select(F.col("row").alias("key")), "__may")
    names = [c for c in rows.columns if c not in ("__row", "__may")]
    whole = rows.where(~F.col("__may")).select(*names, F.lit(0).cast("long").alias("n_dropped"))
    r, g = rows.where("__may").alias("r"), gone.alias("g")
    cut = (r.join(g, (F.col("r.__row") == F.col("g.row")) & F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")), "left")
           .select(*(F.col(f"r.{c}") for c in names), F.col("g.gone").alias("gone")))

    def shortened(batches):
        import pyarrow as pa

        for batch in slices(batches):
            texts, counts = [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                if gone:
                    out = set(gone)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)
                texts.append(text)
                counts.append(len(gone or ()))
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            at = batch.schema.get_field_index("gone")
            yield batch.remove_column(at).append_column("n_dropped", pa.array(counts, pa.int64()))

    return back(whole.unionByName(cut.mapInArrow(shortened, whole.schema)), "n_lines", "n_dropped")
