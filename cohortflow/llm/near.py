"""Operator 4, MinHash near-dedup with odd sketches.

A document is the set of its word shingles. Documents of equal sets are one class; a class has one member that
stands for it. ``BANDS`` times ``ROWS`` MinHash samples give each class a bucket for each band, so classes of
similarity 0.8 share none with a chance of ten in a million (the square of that for 0.85). The same samples are
folded into an odd sketch: a bitmap in which each sample flips one bit. The bits in which two sketches differ tell
high similarities precisely, so pairs of a bucket that differ in more than ``MOST_BITS`` bits (similarity 0.8 does
not with a chance of one in a billion) need no further look. The others are confirmed on their full sets.
Buckets of any size are worked through by ``linking``, without all pairs and without a cap.

Defined results: null text, empty text and text without a word have an empty set, linked with nothing; rows of one id
with different sets are different documents; rows equal in id and set go the same way in ``near_duplicates``, and
``one_of_each`` leaves one of them; a null id links with nothing, its component is null and its row stays; equal
texts are always linked; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import words as W
from cohortflow.llm.common import guarded, marked, only_marked, ship, slices, stored, text_of
from cohortflow.llm.linking import by_block, linked

BANDS, ROWS = 40, 6
BITS, MOST_BITS = 512, 150
SEED = 4


@cache
def _numbers():
    """For each sample what its hash of a shingle adds and multiplies by, and a number to tell samples apart."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    n = BANDS * ROWS
    return (rng.integers(0, 2**32, n, np.uint64).astype(np.uint32), (rng.integers(0, 2**31, n, np.uint64) * 2 + 1).astype(np.uint32),
            rng.integers(0, 2**63, n).astype(np.uint64))


def samples(shingles):
    """The MinHash samples of a set (uint32)."""
    import numpy as np

    plus, times, _ = _numbers()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(plus), 2**32 - 1, np.uint32)
    for low in range(0, len(x), 128):
        h = x[low:low + 128, None] ^ plus
        h *= times
        np.minimum(least, h.min(axis=0), out=least)
    return least


def bands(least):
    """A bucket for each band."""
    import numpy as np

    out = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        out = W.mixed(out * np.uint64(0x9E3779B97F4A7C15) + least[k::ROWS][:BANDS])
    return out.view(np.int64)


def odd_sketch(least):
    """The parity of the number of samples that fall on each of BITS bits, as 64-bit numbers."""
    import numpy as np

    at = W.mixed(least.astype(np.uint64) ^ _numbers()[2]) % np.uint64(BITS)
    odd = np.bincount(at.astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def features(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, row (hash of id and text), key (of the set), n_shingles, bands and sketch of each document."""
    ship(docs.sparkSession)

    def made(batches):
        import pyarrow as pa
        import xxhash

        for batch in slices(batches):
            keys, sizes, of, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = W.shingle_set(text, words)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                least = samples(s) if len(s) else None
                of.append(bands(least) if len(s) else [])
                sketches.append(odd_sketch(least) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(of, pa.list_(pa.int64())),
                 pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "row", "key", "n_shingles", "bands", "sketch"])

    return _rows(docs).mapInArrow(made, "doc_id long, row long, key binary, n_shingles long, bands array<long>, sketch array<long>")


def _row() -> Column:
    """A hash of id and text, which tells rows apart."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_of())


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), _row().alias("row"), text_of().alias("text"))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets have den * intersection >= num * union. ``texts`` has id and text."""

    def links(batches):
        import numpy as np
        import pyarrow as pa

        last: dict[int, object] = {}
        for batch in slices(batches):
            keep = []
            for a, b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                sets = []
                for i, t in ((a, text_a), (b, text_b)):
                    if i not in last:
                        if len(last) > 64:
                            last.clear()
                        last[i] = W.shingle_set(t, words)
                    sets.append(last[i])
                same = len(np.intersect1d(*sets, assume_unique=True))
                keep.append(den * same >= num * (len(sets[0]) + len(sets[1]) - same))
            kept = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield kept

    return (pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
            .select("a", "b", "text_a", "text_b").mapInArrow(links, "a long, b long"))


def _block_links(batches, words: int, num: int, den: int):
    """Links of the strays of each block, one for each component that a stray is linked with.

    A pair that shares several buckets is tried in that of their first common band alone.
    """
    import numpy as np
    import pyarrow as pa

    for t in by_block(batches):
        ids, comp, n = (t.column(c).to_numpy() for c in ("id", "comp", "n"))
        sketch, band = (np.stack(t.column(c).to_numpy()) for c in ("sketch", "bands"))
        stray = np.asarray(t.column("stray"))
        bucket = t.column("bucket")[0].as_py()
        sets = [W.shingle_set(x, words) for x in t.column("text").to_pylist()]
        rows, out = np.flatnonzero(~stray), []
        for x in np.flatnonzero(stray):
            near = ((comp[rows] != comp[x]) & (den * np.minimum(n[rows], n[x]) >= num * np.maximum(n[rows], n[x]))
                    & (np.bitwise_count(sketch[rows] ^ sketch[x]).sum(axis=1) <= MOST_BITS))
            some = rows[near]
            same = band[some] == band[x]
            some = some[band[x][same.argmax(axis=1)] == bucket]
            if not len(some):
                continue
            every = np.concatenate([sets[y] for y in some])
            at = np.minimum(np.searchsorted(sets[x], every), len(sets[x]) - 1)
            both = np.bincount(np.repeat(np.arange(len(some)), [len(sets[y]) for y in some]), sets[x][at] == every, len(some))
            hit = some[den * both >= num * (n[some] + n[x] - both)]
            for y in hit[np.unique(comp[hit], return_index=True)[1]]:
                out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])


def _classed(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """doc_id, row, n_shingles, component_id and comp (a number of the component; null without a set or id) of each document."""
    feats = stored(features(docs, words))
    some = feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # each class gets a number; the row of its least id stands for it
    classes = stored(some.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.first("n_shingles").alias("n"),
                                             F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                     .select("key", "rep.doc_id", "rep.row", "n", "bands", "sketch", F.monotonically_increasing_id().alias("id")))
    members = classes.select(F.explode("bands").alias("bucket"), "id")
    signs = classes.select("id", "n", *(F.col("sketch")[k].alias(f"s{k}") for k in range(BITS // 64)))

    def plausible(x, y):
        bits = sum((F.bit_count(x(f"s{k}").bitwiseXOR(y(f"s{k}"))) for k in range(1, BITS // 64)), F.bit_count(x("s0").bitwiseXOR(y("s0"))))
        return (den * F.least(x("n"), y("n")) >= num * F.greatest(x("n"), y("n"))) & (bits <= MOST_BITS)

    def texts(ids: DataFrame) -> DataFrame:
        wanted = stored(classes.select("id", "row").join(ids.distinct(), "id"))
        rows = only_marked(_rows(docs).select("row", "text"), "row", wanted.select(F.col("row").alias("key")))
        return stored(rows.join(wanted, "row").select("id", "text").dropDuplicates(["id"]))

    def linked_pairs(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, texts(pairs.select(F.explode(F.array("a", "b")).alias("id"))), words, num, den)

    def linked_blocks(rows: DataFrame) -> DataFrame:
        about = classes.select("id", "n", "sketch", "bands").join(texts(rows.select("id")), "id")
        return (rows.join(about, "id").repartition("block").sortWithinPartitions("block")
                .mapInArrow(lambda batches: _block_links(batches, words, num, den), "a long, b long"))

    comp = linked(members, signs, plausible, linked_pairs, linked_blocks)
    to = stored(classes.select("key", "id", "doc_id").join(comp, "id", "left").select("key", "doc_id", F.coalesce("comp", "id").alias("comp")))
    least = to.groupBy("comp").agg(F.min("doc_id").alias("least"))
    of = stored(to.select("key", "comp").join(least, "comp"))
    f = feats.select("doc_id", "row", "key", "n_shingles").join(of, "key", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return f.select("doc_id", "row", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
                    F.when(~alone, F.col("comp")).alias("comp"))


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document: linked where den * intersection >= num * union."""
    return _classed(docs, words, num, den).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents without those that another one stands for: of each component the row with the least id stays."""
    docs, back = guarded(docs, ("doc_id", "text"))
    found = stored(_classed(docs, words, num, den).where("comp IS NOT NULL").groupBy("comp", "doc_id", "row").agg(F.count(F.lit(1)).alias("n")))
    first = found.groupBy("comp").agg(F.min(F.struct("doc_id", "row"))["row"].alias("first"), F.sum("n").alias("n"))
    several = stored(first.where("n > 1"))
    # of the documents of such components those go that are not the first; of rows equal to the first one stays
    gone = stored(found.select("comp", "row").join(several, "comp").select("row", (F.col("row") == F.col("first")).alias("stays")))
    rows = marked(docs.withColumn("__row", _row()), "__row", gone.select(F.col("row").alias("key")), "__may")
    may = rows.where("__may").drop("__may")
    others = may.join(gone.select(F.col("row").alias("__row")), "__row", "left_anti")
    firsts = may.join(gone.where("stays").select(F.col("row").alias("__row")), "__row", "left_semi").dropDuplicates(["__row"])
    whole = rows.where(~F.col("__may")).drop("__may")
    return back(whole.unionByName(others).unionByName(firsts))
