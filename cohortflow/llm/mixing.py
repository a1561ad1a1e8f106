"""Operator 1, mixing sources to target weights: token blocks, multinomial draws, index permutations.

The words of each source, its documents in a seeded random order, are packed into blocks of ``BLOCK`` words.
Each output shard draws from a multinomial how many of its slots each source fills; the weights are what is
still due from each source, so the draws of all shards add up to the targets. The t-th slot of a source is
mapped through a pseudorandom permutation of the source's block numbers, another one for each pass over the
source, and the blocks are joined by number. A target is twice its source at most, so no block is taken more
than twice.

Two tables go through the driver: one row for each source, and shards times sources numbers. Documents, blocks
and slots do not. The place of a document in its source is found by sums within hashed parts of the source and
sums of the parts, so a source may hold any share of the rows.

Defined results: null text has no words; a document without words is taken 0 times; null source is a source of
its own, the last by order; null and repeated ids are allowed, repeated rows each have their place; an empty
table gives an empty result; other columns are ignored by ``mixed`` and kept by ``placed``. Columns that start
with ``__`` are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import partitions, ship, slices, stored, text_of

BLOCK = 128
SHARDS = 256
SEED = 1
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words due from each source: ``share`` of all words by weight, at most ``most`` times a source's size.

    What is above goes to the other sources by weight, until none is above.
    """
    due = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                due[i] = left * weights[i] / total
            break
        for i in full:
            due[i] = most * sizes[i]
            left -= due[i]
        open_ = [i for i in open_ if i not in set(full)]
    return due


def permuted(index, size, key):
    """Where a pseudorandom permutation of range(size), chosen by key, puts each index (arrays of uint64).

    A Feistel network over the least power of four that holds the range; values outside go round again.
    """
    import numpy as np

    one = np.uint64(1)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(2, size).astype(float)) / 2)).astype(np.uint64)
    while (short := (one << (half + half)) < size).any():  # log2 is inexact
        half = half + short
    low = (one << half) - one
    out = index.copy()
    todo = np.arange(len(index))
    while len(todo):
        x, h, m = out[todo], half[todo], low[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            f = (right + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)) ^ key[todo]
            for by, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                f = (f ^ (f >> np.uint64(by))) * np.uint64(times)
            left, right = right, left ^ ((f >> np.uint64(31)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out


def draws(due: list[int], shards: int, seed: int):
    """Slots that each shard (row) takes from each source (column): multinomials of what is still due.

    A draw above what is due is cut to it and the rest drawn again from the others; the last shard takes the rest.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    left = np.asarray(due, np.int64)
    out = np.zeros((shards, len(due)), np.int64)
    for k in range(shards - 1):
        open_ = -(-int(left.sum()) // (shards - k))
        while open_:
            got = np.minimum(rng.multinomial(open_, left / left.sum()), left)
            out[k] += got
            left = left - got
            open_ -= int(got.sum())
    out[shards - 1] = left
    return out


def placed(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents with __source (number), __begin (words of the source before it), size, source_size and target;
    and the sources: __source, source, source_size, target, __blocks, __due (blocks). All other columns stay.
    """
    spark = docs.sparkSession
    rows = docs.withColumns({"size": F.regexp_count(text_of(), F.lit(WORD)).cast("long"),
                             "__h": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))})
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(((r["source"], r["size"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [s for _, s in found]
    due = targets(sizes, [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(found))])
    blocks = [-(-s // BLOCK) for s in sizes]
    table = spark.createDataFrame(
        [(i, name, s, t, b, round(t * b / s) if s else 0) for i, ((name, s), t, b) in enumerate(zip(found, due, blocks, strict=True))],
        f"__source int, source {docs.schema['source'].dataType.simpleString()}, source_size long, target double, __blocks long, __due long")
    parts = 4 * partitions(docs)
    rows = rows.withColumn("__part", F.pmod("__h", F.lit(parts)))
    sums = rows.groupBy("source", "__part").agg(F.sum("size").alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s, t = sums.withColumn("__before", before).alias("s"), table.alias("t")
    offsets = stored(s.join(t, F.col("s.source").eqNullSafe(F.col("t.source")))
                     .select("t.__source", "t.source", "t.source_size", "t.target", "s.__part", "s.__before"))
    inside = F.sum("size").over(Window.partitionBy("source", "__part").orderBy("__h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    r, o = rows.withColumn("__in", inside - F.col("size")).alias("r"), offsets.alias("o")
    kept = [F.col(f"r.{c}") for c in rows.columns if c not in ("__h", "__part")]
    out = (r.join(o, F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("r.__part") == F.col("o.__part")))
           .select(*kept, "o.__source", "o.source_size", "o.target", (F.col("r.__in") + F.col("o.__before")).alias("__begin")))
    return out, table


def slots(sources: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """shard, slot (in its shard), __source, epoch and block of each slot of the mix."""
    import numpy as np

    spark = sources.sparkSession
    ship(spark)
    known = sorted(sources.select("__source", "__blocks", "__due").collect())
    taken = draws([r["__due"] for r in known], shards, seed) if known else np.zeros((shards, 0), np.int64)
    ends = np.cumsum(taken.ravel())
    plan = spark.sparkContext.broadcast((taken.ravel(), ends, (np.cumsum(taken, axis=0) - taken).ravel(),
                                         np.asarray([r["__blocks"] for r in known], np.int64)))

    def mapped(frames):
        import numpy as np
        import pandas as pd

        counts, ends, starts, blocks = plan.value
        for pdf in frames:
            at = pdf["id"].to_numpy()
            cell = np.searchsorted(ends, at, "right")
            shard, source = cell // len(blocks), cell % len(blocks)
            slot = at - np.concatenate([[0], ends])[shard * len(blocks)]
            turn = starts[cell] + at - (ends[cell] - counts[cell])
            size = blocks[source]
            epoch = turn // size
            key = (np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) ^ (source.astype(np.uint64) << np.uint64(8) | epoch.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            block = permuted((turn % size).astype(np.uint64), size.astype(np.uint64), key)
            yield pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot, "__source": source.astype(np.int32),
                                "epoch": epoch.astype(np.int32), "block": block.astype(np.int64)})

    total = int(ends[-1]) if len(ends) else 0
    return spark.range(0, total, 1, max(1, min(4 * partitions(sources), -(-total // 10_000)))).mapInPandas(
        mapped, "shard int, slot long, __source int, epoch int, block long")


def pieces(rows: DataFrame) -> DataFrame:
    """__source, block, __begin, first and words of each document's share in each block: words first to first + words - 1 of the document."""
    b, low = F.col("block"), F.col("__begin")
    return (rows.where("size > 0")
            .select("__source", "__begin", "size", F.explode(F.sequence(F.floor(low / BLOCK), F.floor((low + F.col("size") - 1) / BLOCK))).alias("block"))
            .select("__source", "block", "__begin", (F.greatest(low, b * BLOCK) - low).alias("first"),
                    (F.least(low + F.col("size"), (b + 1) * BLOCK) - F.greatest(low, b * BLOCK)).alias("words")))


def mixed(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes, repeats counted) of each document."""
    rows, sources = placed(docs.select("doc_id", "source", "text"), seed)
    rows = stored(rows.drop("text"))
    times = slots(sources, shards, seed).groupBy("__source", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (pieces(rows).join(times, ["__source", "block"])
             .groupBy("__source", "__begin").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
             .withColumn("__some", F.lit(True)))
    # a document without words shares its place with the next one
    return (rows.withColumn("__some", F.col("size") > 0).join(taken, ["__source", "__begin", "__some"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix as documents (doc_id, text, lang, source, n_chars): what the first pass over its source takes of a
    document, and what the second takes. Words stay as they are, with the white space between them where nothing
    is left out, and one space where something is; a document taken as a whole keeps its text. What is not taken goes.
    """
    ship(docs.sparkSession)
    rows, sources = placed(docs.select("doc_id", "text", "lang", "source"), seed)
    drawn = slots(sources, shards, seed)
    spans = (pieces(rows).join(drawn, ["__source", "block"])
             .groupBy("__source", "__begin").agg(F.sort_array(F.collect_list(F.struct("epoch", "first", "words"))).alias("spans"))
             .withColumn("__some", F.lit(True)))

    joined = (rows.where("size > 0").withColumn("__some", F.lit(True)).join(spans, ["__source", "__begin", "__some"])
              .select("doc_id", "text", "lang", "source", "spans"))
    names = ["doc_id", "text", "lang", "source", "n_chars"]

    def cut(batches):
        import re

        import pyarrow as pa

        word = re.compile(WORD)
        for batch in slices(batches):
            schema = pa.schema([*(batch.schema.field(c) for c in names[:4]), pa.field("n_chars", pa.int64())])
            out = []
            for r in batch.to_pylist():
                at = [m.span() for m in word.finditer(r["text"])]
                by: dict[int, list[list[int]]] = {}
                for s in r["spans"]:
                    runs = by.setdefault(s["epoch"], [])
                    if runs and runs[-1][1] == s["first"]:
                        runs[-1][1] += s["words"]
                    else:
                        runs.append([s["first"], s["first"] + s["words"]])
                for _, runs in sorted(by.items()):
                    whole = runs == [[0, len(at)]]
                    text = r["text"] if whole else " ".join(r["text"][at[a][0]:at[b - 1][1]] for a, b in runs)
                    out.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=schema)

    return joined.mapInArrow(cut, ", ".join(f"{c} {t}" for c, t in joined.drop("spans").dtypes) + ", n_chars long")
