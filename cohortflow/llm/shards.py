"""Operator 8, sharding: a two-pass external shuffle [native].

Pass 1 scatters the records by a seeded hash into buckets of about ``bucket_bytes``. Pass 2 puts each bucket
into the order of a Fisher-Yates permutation (Spark's ``shuffle`` function, one generator for each bucket).
The buckets in a row are one random order of all records; it is cut into shards whose counts differ by one
at most (law ``rows``), so a shard is a run of whole buckets but for its ends.

The registered query moves whole documents: it writes the shards to the shared folder and reads from them what it
returns. Records are shuffled once, by bucket; counts, permutations and offsets have a row for each bucket.

Defined results: null text has no bytes and CRC 0; a null id is hashed as null; rows equal in id and text are
interchangeable, each gets its own place; an empty table gives an empty result; other columns are carried
along untouched by ``external_shuffle`` and ignored by ``shard_table``. Columns that start with ``__`` are
the operator's own.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow import session
from cohortflow.llm.common import guarded, stored, text_of

SEED = 20_261_204
SHARDS = 16
BUCKET_BYTES = 32 << 20
#: Buckets whose offsets are summed up together; the sums of these runs are summed up in a second step.
RUN = 1024


def external_shuffle(rows: DataFrame, rows_total: int, bytes_total: int, keys: list[str], shards: int = SHARDS,
                     seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``rows`` with shard (int), slot (long, gapless from 0 in each shard) and bucket (long).

    ``keys`` identify a record; ``rows_total`` and ``bytes_total`` are the table's (two numbers).
    """
    spark = rows.sparkSession
    buckets = max(1, math.ceil(bytes_total / bucket_bytes))
    # pass 1: scatter
    scattered = rows.withColumn("__h", F.xxhash64(F.lit(seed), *keys)).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "__h"), F.lit(buckets)))
    counts = stored(scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("__n")))
    largest = counts.agg(F.max("__n")).first()[0] or 1
    # pass 2: one permutation for each bucket; range() gives each bucket a partition, and so a generator, of its own
    order = spark.range(0, buckets, 1, buckets).select(
        F.col("id").alias("bucket"), F.expr(f"shuffle(sequence(0L, {largest - 1}L), {seed}L)").alias("__perm"))
    # the place of each rank
    at = F.array_sort(F.transform(F.filter("__perm", lambda v: v < F.col("__n")), lambda v, i: F.struct(v.alias("rank"), i.alias("place"))))
    order = order.join(counts, "bucket").select("bucket", at["place"].alias("__places"))
    ranked = scattered.withColumn(
        "__rank", F.row_number().over(Window.partitionBy("bucket").orderBy("__h", *keys)).cast("long") - 1)
    # where each bucket begins: sums within runs of buckets, then over the runs
    run = F.floor(F.col("bucket") / RUN)
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_run = counts.withColumn("__run", run).withColumn("__in", before(Window.partitionBy("__run").orderBy("bucket"), "__n"))
    runs = (counts.groupBy(run.alias("__run")).agg(F.sum("__n").alias("__sum"))
            .select("__run", before(Window.orderBy("__run"), "__sum").alias("__before")))
    begins = in_run.join(runs, "__run").select("bucket", (F.col("__in") + F.col("__before")).alias("__begin"))
    placed = (ranked.join(order.join(begins, "bucket"), "bucket")
              .withColumn("__p", F.col("__begin") + F.get("__places", F.col("__rank").cast("int"))).drop("__places"))
    # the first `more` shards have one row more than the others
    least, more = divmod(rows_total, shards)
    edge = more * (least + 1)
    low, p = F.col("__p") < edge, F.col("__p")
    return (placed
            .withColumn("shard", F.when(low, F.floor(p / (least + 1))).otherwise(more + F.floor((p - edge) / max(1, least))).cast("int"))
            .withColumn("slot", F.when(low, p % (least + 1)).otherwise((p - edge) % max(1, least)).cast("long"))
            .drop("__h", "__rank", "__begin", "__p"))


def totals(rows: DataFrame) -> tuple[int, int]:
    n, size = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    return n, size or 0


def shard_table(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """What the written shards hold of each document: doc_id, size, text_crc32, law, shard, slot, grown_shard, bucket."""
    spark = docs.sparkSession
    path = f"{session.ensure_checkpoint_dir(spark)}/cohortflow-{uuid.uuid4().hex}"
    session._WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    write_shards(docs, path, shards, seed, bucket_bytes, buckets=True)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, slot long, __bucket long, shard int"
    return spark.read.schema(schema).parquet(path).select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("__bucket").alias("bucket"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES, buckets: bool = False) -> None:
    """Writes the shuffled documents with all their columns (and __bucket) as Parquet, in folders by shard; in a file, rows are in slot order."""
    docs, back = guarded(docs, ("doc_id", "text"), ("shard", "slot"))
    rows = docs.withColumns({"__size": (F.octet_length(text_of()) + 1).cast("long"), "__crc": F.crc32(text_of().cast("binary"))})
    n, size = totals(rows.select(F.col("__size").alias("size")))
    placed = external_shuffle(rows, n, size, ["doc_id", "__crc", "__size"], shards, seed, bucket_bytes)
    more = [F.col("bucket").alias("__bucket")] if buckets else []
    (back(placed.sortWithinPartitions("shard", "slot"), "shard", "slot", *more)
     .write.partitionBy("shard").parquet(path))
