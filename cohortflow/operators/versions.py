"""Latest-version tables that are kept up by merging.

``latest_by`` over a whole change log reads it again for each run. Here the latest version of each key is a table of its
own, laid out by ranges or hashes of the key, and a new day's rows are merged into it: only the parts that hold a key of
the new rows are read and replaced. As the newest of the newest is the newest, the table after any number of merges, in
any order and with repeats, is that of the whole log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators.windows import latest_by
from cohortflow.session import cut_lineage
from cohortflow.sources.sinks import write_by

PART = "part"


def key_range(key: str, width: int) -> Column:
    """The part of a whole-number key: ranges of ``width`` keys. New rows of few customers touch few parts."""
    return F.coalesce(F.floor(F.col(key) / width), F.lit(-1)).cast("long")


def key_hash(keys: Sequence[str], parts: int) -> Column:
    """The part of any key: a hash, for keys that are not numbers or cluster in few ranges."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("long")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def merge_latest(path: str, new: DataFrame, keys: Sequence[str], order: Sequence[str], part: Column, at_most: int = 10_000) -> DataFrame:
    """Merge ``new`` into the table at ``path`` and return the table. ``order`` are columns that rank a key's versions;
    rows of equal order are told apart by their other columns, so the result does not depend on the order of merges.

    The numbers of the touched parts go to the driver (up to ``at_most``; with more the whole table is read), as
    partition filters of the read. The merged parts are stored before they replace the old ones, so a run that is
    lost half way leaves the old table or a mixture that the same merge completes."""
    spark = new.sparkSession
    others = [c for c in new.columns if c not in keys and c not in order]
    rows = cut_lineage(latest_by(new, keys, [*order, *others]).withColumn(PART, part))
    if _exists(spark, path):
        old = spark.read.schema(rows.schema).parquet(path)
        touched = [r[0] for r in rows.select(PART).distinct().limit(at_most + 1).collect()]
        if len(touched) <= at_most:
            old = old.where(F.col(PART).isin(touched))
        rows = cut_lineage(latest_by(old.unionByName(rows), [*keys, PART], [*order, *others]).select(*rows.columns))
    write_by(rows, path, PART)
    return spark.read.schema(rows.schema).parquet(path).drop(PART)
