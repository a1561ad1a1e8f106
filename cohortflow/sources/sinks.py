"""Parquet sink (S5): partitioned writes with dynamic partition overwrite.

Only the partitions present in the written DataFrame are replaced, so many anchors / sides /
business lines share one table and a rerun is idempotent. Never ``coalesce(1)``: the write stays
as parallel as the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, partitions: Mapping[str, object], mode: str = "overwrite") -> None:
    """Add the ``partitions`` literal columns and write Parquet partitioned by them."""
    out = df
    for name, value in partitions.items():
        out = out.withColumn(name, F.lit(str(value)))
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions.keys()).parquet(path))


def write_by(df: DataFrame, path: str, *keys: str) -> None:
    """Write Parquet partitioned by columns of ``df``; only the partitions that it has rows of are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Lay a table out by day, as the windowed scans (S1-S4) read it. Rows are dealt out by day before the write, so a
    day is a few files and not one for each task; AQE splits a large day over several."""
    write_by(df.hint("rebalance", day), path, day)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store a feature table in buckets by its key, sorted within them, and read it back.

    Tables of one key and one number of buckets join without a shuffle or sort (J2): see ``plans.feature_store``. The
    rows are dealt out by the key first, so each bucket is one file and not one for each task."""
    w = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (w.option("path", path) if path else w).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)
