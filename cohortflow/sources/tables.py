"""Table readers. Parquet in; Spark prunes columns and pushes filters into the scan."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    path = os.path.join(sf_dir, f"{name}.parquet")
    if not os.path.exists(path) and os.path.isdir(os.path.join(sf_dir, name)):
        path = os.path.join(sf_dir, name)
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def partition_days(spark: SparkSession, path: str, schema: StructType, col: str = "day") -> list[dt.date]:
    """The days of a table, ascending: from the names of its folders ``day=YYYY-MM-DD`` without reading a file, else
    (a table that is not laid out by day) from the column."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []
    days = [n.removeprefix(f"{col}=") for n in names if n.startswith(f"{col}=")]
    if days:
        return sorted(dt.date.fromisoformat(d) for d in days if not d.startswith("__HIVE"))
    if not fs.exists(folder):
        return []
    return sorted(r[0] for r in spark.read.schema(schema).parquet(path).select(col).distinct().collect() if r[0] is not None)
