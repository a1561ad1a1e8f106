"""Small helpers that the operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cohortflow
from cohortflow.session import cut_lineage


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers (as --py-files would), once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(cohortflow.__file__).parent
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='cohortflow-')}/cohortflow", "zip", package.parent, package.name))
        _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to the cluster's shared checkpoint folder and read again.

    They are computed once, their size is known to the planner, and a lost executor takes nothing with it.
    ``session.drop_intermediates`` removes the folders.
    """
    return cut_lineage(df)


#: What workers hold beyond a task, by operator, with what frees it.
_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, free: Callable[[], None]) -> None:
    """Notes that an operator keeps something in this worker; a task of another operator frees it."""
    _HELD[name] = free


def slices(batches, rows: int = 1000, name: str = ""):
    """The Arrow batches in slices of so many rows, so that a worker holds few texts as Python objects at a time.
    What operators other than ``name`` hold in this worker is freed first."""
    for other in [n for n in _HELD if n != name]:
        _HELD.pop(other)()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_of(col: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def guarded(df: DataFrame, own: tuple[str, ...], drop: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with columns other than ``own`` under names that clash with none, and a function that gives a result's
    columns their names and order back, with more columns (``drop`` names those of ``df`` that these replace)."""
    names = [c for c in df.columns if c not in drop]
    alias = {c: c if c in own else f"__other{i}" for i, c in enumerate(names)}
    back = lambda out, *more: out.select(*(F.col(a).alias(c) for c, a in alias.items()), *more)
    return df.select(*(F.col(f"`{c}`").alias(a) for c, a in alias.items())), back


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def held_out(col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 0 modulo 5 (a null id is never learned from)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def marked(df: DataFrame, key: str, ids: DataFrame, flag: str, words: int = 1 << 18) -> DataFrame:
    """``df`` with a boolean ``flag``: whether its 64-bit ``key`` may be among ``ids.key``. It is set for all that
    are there and for few others.

    The ids set bits in a table of ``words`` 64-bit words. That bound (4 MB) holds for any number of ids, so
    the table is broadcast; with more ids than bits all rows are flagged, and the join that follows decides.
    """
    h = lambda c: F.xxhash64(F.lit("mark"), c)
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h(c), 40), F.lit(64)).cast("int"))
    marks = (ids.select(F.pmod(h(F.col("key")), F.lit(words)).alias("__word"), bit(F.col("key")).alias("__bit"))
             .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    return (df.withColumn("__word", F.pmod(h(F.col(key)), F.lit(words)))
            .join(F.broadcast(marks), "__word", "left")
            .withColumn(flag, F.coalesce(F.col("__bits").bitwiseAND(bit(F.col(key))) != 0, F.lit(False)))
            .drop("__word", "__bits"))


def only_marked(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` that ``marked`` flags."""
    return marked(df, key, ids, "__may").where("__may").drop("__may")
