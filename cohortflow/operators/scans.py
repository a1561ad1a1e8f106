"""Windowed scans over day-partitioned tables.

A range predicate on the partition column becomes ``PartitionFilters`` on a partitioned table
and ``PushedFilters`` on a plain Parquet scan; the scan reads only the selected days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_predicate(col: str, lo=None, hi=None, lo_inclusive: bool = True, hi_inclusive: bool = False):
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= F.lit(lo)) if lo_inclusive else (c > F.lit(lo)))
    if hi is not None:
        cond = cond & ((c <= F.lit(hi)) if hi_inclusive else (c < F.lit(hi)))
    return cond


def scan_window(df: DataFrame, col: str, lo=None, hi=None, lo_inclusive: bool = True,
                hi_inclusive: bool = False) -> DataFrame:
    """Rows with ``col`` in the window; default half-open ``[lo, hi)``."""
    return df.where(window_predicate(col, lo, hi, lo_inclusive, hi_inclusive))


def exact_snapshot(df: DataFrame, col: str, day) -> DataFrame:
    """One snapshot day."""
    return df.where(F.col(col) == F.lit(day))


def latest_snapshot(df: DataFrame, col: str, anchor, lookback_days: int = 3) -> DataFrame:
    """S3: the newest snapshot day in ``[anchor - lookback, anchor)``.

    Planned as a scalar subquery: the max over a bounded day range is computed first and then
    used as an equality predicate on the partition column, so only one snapshot is read."""
    lo = F.date_sub(F.lit(anchor), lookback_days)
    latest = df.where((F.col(col) >= lo) & (F.col(col) < F.lit(anchor))).select(F.max(col))
    return df.where(F.col(col) == latest.scalar())


def union_ranges(df: DataFrame, col: str, ranges: Sequence[tuple]) -> DataFrame:
    """``UNION ALL`` of disjoint ranges ``(lo, hi, hi_inclusive)``.

    Only for genuinely different branches; one range filter is cheaper (one scan)."""
    parts = [scan_window(df, col, lo, hi, True, hi_inc) for lo, hi, hi_inc in ranges]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
