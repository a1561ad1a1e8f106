"""Distinct days as bitmaps (A6, A3): a mergeable state that any window is counted from.

The days of a key are bits of 64-bit words, one row (key, word, bits) for each 64 days in which it was active. ``bit_or``
merges the words of two periods, sources or reruns without counting a day twice, in the partial aggregate too, so a hot
key brings one row for each word. The distinct days of a window are the ones of its words, cut at both ends; a table
of words kept once answers every window and every anchor without another pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD, BITS = "day_word", "day_bits"


def _bits_from(day: Column) -> Column:
    """The bits of a word for a day and all later ones: all of them for an earlier word, none for a later one."""
    ones = F.lit(-1).cast("long")
    ahead = day - F.col(WORD) * 64
    return F.when(ahead <= 0, ones).when(ahead >= 64, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", ones, ahead.cast("int")))


def day_words(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """keys, ``day_word`` and ``day_bits``: the distinct days of each key. Rows without a day give no bit."""
    n = F.unix_date(F.col(day).cast("date"))
    return merged(df.where(F.col(day).isNotNull()).select(
        *keys, F.floor(n / 64).cast("long").alias(WORD), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(n, F.lit(64)).cast("int")).alias(BITS)), keys)


def merged(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key and word, of several tables of words put together."""
    return words.groupBy(*keys, WORD).agg(F.bit_or(BITS).alias(BITS))


def within(words: DataFrame, lo=None, hi=None) -> DataFrame:
    """The words cut to the days ``[lo, hi)`` (dates, or columns of dates); None leaves that end open."""
    number = lambda d: F.unix_date((d if isinstance(d, Column) else F.lit(d)).cast("date")).cast("long")
    out = words
    if lo is not None:
        out = out.where((F.col(WORD) + 1) * 64 > number(lo)).withColumn(BITS, F.col(BITS).bitwiseAND(_bits_from(number(lo))))
    if hi is not None:
        out = out.where(F.col(WORD) * 64 < number(hi)).withColumn(BITS, F.col(BITS).bitwiseAND(F.bitwise_not(_bits_from(number(hi)))))
    return out.where(F.col(BITS) != 0)


def count_days(words: DataFrame, keys: Sequence[str], out: str = "active_days") -> DataFrame:
    """The distinct days of each key that has one."""
    return words.groupBy(*keys).agg(F.sum(F.bit_count(BITS)).cast("long").alias(out))


def active_at_anchors(words: DataFrame, key: str, anchors: DataFrame, days: int, out: str = "active_days") -> DataFrame:
    """key, anchor and the distinct days in the ``days`` before each anchor, for each (key, anchor) of ``anchors``.

    A window of so many days lies in at most days / 64 + 2 words, so each pair meets these words only."""
    a = anchors.select(key, "anchor").distinct()
    first, last = F.floor(F.unix_date(F.date_sub("anchor", days)) / 64), F.floor(F.unix_date(F.date_sub("anchor", 1)) / 64)
    asked = a.select(key, "anchor", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias(WORD))
    seen = within(asked.join(words, [key, WORD]), F.date_sub("anchor", days), F.col("anchor"))
    return a.join(count_days(seen, [key, "anchor"], out), [key, "anchor"], "left").withColumn(out, F.coalesce(out, F.lit(0).cast("long")))
