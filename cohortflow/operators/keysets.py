"""Cutting a fact scan to a set of keys before the shuffle (J3), whatever the size of the set.

A semi-join above the scan would put all rows of a hot key into one task; one above the aggregate lets the history of
every other key reach the shuffle. ``KeySet`` does neither: the keys set bits in a table of at most ``WORDS`` 64-bit
words, and a broadcast join with that table drops rows at the scan. The bound (about 2 MB of bits) holds for any number
of keys, so the broadcast never grows with the data; with many more keys than bits it merely drops fewer rows. It never
drops a row whose key is in the set. ``exactly`` is the semi-join for after the aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """The word and the bit of a key; equal keys need equal types."""
    h = F.xxhash64(F.lit("keyset"), key)
    return (F.pmod(h, F.lit(words)).cast("int"),
            F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")))


@dataclass(frozen=True)
class KeySet:
    """The values of ``key`` in ``keys``. A frame that is read several times is best materialised first."""

    keys: DataFrame
    key: str = "customer_id"
    words: int = WORDS

    def marks(self) -> DataFrame:
        """``__word`` and ``__bits``, at most ``words`` rows."""
        word, bit = _place(F.col(self.key), self.words)
        return (self.keys.where(F.col(self.key).isNotNull()).select(word.alias("__word"), bit.alias("__bit"))
                .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))

    def likely(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """The rows of ``df`` whose key is in the set, and a few others; rows with a null key go."""
        word, bit = _place(F.col(key or self.key).cast(self.keys.schema[self.key].dataType), self.words)
        return (df.where(F.col(key or self.key).isNotNull()).withColumn("__word", word).join(F.broadcast(self.marks()), "__word", "inner")
                .where(F.col("__bits").bitwiseAND(bit) != 0).select(*(df[c] for c in df.columns)))

    def flagged(self, df: DataFrame, flag: str, key: str | None = None) -> DataFrame:
        """``df`` with a boolean: true for all rows whose key is in the set, and for a few others."""
        word, bit = _place(F.col(key or self.key).cast(self.keys.schema[self.key].dataType), self.words)
        found = F.coalesce((F.col("__bits").bitwiseAND(bit) != 0) & F.col(key or self.key).isNotNull(), F.lit(False))
        return df.withColumn("__word", word).join(F.broadcast(self.marks()), "__word", "left").select(*(df[c] for c in df.columns), found.alias(flag))

    def exactly(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """The rows of ``df`` whose key is in the set (for aggregates: one row for each key)."""
        k = self.keys.select(F.col(self.key).alias("__k"))
        return df.join(k, df[key or self.key] == k["__k"], "left_semi")
