"""Key normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_key(col, prefix_len: int = 0) -> Column:
    """Text or numeric id -> BIGINT; optionally strip a fixed-length prefix first.

    ``try_cast`` keeps dirty ids as NULL instead of failing the job under ANSI mode."""
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    if prefix_len:
        s = F.substring(s, prefix_len + 1, 1 << 30)
    return F.trim(s).try_cast("long")
