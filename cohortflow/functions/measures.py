"""Derived measures as column expressions (M1-M8)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(x, n) -> Column:
    """M1: ``x / nullif(n, 0)`` in double precision (NULL when n is 0 or NULL)."""
    d = _col(n).cast("double")
    return F.when(d != 0, _col(x).cast("double") / d)


def total_value(*cols) -> Column:
    """M3: sum of values, missing as 0."""
    out = None
    for c in cols:
        term = F.coalesce(_col(c), F.lit(0))
        out = term if out is None else out + term
    return out


def blended_margin(margins: Sequence, counts: Sequence) -> Column:
    """M4: total margin over total count across services; guarded against a zero divisor."""
    return safe_ratio(total_value(*margins), total_value(*counts))


def elapsed_days(ts, anchor) -> Column:
    """M5: whole 24-hour periods from a timestamp to the anchor (midnight); truncates toward 0."""
    return F.timestamp_diff("DAY", _col(ts), F.lit(anchor).cast("timestamp_ntz"))


def calendar_days(d, anchor) -> Column:
    """M6: calendar days from a date to the anchor (``anchor - d``)."""
    return F.datediff(F.lit(anchor), _col(d).cast("date")).cast("long")


def days_since(anchor, ts) -> Column:
    """M6 reversed: calendar days from the anchor to the event day (days since crossing)."""
    return F.datediff(_col(ts).cast("date"), F.lit(anchor)).cast("long")


def z_value(confidence: float) -> float:
    return NormalDist().inv_cdf(1 - (1 - confidence) / 2)


def wilson_lower(successes, n, confidence: float = 0.95) -> Column:
    """M7: Wilson score interval lower bound; 0 when n == 0."""
    z = z_value(confidence)
    k = _col(successes).cast("double")
    nn = _col(n).cast("double")
    p = k / nn
    spread = F.sqrt((p * (F.lit(1.0) - p) + F.lit(z * z) / (F.lit(4.0) * nn)) / nn)
    num = p + F.lit(z * z) / (F.lit(2.0) * nn) - F.lit(z) * spread
    den = F.lit(1.0) + F.lit(z * z) / nn
    return F.when(nn == 0, F.lit(0.0)).otherwise(num / den)


def override_when(flag, value, col) -> Column:
    """M8: replace ``col`` by ``value`` where ``flag`` holds."""
    return F.when(_col(flag), F.lit(value)).otherwise(_col(col))


def decay_weight(age, tau: float) -> Column:
    """A8 term: ``exp(-age / tau)`` in double precision."""
    return F.exp(-_col(age).cast("double") / F.lit(float(tau)))


assert math.isclose(z_value(0.95), 1.959963984540054)
