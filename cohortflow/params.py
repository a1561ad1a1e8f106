"""Run parameters: dates and thresholds are values, never text spliced into SQL."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


@dataclass(frozen=True)
class ObservationWindow:
    """History ``[source_start, anchor)``, outcome ``[anchor, target_end)``.

    ``end_date`` is the inclusive outcome end used by the reactivation outcome
    (``(anchor, end_date]``); it defaults to the day before ``target_end``.
    ``history_start`` is the long-history start for lifetime scans.
    """

    source_start: dt.date
    anchor: dt.date
    target_end: dt.date
    history_start: dt.date | None = None
    end_date: dt.date | None = None

    @staticmethod
    def of(source_start, anchor, target_end, history_start=None, end_date=None) -> "ObservationWindow":
        return ObservationWindow(
            as_date(source_start),
            as_date(anchor),
            as_date(target_end),
            as_date(history_start) if history_start is not None else None,
            as_date(end_date) if end_date is not None else None,
        )

    @property
    def history_lo(self) -> dt.date:
        return self.history_start or self.source_start

    @property
    def outcome_end_inclusive(self) -> dt.date:
        return self.end_date or (self.target_end - dt.timedelta(days=1))


@dataclass(frozen=True)
class TripThresholds:
    """Minimum counts / percentages of the trip habit features (all templated upstream)."""

    fav_cct_min_trip_cnt: int = 3
    fav_commute_time_min_trip_cnt: int = 2
    fav_payment_min_trip_cnt: int = 3
    min_share_pct: float = 20.0  # a percentage threshold (named like a trip count upstream)
    promo_percent_threshold: float = 50.0
    tz_offset_hours: int = 4
