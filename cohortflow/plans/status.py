"""Cross-service status from daily snapshot tables (C3, C4 with S3 / S4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.bands import band
from cohortflow.operators.scans import exact_snapshot, latest_snapshot


def platform_status_bands(snapshot: DataFrame, anchor, *, lookback_days: int | None = 3, city: str = R.HOME_CITY,
                          granularity: str = R.SNAPSHOT_GRANULARITY) -> DataFrame:
    """Transaction-count band and last-seen band per customer from one snapshot day.

    ``lookback_days`` reads the newest snapshot in ``[anchor - lookback, anchor)`` (S3); None reads
    the anchor day itself (S4). Age = snapshot day - last transaction date; NULL -> ``n/a``."""
    s = (latest_snapshot(snapshot, "day", anchor, lookback_days) if lookback_days is not None
         else exact_snapshot(snapshot, "day", anchor))
    s = s.where((F.col("granularity") == granularity) & (F.col("city") == city))
    age = F.datediff(F.col("day"), F.col("last_tx_date"))
    return s.select("customer_id", "monthly_status", "all_time_tx",
                    band("all_time_tx", R.TX_COUNT_BANDS).alias("tx_cohort"),
                    band(age, R.LAST_SEEN_BANDS, R.LAST_SEEN_ELSE, R.LAST_SEEN_NULL).alias("last_seen_band")).distinct()


def service_status_snapshot(snapshot: DataFrame, anchor, *, lookback_days: int | None = None,
                            city: str = R.HOME_CITY, domain: str = R.SNAPSHOT_DOMAIN, level: str = R.SNAPSHOT_LEVEL,
                            granularity: str = R.SNAPSHOT_GRANULARITY) -> DataFrame:
    """C4: second-service status, last order date and lifetime orders from one snapshot day."""
    s = (latest_snapshot(snapshot, "day", anchor, lookback_days) if lookback_days is not None
         else exact_snapshot(snapshot, "day", anchor))
    s = s.where((F.col("granularity") == granularity) & F.col("city").isin(city) & (F.col("domain") == domain)
                & (F.col("level") == level))
    return s.select("customer_id", "monthly_status", "last_order_date", "delivered_orders").distinct()
