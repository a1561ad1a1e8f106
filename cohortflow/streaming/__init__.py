"""Structured Streaming drivers. The upstream jobs are daily batch runs keyed by an anchor day;
``daily`` turns them into an incremental file stream over the day-partitioned order table."""

from cohortflow.streaming.daily import start_daily_reactivation, window_for  # noqa: F401
