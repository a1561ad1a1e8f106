"""cohortflow: customer-lifecycle features, cohorts and outcome labels as Spark plans.

Every operator takes DataFrames and column names and returns a lazy DataFrame built only
from built-in Spark expressions. Nothing is collected to the driver.

Layout
------
functions/  column expressions (bands, measures, geo, keys)
operators/  DataFrame -> DataFrame operators (scans, filters, joins, aggregates, windows)
sources/    table readers, the test-table bindings, Parquet sink
plans/      composed jobs (reactivation, cross-sell, trips, places, locations, post-cross)
streaming/  incremental (per-day) driver for the daily jobs
"""

from cohortflow.params import ObservationWindow  # noqa: F401

__all__ = ["ObservationWindow"]
