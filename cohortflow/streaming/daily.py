"""Incremental daily runs of the reactivation features (P1) with Structured Streaming.

Upstream, P1 is a template re-run for every anchor day. Here a file stream over the
day-partitioned order table detects which days have arrived. An anchor is run when its outcome
window has closed, that is when the newest day that has arrived is its last outcome day or later;
``foreachBatch`` then runs all closed anchors of the batch in one plan (``plans.many_anchors``), which
reads the history once, and overwrites exactly their output partitions. A day that arrives late reruns
every closed anchor that reads it: those whose outcome window holds it and those after it, for which it
is history. ``at_once`` bounds the anchors of one plan; more are run one plan after another. The stream checkpoint records
which files were handled, and a replayed micro-batch rewrites the same partitions, so reruns are
idempotent.

Only distinct days reach the driver; those that are there are read from the folder names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortflow.params import ObservationWindow
from cohortflow.plans import many_anchors as MA
from cohortflow.plans import reactivation as P
from cohortflow.sources.sinks import write_by
from cohortflow.sources.tables import partition_days


def window_for(anchor: dt.date, history_start: dt.date, outcome_days: int = 91) -> ObservationWindow:
    """The window of the single-anchor job."""
    end = anchor + dt.timedelta(days=outcome_days)
    return ObservationWindow.of(history_start, anchor, end + dt.timedelta(days=1), history_start=history_start,
                                end_date=end)


def closed_anchors(there: list[dt.date], new: list[dt.date], outcome_days: int) -> list[dt.date]:
    """The anchors to run when the days ``new`` have arrived: those of the days ``there`` whose outcome
    window has closed and that read a new day, as outcome or as history."""
    span = dt.timedelta(days=outcome_days)
    return [d for d in sorted(there) if new and d + span <= max(there) and d + span >= new[0]]


def run_anchors(src: P.ReactivationSources, anchors: list[dt.date], out_path: str, history_start: dt.date, outcome_days: int = 91,
                rides_since=None) -> None:
    """The features of these anchors, in place of those that ``out_path`` holds of them."""
    write_by(MA.reactivation_features(src, anchors, history_start, outcome_days, rides_since=rides_since), out_path, "anchor")


def start_daily_reactivation(spark: SparkSession, orders_path: str, orders_schema,
                             sources: Callable[[], P.ReactivationSources],
                             out_path: str, checkpoint_location: str, history_start: dt.date,
                             outcome_days: int = 91, rides_since=None, available_now: bool = True,
                             max_files_per_trigger: int | None = None, at_once: int = 366):
    """Start the stream; returns the ``StreamingQuery``.

    ``orders_path`` is the day-partitioned order table (``day=YYYY-MM-DD`` directories or a ``day``
    column); ``sources()`` builds the sources the job reads, orders included, as far as they have
    arrived (called for each plan, so new files are visible)."""
    reader = spark.readStream.schema(orders_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(orders_path)

    def run(batch: DataFrame, epoch_id: int) -> None:
        new = sorted(r["day"] for r in batch.select("day").distinct().collect())
        anchors = closed_anchors(partition_days(spark, orders_path, orders_schema), new, outcome_days)
        for low in range(0, len(anchors), at_once):
            run_anchors(sources(), anchors[low:low + at_once], out_path, history_start, outcome_days, rides_since)

    writer = stream.select("day").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
