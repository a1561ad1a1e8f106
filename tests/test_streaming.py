"""The daily stream runs an anchor when its outcome window has closed, with exactly the batch job's output."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from dataclasses import replace

from pyspark.sql import functions as F

from cohortflow.plans import reactivation as P
from cohortflow.sources import testbed as T
from cohortflow.sources.testbed import Sources
from cohortflow.streaming import start_daily_reactivation
from cohortflow.streaming.daily import closed_anchors, window_for
from oracle.compare import compare
from tests.conftest import SF01

HISTORY = dt.date(1997, 1, 1)
OUTCOME = 4


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_daily_stream_matches_batch_over_arrived_rows(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-stream-")
    orders_dir, out_dir, ckpt = (os.path.join(root, x) for x in ("orders", "out", "ckpt"))
    src = P.ReactivationSources.from_testbed(Sources(spark, SF01))
    anchor = T.ANCHOR_DAY_W.anchor
    day = lambda k: anchor + dt.timedelta(days=k)

    def arrived():
        return replace(src, orders=spark.read.schema(src.orders.schema).parquet(orders_dir))

    def arrive(*conds):
        for cond in conds:
            src.orders.where(cond).write.mode("append").partitionBy("day").parquet(orders_dir)
        start_daily_reactivation(spark, orders_dir, src.orders.schema, arrived, out_dir, ckpt, history_start=HISTORY,
                                 outcome_days=OUTCOME).awaitTermination(600)

    def anchors():
        return {str(r.anchor) for r in spark.read.parquet(out_dir).select("anchor").distinct().collect()} if os.path.isdir(out_dir) else set()

    def expected():
        return P.reactivation_features(arrived(), window_for(anchor, HISTORY, OUTCOME))

    d = F.col("day")
    arrive(d.between(day(-40), day(-1 - OUTCOME)) & (d != day(-30)), d == anchor)
    before = anchors()
    assert str(anchor) not in before  # its outcome has not happened
    arrive(d.between(day(1), day(OUTCOME)))
    assert anchors() - before >= {str(anchor)} and str(day(1)) not in anchors()
    got = spark.read.parquet(out_dir).where(F.col("anchor").cast("string") == str(anchor)).drop("anchor")
    ref = expected()
    assert compare(got.columns, rows(got), ref.columns, rows(ref)) == [] and ref.count() > 0
    arrive(d == day(-30))  # late history reruns the anchor
    got, ref = spark.read.parquet(out_dir).where(F.col("anchor").cast("string") == str(anchor)).drop("anchor"), expected()
    assert compare(got.columns, rows(got), ref.columns, rows(ref)) == []


def test_closed_anchors():
    day = lambda n: dt.date(2024, 1, n)
    there = [day(n) for n in (1, 2, 3, 5, 8)]
    assert closed_anchors(there, [day(8)], 3) == [day(5)]
    assert closed_anchors(there, [day(3)], 3) == [day(1), day(2), day(3), day(5)]
    assert closed_anchors(there, [], 3) == [] and closed_anchors([day(1)], [day(1)], 3) == []
