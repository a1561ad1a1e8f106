"""Defaults that must not drop rows, plans that must not run jobs, sums that must stay exact, lines that must not replace one another."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortflow import cli
from cohortflow.operators import aggregates as A
from cohortflow.operators import windows as WN
from cohortflow.plans import anchor_run
from cohortflow.plans import reactivation as P
from cohortflow.registry import queries
from cohortflow.sources import testbed as T
from cohortflow.sources.testbed import Sources
from oracle.compare import compare
from tests.conftest import SF001, SF01

QUERIES = queries()
#: These rank rows, and so materialise their input once.
RANKED = {"win_order_sequence", "win_dense_rank", "job_post_cross_tagged", "job_post_cross_orders", "job_reactivation_features",
          "job_reactivation_features_blended", "job_reactivation_features_many"}
#: These store what they then read several times, or read tables laid out by day or in buckets.
STORED = {"job_reactivation_targets", "job_reactivation_features_stored", "latest_snapshot_by_day", "scan_window_by_day", "win_latest_merged", "join_proximity_salted",
          "job_commute_place", "join_latest_versions", "win_best_match", "job_area_scores_dropoff", "job_area_scores_pickup", "job_area_scores_shop_dropoff",
          "job_last_known_features", "job_dropoff_points", "job_pickup_points", "job_dominant_cell"}


def with_old_ride(src, spark):
    """The sources' trips with one ride of 1996, before the order history, of a customer who has later ones."""
    ride = src.trips.where(F.col("day") >= "1999-01-01").limit(1)
    old = ride.withColumns({"day": F.lit(dt.date(1996, 1, 5)), "trip_id": (F.col("trip_id") + 10**12).cast(src.trips.schema["trip_id"].dataType)})
    return src.trips.where(F.col("day") >= "1998-01-01").unionByName(old)


def test_ride_history_is_not_cut_by_default(spark):
    W = T.REACTIVATION_W
    trips = with_old_ride(Sources(spark, SF01), spark)
    every = P.ride_value(trips, W).agg(F.sum("n_rides")).first()[0]
    since = P.ride_value(trips, W, W.history_start).agg(F.sum("n_rides")).first()[0]
    assert P.ride_value(trips, W, "1995-01-01").agg(F.sum("n_rides")).first()[0] == every and every in (since, since + 1)
    valid = P.valid_trips(trips, P.VALUE_TRIP_RULES).where(F.col("day") < "1997-01-01").count()
    assert every == since + valid


def test_cli_counts_rides_before_the_order_history(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-cli-rides-")
    s = Sources(spark, SF01)
    mapping = {}
    for name in ["orders", "merchants", "customers", "value_lines", "order_level", "trips", "subscription_events", "profile"]:
        mapping[name] = os.path.join(root, "in", name)
        getattr(s, name).write.parquet(mapping[name])
    with open(os.path.join(root, "tables.json"), "w") as fh:
        json.dump(mapping, fh)
    W = T.REACTIVATION_W
    cli.main(["reactivation", "--tables", os.path.join(root, "tables.json"), "--anchor", str(W.anchor), "--history-start", "1999-06-01",
              "--end", str(W.end_date), "--lapse-days", "30", "--min-orders", "1", "--out", os.path.join(root, "out")])
    got = spark.read.parquet(os.path.join(root, "out", "reactivation_targets")).agg(F.sum("n_rides")).first()[0]
    window = T.ObservationWindow.of("1999-06-01", W.anchor, W.end_date, history_start="1999-06-01", end_date=W.end_date)
    src = P.ReactivationSources.from_testbed(s)
    assert got == P.reactivation_targets(src, window, 30, 1, rides_since="1990-01-01").agg(F.sum("n_rides")).first()[0]
    assert got > P.reactivation_targets(src, window, 30, 1, rides_since="1999-06-01").agg(F.sum("n_rides")).first()[0]


@pytest.mark.parametrize("args", [["reactivation"], ["cross-sell", "--source-start", "2023-10-01"]])
def test_cli_names_missing_dates(args, capsys):
    with pytest.raises(SystemExit):
        cli.main([*args, "--tables", "none.json", "--anchor", "2024-01-21", "--out", "none"])
    assert "needs --" in capsys.readouterr().err


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RANKED - STORED))
def test_no_job_runs_while_a_plan_is_built(spark, name):
    QUERIES[name](spark, SF001)  # the tables' footers are read once
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        QUERIES[name](spark, SF001)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_value_sums_of_large_decimals_are_exact(spark):
    rows = [(1, 1, Decimal("9000000000000000.00")), (1, 2, Decimal("8999999999999999.99")), (2, 3, Decimal("0.01"))]
    df = spark.createDataFrame(rows, "k long, o long, x decimal(18,2)")
    got = A.value_stats(df, key="k", order_id="o", gross=F.col("x"), margin=F.col("x"),
                        names={"n": "n", "gmv": "gmv", "gp": "gp", "gppo": "gppo"}).collect()
    assert {r["k"]: (r["n"], r["gmv"]) for r in got} == {1: (2, Decimal("17999999999999999.99")), 2: (1, Decimal("0.01"))}


def test_recent_distinct_has_no_expand(spark):
    df = spark.createDataFrame([(1, 1, True), (1, 1, False), (1, 2, False), (1, None, True), (2, 3, None)], "k long, o long, r boolean")
    got = A.recent_distinct(df, key="k", order_id="o", recent=F.col("r"), names={"n": "n", "n_recent": "m"})
    assert sorted(map(tuple, got.collect())) == [(1, 2, 1), (2, 1, 0)]
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_top_k_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    top = WN.top_k(df, "k", [F.col("id").desc()], 2)
    assert {(r["k"], r["id"], r["rank"]) for r in top.collect()} == {(1, 19998, 1), (1, 19995, 2), (0, 19999, 1), (0, 19997, 2)}
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_lines_and_bases_of_one_anchor_live_side_by_side(spark):
    s, W = Sources(spark, SF001), T.CROSS_SELL_W
    src = anchor_run.CrossSellSources.from_testbed(s)
    root = tempfile.mkdtemp(prefix="cohortflow-lines-")
    for line in ("food", "shop"):
        anchor_run.write_tables({k: v for k, v in anchor_run.cross_sell_tables(src, W, lines=[line]).items() if k.startswith("area")}, root, W.anchor)
    back = spark.read.parquet(os.path.join(root, "area_scores"))
    for line, job in (("food", "job_area_scores_dropoff"), ("shop", "job_area_scores_shop_dropoff")):
        got, ref = back.where((F.col("line") == line) & (F.col("side") == "dropoff")).drop("line", "side", "anchor"), QUERIES[job](spark, SF001)
        assert compare(got.columns, [tuple(r) for r in got.collect()], ref.columns, [tuple(r) for r in ref.collect()]) == []
    crossed = anchor_run.cross_sell_tables(src, W, base="crossed_a")
    got, ref = crossed["customer_base"].drop("anchor_date"), QUERIES["job_crossed_on_a"](spark, SF001)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect())) and not any(k.startswith("area") for k in crossed)
    after = anchor_run.post_cross_tables(src, s.orders, s.merchant_tags, s.tags, W)
    for name in after:
        got, ref = after[name], QUERIES[f"job_{name}"](spark, SF001)
        assert compare(got.columns, [tuple(r) for r in got.collect()], ref.columns, [tuple(r) for r in ref.collect()]) == []


def test_other_cell_grids(spark):
    from cohortflow.plans.locations import dominant_cell

    pts = spark.createDataFrame([(1, 1.2, 3.4, 5), (1, 9.0, 9.0, 2), (1, 1.4, 3.1, 1)], "customer_id long, latitude double, longitude double, trip_cnts long")
    got = dominant_cell(pts, cell_expr=F.concat_ws("/", F.floor("latitude"), F.floor("longitude"))).first()
    assert (got["cell"], got["trip_loc_cnts"]) == ("1/3", 6)
