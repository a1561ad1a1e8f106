"""Jobs and registered queries: oracle equality, plan shape, traps T10/T22, sink read-back."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortflow import rules as R
from cohortflow.operators import windows as WN
from cohortflow.plans import locations as L
from cohortflow.plans import places as PL
from cohortflow.plans import reactivation as P
from cohortflow.params import ObservationWindow
from cohortflow.registry import queries
from oracle import all_sql
from oracle.compare import compare, duck
from tests.conftest import SF001

QUERIES = queries()
SQL = all_sql()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["day", "customer_id", "recency_days", "first_order_date", "last_order_date", "order_cohort",
                          "recency_band", "lifetime_orders", "last_merchant", "is_resident"]


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 90
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    assert compare(df.columns, rows, ocols, cur.fetchall()) == []
    rel = con.sql(SQL[name])
    otypes = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:  # same column types on both sides
        assert DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) == otypes[f.name], f.name


BAD_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    """No Python UDF, no cartesian / nested-loop join; jobs have no single-partition exchange at all,
    operator queries none under a window (a one-row global aggregate may end in one partition)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF001).explain()
    plan = buf.getvalue()
    for bad in BAD_NODES[:-1]:
        assert bad not in plan, f"{name}: {bad} in plan"
    if name.startswith("job_"):
        assert "SinglePartition" not in plan, name
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = "\n".join(lines[i + 1:i + 4])
            assert "SinglePartition" not in below, f"{name}: single-partition window"


def test_rides_after_anchor_not_counted(spark):
    """One history range ending at the anchor; a post-anchor trip is not counted."""
    rows = [("2023-12-31", "1", 11, 10.0), ("2024-01-20", "1", 12, 20.0), ("2024-01-21", "1", 13, 40.0),
            ("2024-02-01", "1", 14, 80.0)]
    trips = spark.createDataFrame(
        [(dt.date.fromisoformat(d), c, t, "Ride Hailing", 3, R.VALUE_COUNTRY.title(), v, 1.0) for d, c, t, v in rows],
        "day date, customer_id string, trip_id long, business_type string, trip_outcome int, country string, "
        "revenue double, cogs double")
    W = ObservationWindow.of("2012-01-01", "2024-01-21", "2024-02-21")
    r = P.ride_value(trips, W, "2012-01-01").first()
    assert (r.n_rides, r.n_rides_30, r.ride_gmv) == (2, 2, 30.0)


def test_best_place_first_then_exclusion(spark):
    """An event whose best (newest) place is 'home' is dropped; it does not fall back."""
    t0 = dt.datetime(2024, 1, 1)
    places = spark.createDataFrame(
        [(7, 1, t0, t0, 25.0, 55.0, "Home", "b", "c", "p"), (7, 2, t0 - dt.timedelta(days=1), t0, 25.0, 55.0, "Work", "b", "c", "p")],
        "sl_customer_id long, location_id long, created_at timestamp_ntz, last_updated timestamp_ntz, sl_lat double, "
        "sl_lon double, saved_name string, address_type string, building_type string, place_name string")
    bookings = spark.createDataFrame([(7, 100, 25.0, 55.0, t0 + dt.timedelta(days=1))],
                                     "customer_id long, booking_id long, drop_off_latitude double, "
                                     "drop_off_longitude double, pick_up_time timestamp_ntz")
    best = PL.matched_places(bookings, places)
    assert [r.location_id for r in best.collect()] == [1]


def test_write_scores_roundtrip(spark):
    """Partitioned Parquet sink, read back."""
    scores = spark.createDataFrame([("0:1", 12, 3, 0.1), ("1:1", 20, 10, 0.3)],
                                   "area string, n_customers long, n_adopters long, wilson_lower double")
    out = os.path.join(tempfile.mkdtemp(prefix="cohortflow-sink-"), "scores")
    L.write_scores(scores, out, "food", dt.date(2024, 1, 21), "dropoff")
    L.write_scores(scores.limit(1), out, "food", dt.date(2024, 1, 21), "pickup")
    L.write_scores(scores, out, "food", dt.date(2024, 1, 21), "pickup")  # rerun replaces only its partition
    back = spark.read.parquet(out)
    assert back.count() == 4
    assert {r.side for r in back.select("side").distinct().collect()} == {"dropoff", "pickup"}
    assert {r.line for r in back.select("line").collect()} == {"food"}
    assert sorted(back.columns) == sorted(["area", "n_customers", "n_adopters", "wilson_lower", "line", "anchor", "side"])


def test_trip_features_invariants(spark):
    df = QUERIES["job_trip_features"](spark, "/root/testdata/sf0.01")
    rows = df.collect()
    assert len({r.customer_id for r in rows}) == len(rows)  # one row per customer
    for r in rows:
        assert 0.0 <= r.promo_perc <= 100.0
        assert r.days_since_most_recent_trip <= r.days_since_least_recent_trip
        # decayed counts fall as tau falls when all ages are positive
        if r.days_since_most_recent_trip > 0:
            assert r.exp_weight_90 >= r.exp_weight_30 >= r.exp_weight_5
        assert r.total_rides == r.trip_count


def test_rank_within_on_job_data_matches_window(spark):
    o = P.ReactivationSources.from_testbed(__import__("cohortflow.sources.testbed", fromlist=["Sources"]).Sources(
        spark, "/root/testdata/sf0.01")).orders.select("customer_id", "order_id", "line_no", "order_received_timestamp")
    got = WN.rank_within(o, "customer_id", ["order_received_timestamp"], out="r", dense=True)
    ref = WN.rank_within_window(o, "customer_id", ["order_received_timestamp"], out="r", dense=True)
    key = ["customer_id", "order_id", "line_no", "r"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, ref.select(key).collect()))



def test_trip_features_legacy_decimal_scale(spark):
    """T3 option: shares in 10 % steps and decay exponents rounded to one decimal."""
    from cohortflow.plans import trips as TR
    from cohortflow.registry.jobs import TRIP_THRESHOLDS, cohort
    from cohortflow.sources import testbed as TB

    s = TB.Sources(spark, "/root/testdata/sf0.01")
    exact = {r.customer_id: r for r in TR.trip_features(s.trips, cohort(spark, s.sf_dir), s.credits, TB.CROSS_SELL_W,
                                                        TRIP_THRESHOLDS).collect()}
    legacy = TR.trip_features(s.trips, cohort(spark, s.sf_dir), s.credits, TB.CROSS_SELL_W, TRIP_THRESHOLDS,
                              legacy_decimal_scale=True).collect()
    assert len(legacy) == len(exact)
    for r in legacy:
        assert abs(r.promo_perc / 10 - round(r.promo_perc / 10)) < 1e-9  # multiples of 10 %
        e = exact[r.customer_id]
        assert abs(r.promo_perc - e.promo_perc) <= 5.0 + 1e-9
        assert r.trip_count == e.trip_count


def test_anchor_run_writes_every_table(spark):
    """One anchor's cross-sell tables over one materialized cohort equal the registered jobs."""
    from cohortflow.plans.anchor_run import CrossSellSources, cross_sell_tables, write_tables
    from cohortflow.sources import testbed as TB

    s = TB.Sources(spark, SF001)
    tables = cross_sell_tables(CrossSellSources.from_testbed(s), TB.CROSS_SELL_W)
    root = os.path.join(tempfile.mkdtemp(prefix="cohortflow-run-"), "out")
    paths = write_tables(tables, root, TB.CROSS_SELL_W.anchor)
    assert set(paths) == set(tables)
    for name, job in [("trip_features", "job_trip_features"), ("area_scores/food/dropoff", "job_area_scores_dropoff"),
                      ("customer_base", "job_base_stamped"), ("home_cell_dropoff", "job_dominant_cell")]:
        back = spark.read.parquet(paths[name]).drop("anchor")
        if "line" in back.columns:
            back = back.where("line = 'food' AND side = 'dropoff'").drop("line", "side")
        ref = QUERIES[job](spark, SF001)
        assert compare(back.columns, [tuple(r) for r in back.collect()], ref.columns,
                       [tuple(r) for r in ref.collect()]) == [], name


def test_window_filter_and_pruning_reach_the_scan(spark):
    """The day window becomes a Parquet range predicate and only used columns are read."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["scan_window_half_open"](spark, SF001).explain("formatted")
    plan = buf.getvalue()
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters") and "l_shipdate" in ln]
    assert pushed and "GreaterThanOrEqual(l_shipdate" in pushed[0] and "LessThan(l_shipdate" in pushed[0]
    schemas = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema") and "l_shipdate" in ln]
    assert schemas and schemas[0].count(":") <= 5  # l_orderkey, l_partkey, l_linenumber, l_shipdate


def test_cli_cross_sell_on_parquet_tables(spark):
    """The command-line entry reads plain Parquet tables by name and writes every table."""
    import json

    from cohortflow import cli
    from cohortflow.plans.anchor_run import CrossSellSources
    from cohortflow.sources import testbed as TB

    root = tempfile.mkdtemp(prefix="cohortflow-cli-")
    s = TB.Sources(spark, SF001)
    mapping = {}
    for name in CrossSellSources.__dataclass_fields__:
        binding = {"active_subs": "active_subs"}.get(name, name)
        path = os.path.join(root, "in", name)
        getattr(s, binding).write.parquet(path)
        mapping[name] = path
    with open(os.path.join(root, "tables.json"), "w") as fh:
        json.dump(mapping, fh)
    W = TB.CROSS_SELL_W
    cli.main(["cross-sell", "--tables", os.path.join(root, "tables.json"), "--anchor", str(W.anchor),
              "--source-start", str(W.source_start), "--target-end", str(W.target_end), "--out", os.path.join(root, "out")])
    back = spark.read.parquet(os.path.join(root, "out", "trip_features")).drop("anchor")
    ref = QUERIES["job_trip_features"](spark, SF001)
    assert compare(back.columns, [tuple(r) for r in back.collect()], ref.columns, [tuple(r) for r in ref.collect()]) == []


def test_cli_reactivation_on_parquet_tables(spark):
    import json

    from cohortflow import cli
    from cohortflow.sources import testbed as TB

    root = tempfile.mkdtemp(prefix="cohortflow-cli-r-")
    s = TB.Sources(spark, "/root/testdata/sf0.01")
    names = ["orders", "merchants", "customers", "value_lines", "order_level", "trips", "subscription_events", "profile"]
    mapping = {}
    for name in names:
        path = os.path.join(root, "in", name)
        getattr(s, name).write.parquet(path)
        mapping[name] = path
    with open(os.path.join(root, "tables.json"), "w") as fh:
        json.dump(mapping, fh)
    W = TB.REACTIVATION_W
    cli.main(["reactivation", "--tables", os.path.join(root, "tables.json"), "--anchor", str(W.anchor),
              "--history-start", str(W.history_start), "--end", str(W.end_date), "--rides-since", "1995-01-01",
              "--out", os.path.join(root, "out")])
    ref = P.lapsed_base(P.ReactivationSources.from_testbed(s), W)
    back = spark.read.schema(ref.schema).parquet(os.path.join(root, "out", "lapsed_base")).drop("anchor")
    assert back.count() > 0
    assert compare(back.columns, [tuple(r) for r in back.collect()], ref.columns, [tuple(r) for r in ref.collect()]) == []
    assert {"reactivation_features", "reactivation_targets"} <= set(os.listdir(os.path.join(root, "out")))


def test_proximity_inner_equals_left_after_exclusions(spark):
    """SURVEY 5.3: the inner proximity join gives the same commute input as the upstream left
    join followed by the best-match pick and the residential exclusions (T22)."""
    from cohortflow import rules as RR
    from cohortflow.operators import filters as FLT
    from cohortflow.operators import joins as JN
    from cohortflow.registry.jobs import cohort
    from cohortflow.sources import testbed as TB

    s = TB.Sources(spark, "/root/testdata/sf0.01")
    base = cohort(spark, s.sf_dir)
    drops = PL.completed_dropoffs(s.bookings, base, TB.EVENTS_W)
    places = PL.saved_places(s.place_locations, s.place_coordinates, s.place_details, base)
    inner = FLT.exclude_like(PL.matched_places(drops, places), RR.RESIDENTIAL_EXCLUSIONS, require_not_null=["sl_name"])
    left = JN.near_join(drops, places, key="customer_id", place_key="sl_customer_id", ev_lat="drop_off_latitude",
                        ev_lon="drop_off_longitude", pl_lat="sl_lat", pl_lon="sl_lon", metres=RR.PLACE_RADIUS_M,
                        extra=F.col("pick_up_time") > F.col("created_at"), how="left")
    left = left.select("customer_id", "booking_id", "location_id", "created_at", "last_updated",
                       F.lower("saved_name").alias("sl_name"), F.lower("address_type").alias("sl_address_type"),
                       F.lower("building_type").alias("sl_building_type"), F.lower("place_name").alias("sl_place_name"))
    best = WN.latest_by(left, ["customer_id", "booking_id"], ["created_at", "last_updated", "location_id"])
    left_kept = FLT.exclude_like(best, RR.RESIDENTIAL_EXCLUSIONS, require_not_null=["sl_name"])
    key = ["customer_id", "booking_id", "location_id"]
    assert sorted(map(tuple, inner.select(key).collect())) == sorted(map(tuple, left_kept.select(key).collect()))
    assert left.select("booking_id").distinct().count() == drops.count()


@pytest.mark.parametrize("name", ["band_time_of_day", "measure_age_elapsed", "measure_age_calendar",
                                  "job_trip_features", "job_reactivation_features", "latest_snapshot"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    """Timestamps are TIMESTAMP_NTZ end to end: a non-UTC session zone and ANSI off change nothing."""
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = QUERIES[name](spark, SF001)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)
    cur = con.execute(SQL[name])
    assert compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) == []
