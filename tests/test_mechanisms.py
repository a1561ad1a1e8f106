"""Day bitmaps, counted rejects, tables laid out by day and in buckets, cohorts of many anchors."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortflow import cli
from cohortflow.operators import daybits as D
from cohortflow.operators import joins as J
from cohortflow.operators import scans as S
from cohortflow.operators import versions as V
from cohortflow.operators.windows import latest_by
from cohortflow.plans import crosssell as X
from cohortflow.plans import feature_store as FS
from cohortflow.plans import reactivation as P
from cohortflow.registry import queries
from cohortflow.session import ensure_checkpoint_dir
from cohortflow.sources import testbed as T
from cohortflow.sources.rejects import rejected_ids
from cohortflow.sources.sinks import write_days
from cohortflow.sources.tables import partition_days
from cohortflow.sources.testbed import Sources
from cohortflow.streaming.daily import window_for
from oracle.compare import compare
from tests.conftest import SF01

DAY0 = dt.date(1969, 11, 1)  # day numbers below 0 too


def day(k):
    return DAY0 + dt.timedelta(days=k)


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- day bitmaps

def visits(seed=1):
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 2, 3]), day(rng.randint(0, 300))) for _ in range(400)]
    return [*data, *data[:50], (4, None), (None, day(3)), (5, day(63)), (5, day(64)), (5, day(127))]


@pytest.mark.parametrize(("lo", "hi"), [(None, None), (0, 301), (61, 62), (50, 200), (64, 128), (None, 100), (250, None), (120, 120), (400, 500)])
def test_days_within_a_window(spark, lo, hi):
    data = visits()
    words = D.day_words(spark.createDataFrame(data, "k long, d date").repartition(4), ["k"], "d")
    lo, hi = (None if x is None else day(x) for x in (lo, hi))
    want = {}
    for k, d in data:
        if d is not None and (lo is None or d >= lo) and (hi is None or d < hi):
            want.setdefault(k, set()).add(d)
    assert dict(rows(D.count_days(D.within(words, lo, hi), ["k"]))) == {k: len(v) for k, v in want.items()}


def test_words_of_two_periods_merge_to_their_union(spark):
    a, b = visits(2), visits(3)
    words = [D.day_words(spark.createDataFrame(x, "k long, d date"), ["k"], "d") for x in (a, b)]
    both = D.count_days(D.merged(words[0].unionByName(words[1]), ["k"]), ["k"])
    whole = D.count_days(D.day_words(spark.createDataFrame(a + b, "k long, d date"), ["k"], "d"), ["k"])
    assert sorted(rows(both), key=str) == sorted(rows(whole), key=str) and both.count() == 5


def test_active_days_at_many_anchors(spark):
    data = visits(5)
    words = D.day_words(spark.createDataFrame(data, "k long, d date"), ["k"], "d")
    asked = [(k, day(n)) for k in (1, 2, 3, 9) for n in (0, 1, 30, 64, 65, 129, 301, 390, 600)]
    got = D.active_at_anchors(words, "k", spark.createDataFrame(asked + asked, "k long, anchor date"), 90)
    assert sorted(rows(got)) == sorted((k, a, len({d for c, d in data if c == k and d and a - dt.timedelta(90) <= d < a})) for k, a in asked)


def test_a_hot_key_is_a_few_words_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 4).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY0), (F.col("id") % 128).cast("int")).alias("d"))
    words = D.day_words(df, ["k"], "d")
    assert words.count() <= 3 and dict(rows(D.count_days(words, ["k"]))) == {1: 128}
    assert "partial_bit_or" in words._jdf.queryExecution().executedPlan().toString()


# ---- rejects

def test_rejected_ids_are_counted(spark):
    df = spark.createDataFrame([("CPLS-1", "1"), ("CPLS-x", "2"), (None, "no"), ("CPLS-", None), ("CPLS- 7", "3")], "userid string, other string")
    got = rejected_ids({"subs": (df, "userid", 5), "other": (df, "other", 0), "none": (df.limit(0), "other", 0)})
    assert sorted(rows(got)) == [("none", 0, 0, 0), ("other", 5, 1, 1), ("subs", 5, 1, 2)]


def test_command_line_over_many_anchors_counts_rejects(spark):
    root = tempfile.mkdtemp(prefix="cohortflow-cli-many-")
    s, mapping = Sources(spark, SF01), {}
    for name in ["orders", "merchants", "customers", "value_lines", "order_level", "trips", "subscription_events", "profile"]:
        mapping[name] = os.path.join(root, "in", name)
        getattr(s, name).write.parquet(mapping[name])
    with open(os.path.join(root, "tables.json"), "w") as fh:
        json.dump(mapping, fh)
    cli.main(["reactivation", "--tables", os.path.join(root, "tables.json"), "--anchor", "1999-05-12", "--through", "1999-05-13", "--history-start",
              "1997-01-01", "--end", "1999-06-01", "--out", os.path.join(root, "out"), "--count-rejects"])
    got = spark.read.parquet(os.path.join(root, "out", "reactivation_features"))
    src = P.ReactivationSources.from_testbed(s)
    for d in (dt.date(1999, 5, 12), dt.date(1999, 5, 13)):
        ref, of = P.reactivation_features(src, window_for(d, dt.date(1997, 1, 1), 20)), got.where(F.col("anchor").cast("date") == d).drop("anchor")
        assert compare(of.columns, rows(of), ref.columns, rows(ref)) == []
    seen = spark.read.parquet(os.path.join(root, "out", "rejected_ids")).drop("anchor").collect()
    assert {r["source"]: (r["n_missing"], r["n_rejected"]) for r in seen} == {n: (0, 0) for n in ("trips", "subscription_events", "profile")}


def test_dirty_dates_do_not_fail_the_job(spark):
    from cohortflow.operators.filters import active_at

    df = spark.createDataFrame([("2024-01-01", "2024-03-01"), ("soon", "2024-03-01"), ("2024-01-01", "never"), (None, None)], "a string, b string")
    assert active_at(df, "a", "b", dt.date(2024, 2, 1)).count() == 1


# ---- heavy cells of the proximity join

def test_a_heavy_cell_is_spread_and_loses_no_match(spark):
    rng = random.Random(2)
    point = lambda: (25 + rng.random() / 300, 55 + rng.random() / 300)
    events = [(1, i, 25.0001, 55.0001) for i in range(900)] + [(rng.randint(1, 40), 1000 + i, *point()) for i in range(1800)] + [(None, 9000, 25.0, 55.0)]
    places = [(rng.choice([1, *range(1, 45)]), i, *point()) for i in range(300)]
    ev = spark.createDataFrame(events + events[:5], "k long, e long, lat double, lon double").repartition(6)
    pl = spark.createDataFrame(places, "k long, p long, plat double, plon double").withColumnRenamed("k", "pk")
    args = dict(key="k", place_key="pk", ev_lat="lat", ev_lon="lon", pl_lat="plat", pl_lon="plon", metres=100.0)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        for how in ("inner", "left"):
            plain = J.near_join(ev, pl, how=how, **args)
            got = J.near_join(ev, pl, how=how, heavy_rows=50, salts=16, **args)
            assert got.columns == plain.columns and sorted(rows(got), key=str) == sorted(rows(plain), key=str)
        none = J.near_join(ev, pl.limit(0), how="left", heavy_rows=50, salts=16, **args)
        sizes = [r[0] for r in none.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < len(events) / 4 and sum(sizes) == len(events) + 5
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


# ---- latest versions kept up by merging

def test_merged_versions_equal_the_whole_log(spark):
    rng = random.Random(6)
    log = [(rng.choice([1, 1, *range(2, 60), None]), rng.randint(0, 30), rng.choice("abc")) for _ in range(500)]
    df = lambda data: spark.createDataFrame(data, "k long, v long, x string")
    for part in (V.key_range("k", 10), V.key_hash(["k"], 3)):
        path = tempfile.mkdtemp(prefix="cohortflow-latest-") + "/t"
        pieces = [log[i::4] for i in range(4)]
        for piece in (*pieces, pieces[0], []):
            table = V.merge_latest(path, df(piece), ["k"], ["v"], part)
        assert sorted(rows(table), key=str) == sorted(rows(latest_by(df(log), ["k"], ["v", "x"])), key=str)


def test_a_merge_replaces_only_the_parts_it_touches(spark):
    path = tempfile.mkdtemp(prefix="cohortflow-latest-") + "/t"
    V.merge_latest(path, spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")), ["k"], ["v"], V.key_range("k", 10))
    before = {f: os.path.getmtime(f) for f in glob.glob(path + "/*/*.parquet")}
    V.merge_latest(path, spark.createDataFrame([(42, 5), (43, 0)], "k long, v int"), ["k"], ["v"], V.key_range("k", 10))
    after = {f: os.path.getmtime(f) for f in glob.glob(path + "/*/*.parquet")}
    assert {f.split("/")[-2] for f in set(before) - set(after)} == {"part=4"} and len(set(before) & set(after)) >= 9
    assert rows(spark.read.parquet(path).where("k IN (42, 43)").select("k", "v").orderBy("k")) == [(42, 5), (43, 1)]


# ---- tables laid out by day

@pytest.fixture(scope="module")
def status(spark):
    path = tempfile.mkdtemp(prefix="cohortflow-days-") + "/status"
    df = Sources(spark, SF01).platform_status
    write_days(df, path)
    return path, df.schema


def scan(df):
    """Number of folders and files that the scan of the result read, after running it."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(p.plan())
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            m = p.metrics()
            found.append((m.apply("numPartitions").value(), m.apply("numFiles").value()))
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(plan)
    return found


def test_a_window_reads_its_days_only(spark, status):
    path, schema = status
    t = spark.read.schema(schema).parquet(path)
    W = T.EVENTS_W
    df = S.scan_window(t, "day", W.anchor - dt.timedelta(days=3), W.anchor)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan) and "PushedFilters: []" in plan
    assert [n for n, _ in scan(df)] == [3] and df.count() > 0
    assert [n for n, _ in scan(S.exact_snapshot(t, "day", W.anchor))] == [1]


def test_the_latest_snapshot_reads_one_day(spark, status):
    path, schema = status
    df = S.latest_snapshot(spark.read.schema(schema).parquet(path), "day", T.EVENTS_W.anchor, 3)
    assert [n for n, _ in scan(df)] == [1]
    assert {r["day"] for r in df.select("day").distinct().collect()} == {T.EVENTS_W.anchor - dt.timedelta(days=1)}


def test_days_come_from_folder_names(spark, status):
    path, schema = status
    days = partition_days(spark, path, schema)
    assert days == sorted(r[0] for r in spark.read.schema(schema).parquet(path).select("day").distinct().collect()) and len(days) > 20
    flat = tempfile.mkdtemp(prefix="cohortflow-flat-") + "/t"
    spark.createDataFrame([(day(1),), (day(0),), (None,), (day(1),)], "day date").write.parquet(flat)
    assert partition_days(spark, flat, spark.read.parquet(flat).schema) == [day(0), day(1)]
    assert partition_days(spark, flat + "-none", schema) == []


def test_a_day_is_a_few_files(spark, status):
    path, schema = status
    t = spark.read.schema(schema).parquet(path)
    assert max(n for _, n in scan(S.exact_snapshot(t, "day", T.EVENTS_W.anchor))) <= 2


# ---- feature tables in buckets

def test_stored_features_join_without_an_exchange(spark):
    src, W = P.ReactivationSources.from_testbed(Sources(spark, SF01)), T.ANCHOR_DAY_W
    store = FS.FeatureStore(spark, ensure_checkpoint_dir(spark), 4)
    FS.store_reactivation(store, src, W)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = FS.reactivation_from(store, W)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 8
        ref = P.reactivation_features(src, W)
        assert compare(got.columns, rows(got), ref.columns, rows(ref)) == [] and ref.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        store.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(store.name)]


# ---- cohorts of many anchors

def test_cohorts_of_each_anchor_equal_the_single_jobs(spark):
    s, windows = Sources(spark, SF01), T.COHORT_WINDOWS
    many = X.cohorts(*X.cohort_table(s.trips, s.first_orders), windows).cache()
    for W in windows:
        of = many.where(F.col("anchor_date") == W.anchor)
        ref = X.stamp_anchor(X.adoption_cohort(s.trips, s.first_orders, W), W)
        got = of.drop("crossed_a", "crossed_b")
        assert compare(got.columns, rows(got), ref.columns, rows(ref)) == []
        for service, mine in (("a", "food_first_order_date"), ("b", "shop_first_order_date")):
            ref = X.crossed_on(s.trips, s.first_orders, W, service).select("customer_id", "ride_first_order_date", mine)
            got = of.where(f"crossed_{service}").select(ref.columns)
            assert sorted(rows(got)) == sorted(rows(ref))
    assert many.where("crossed_a").count() > 0 and many.select("anchor_date").distinct().count() >= 3
    many.unpersist()


def test_cohort_states_of_new_days_merge(spark):
    s, windows = Sources(spark, SF01), T.COHORT_WINDOWS[:2]
    cut = dt.date(1995, 6, 1)
    parts = [X.cohort_table(s.trips.where(c), s.first_orders) for c in (F.col("day") < cut, F.col("day") >= cut)]
    words = D.merged(parts[0][1].unionByName(parts[1][1]), ["customer_id"])
    a = windows
    assert sorted(rows(X.cohorts(parts[0][0], words, a)), key=str) == sorted(rows(X.cohorts(*X.cohort_table(s.trips, s.first_orders), a)), key=str)


def test_queries_are_registered():
    assert {"job_cohorts_many", "job_reactivation_features_many", "job_reactivation_features_stored", "latest_snapshot_by_day", "scan_window_by_day",
            "agg_active_days_merged", "agg_active_days_anchors", "norm_key_rejects", "win_latest_merged", "join_proximity_salted"} <= set(queries())
