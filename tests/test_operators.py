"""Operators on hand-made rows: ties, NULLs, skewed keys, equivalences with brute force."""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.geo import haversine_m
from cohortflow.operators import aggregates as A
from cohortflow.operators import filters as FL
from cohortflow.operators import joins as J
from cohortflow.operators import scans as S
from cohortflow.operators import windows as WN


def test_latest_by_ties_and_nulls(spark):
    rows = [(1, dt.date(2024, 1, 2), 1, "a"), (1, dt.date(2024, 1, 2), 2, "b"), (1, None, 9, "z"),
            (2, None, 1, "n"), (2, dt.date(2024, 1, 1), 0, "m")]
    df = spark.createDataFrame(rows, "k int, day date, tie int, v string")
    got = {r.k: r.v for r in WN.latest_by(df, ["k"], ["day", "tie"], ["v"]).collect()}
    # DESC NULLS LAST with the tie column deciding (T4, T5)
    assert got == {1: "b", 2: "m"}


def test_rank_within_matches_window_on_skewed_key(spark):
    rnd = random.Random(7)
    rows = [(0, rnd.randint(0, 50), i) for i in range(3000)]          # hot key: ~1/3+ of rows
    rows += [(rnd.randint(1, 300), rnd.randint(0, 50), 10_000 + i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, ts int, id int")
    got = WN.rank_within(df, "k", [F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last()], out="rn",
                         num_partitions=8)
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = df.withColumn("rn", F.row_number().over(w))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))
    dense = WN.rank_within(df, "k", ["ts"], out="dr", dense=True, num_partitions=8)
    ref = df.withColumn("dr", F.dense_rank().over(w.orderBy("ts")))
    assert sorted(map(tuple, dense.select("id", "dr").collect())) == sorted(map(tuple, ref.select("id", "dr").collect()))


def test_top_k_and_top1(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 3), (1, "c", 1), (2, "x", 1)], "k int, c string, n long")
    top = {(r.k, r.c) for r in WN.top_k(df, "k", [F.col("n").desc(), F.col("c").asc()], 2).collect()}
    assert top == {(1, "a"), (1, "b"), (2, "x")}
    t1 = {r.k: (r.c, r.n) for r in WN.top1_by_count(df, "k", "c", "n", 2).collect()}
    assert t1 == {1: ("a", 3)}  # equal counts -> smallest category; key 2 under the minimum -> no row


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "a", 5)], "k int, c string, cnt long")
    s = WN.share_of_total(df, "k", "cnt", "pct").groupBy("k").agg(F.sum("pct").alias("t")).collect()
    assert all(abs(r.t - 100.0) < 1e-9 for r in s)


def test_dominant_bucket_tie_goes_later(spark):
    df = spark.createDataFrame([(10.0, 10.0, 5.0, 5.0), (50.0, 20.0, 20.0, 10.0), (0.0, 0.0, 0.0, 0.0),
                                (10.0, 30.0, 30.0, 30.0)], "Morning double, Day double, Evening double, Night double")
    expr = A.dominant_bucket({b: F.col(b) for b in R.TIME_OF_DAY_ORDER}, R.COMMUTER_LABELS, R.COMMUTER_LABELS["Night"])
    got = [r[0] for r in df.select(expr).collect()]
    assert got == ["Day Commuter", "Morning Commuter", "Night Commuter", "Night Commuter"]


def test_argmax_by_tie_smallest_cell(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "a", 1), (2, "z", 1)], "customer_id int, cell string, n int")
    got = {r.customer_id: (r.cell, r.tot) for r in A.argmax_by(df, key="customer_id", cat="cell", value="n",
                                                                out_value="tot").collect()}
    assert got == {1: ("a", 2), 2: ("z", 1)}


def test_area_stats_drops_null_area(spark):
    df = spark.createDataFrame([("x", True), ("x", False), (None, True)], "area string, flag boolean")
    got = [tuple(r) for r in A.area_stats(df, area="area", flag="flag", n_name="n", k_name="k").collect()]
    assert got == [("x", 2, 1)]


def test_flag_exists_no_fanout(spark):
    trips = spark.createDataFrame([(1,), (2,)], "booking_id long")
    credits = spark.createDataFrame([(1,), (1,), (3,)], "booking_id long")  # duplicate booking (T11)
    got = sorted(tuple(r) for r in J.flag_exists(trips, credits, "booking_id", "booking_id", "f").collect())
    assert got == [(1, True), (2, False)]


def test_restrict_to_semi(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "customer_id long, v string")
    base = spark.createDataFrame([(1,), (1,)], "customer_id long")
    assert sorted(r.v for r in J.restrict_to(df, base, "customer_id").collect()) == ["a", "b"]


def test_near_join_equals_brute_force(spark):
    rnd = random.Random(3)
    step = 0.0003
    ev = [(rnd.randint(0, 5), i, 25 + rnd.randint(0, 30) * step, 55 + rnd.randint(0, 30) * step, rnd.randint(0, 9))
          for i in range(600)]
    pl = [(rnd.randint(0, 5), 1000 + j, 25 + rnd.randint(0, 30) * step, 55 + rnd.randint(0, 30) * step, rnd.randint(0, 9))
          for j in range(120)]
    e = spark.createDataFrame(ev, "customer_id int, booking_id int, lat double, lon double, t int")
    p = spark.createDataFrame(pl, "pc int, location_id int, plat double, plon double, ct int")
    got = J.near_join(e, p, key="customer_id", place_key="pc", ev_lat="lat", ev_lon="lon", pl_lat="plat", pl_lon="plon",
                      metres=100.0, extra=F.col("t") > F.col("ct"))
    pairs = sorted((r.booking_id, r.location_id) for r in got.select("booking_id", "location_id").collect())

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
        return 1000 * 2 * R.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, x)))

    brute = sorted((b, loc) for (c, b, la, lo, t) in ev for (pc, loc, pla, plo, ct) in pl
                   if c == pc and t > ct and hav(la, lo, pla, plo) < 100.0)
    assert pairs == brute and len(brute) > 20
    left = J.near_join(e, p, key="customer_id", place_key="pc", ev_lat="lat", ev_lon="lon", pl_lat="plat",
                       pl_lon="plon", metres=100.0, how="left")
    assert left.select("booking_id").distinct().count() == 600  # unmatched events are kept


def test_exclude_like_drops_nulls(spark):
    df = spark.createDataFrame([("work", "x"), ("home", "x"), ("gym", None), (None, "x")], "n string, b string")
    got = [r.n for r in FL.exclude_like(df, {"n": ["%home%"], "b": ["%villa%"]}, require_not_null=["n"]).collect()]
    assert got == ["work"]  # T6: NULL in a NOT LIKE column drops the row


def test_latest_snapshot_bounded_lookback(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2024, 1, 17), 1), (d(2024, 1, 18), 2), (d(2024, 1, 20), 3), (d(2024, 1, 21), 4)],
                               "day date, v int")
    assert [r.v for r in S.latest_snapshot(df, "day", d(2024, 1, 21), 3).collect()] == [3]
    old = df.where(F.col("day") < d(2024, 1, 18))
    assert S.latest_snapshot(old, "day", d(2024, 1, 21), 3).count() == 0  # nothing in the lookback -> empty


def test_union_ranges_equals_single_range(spark):
    d = dt.date
    days = [d(2011, 12, 31), d(2012, 1, 1), d(2015, 12, 31), d(2016, 1, 1), d(2024, 1, 20), d(2024, 1, 21)]
    df = spark.createDataFrame([(x, 1) for x in days] * 2, "day date, v int")
    one = S.scan_window(df, "day", d(2012, 1, 1), d(2024, 1, 21)).distinct()
    many = S.union_ranges(df, "day", [(d(2012, 1, 1), d(2015, 12, 31), True), (d(2016, 1, 1), d(2024, 1, 21), False)])
    assert sorted(one.collect()) == sorted(many.distinct().collect())
    assert one.count() == 4  # anchor day and the day after are excluded (T10)


def test_first_dates_one_pass(spark):
    d = dt.date
    df = spark.createDataFrame([(1, "food", d(2024, 1, 3)), (1, "food", d(2024, 1, 1)), (1, "limo", d(2023, 1, 1)),
                                (2, "shop", d(2024, 2, 1)), (3, "other", d(2024, 1, 1))], "k int, s string, dd date")
    got = {r.k: tuple(r)[1:] for r in A.first_dates(df, key="k", service_col="s", date_col="dd",
                                                    services={"base": ["ride_hailing", "limo"], "a": ["food"],
                                                              "b": ["shop"]}).collect()}
    assert got == {1: (d(2023, 1, 1), d(2024, 1, 1), None), 2: (None, None, d(2024, 2, 1))}


def test_haversine_symmetry(spark):
    df = spark.createDataFrame([(25.1, 55.2, 25.3, 55.1)], "a double, b double, c double, d double")
    r = df.select(haversine_m("a", "b", "c", "d").alias("x"), haversine_m("c", "d", "a", "b").alias("y")).first()
    assert abs(r.x - r.y) < 1e-6


def test_near_join_antimeridian_and_pole(spark):
    rnd = random.Random(11)
    ev, pl = [], []
    for i in range(300):
        # half near the antimeridian, half within 0.01 deg of the north pole
        if i % 2:
            lat, lon = rnd.uniform(-0.002, 0.002), rnd.choice([179.9995, -179.9995, 179.9999, -179.9991])
        else:
            lat, lon = 89.9995 - rnd.uniform(0, 0.01), rnd.uniform(-180, 180)
        ev.append((1, i, lat, lon))
        pl.append((1, 1000 + i, lat + rnd.uniform(-0.0008, 0.0008), lon + rnd.uniform(-0.0008, 0.0008)))
    pl = [(c, loc, la, ((lo + 180.0) % 360.0) - 180.0) for c, loc, la, lo in pl]
    e = spark.createDataFrame(ev, "customer_id int, booking_id int, lat double, lon double")
    p = spark.createDataFrame(pl, "pc int, location_id int, plat double, plon double")
    got = J.near_join(e, p, key="customer_id", place_key="pc", ev_lat="lat", ev_lon="lon", pl_lat="plat",
                      pl_lon="plon", metres=100.0)
    pairs = sorted((r.booking_id, r.location_id) for r in got.select("booking_id", "location_id").collect())

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
        return 1000 * 2 * R.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, x)))

    brute = sorted((b, loc) for (_, b, la, lo) in ev for (_, loc, pla, plo) in pl if hav(la, lo, pla, plo) < 100.0)
    assert pairs == brute and len(brute) > 50


def test_rank_within_splits_a_group_of_copies(spark):
    """A third of the rows are exact copies (same key and order value): still ranked 1..n, and the
    copies are spread over several range partitions."""
    rows = [(0, 5)] * 3000 + [(k % 300 + 1, k % 17) for k in range(6000)]
    df = spark.createDataFrame(rows, "k int, ts int")
    got = WN.rank_within(df, "k", [F.col("ts").asc_nulls_last()], out="rn", num_partitions=8)
    hot = sorted(r.rn for r in got.where("k = 0").collect())
    assert hot == list(range(1, 3001))
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    spread = (df.withColumn("__salt", F.monotonically_increasing_id())
                .repartitionByRange(8, "k", "ts", "__salt").where("k = 0")
                .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1


def test_rank_within_automatic_partitions_on_skewed_key(spark):
    """Without an explicit partition count AQE may merge adjacent ranges; ranks stay exact."""
    rnd = random.Random(9)
    rows = [(0, rnd.randint(0, 30), i) for i in range(2000)] + [(rnd.randint(1, 200), rnd.randint(0, 30), 5000 + i)
                                                                 for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, ts int, id int").repartition(5)
    got = WN.rank_within(df, "k", [F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last()], out="rn")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))
