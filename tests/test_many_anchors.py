"""A list of anchors in one plan gives what the single-anchor job gives for each; the states behind it are exact."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.keysets import KeySet
from cohortflow.operators.states import GREATEST, LEAST, SUM, cumulated, order_events
from cohortflow.plans import many_anchors as MA
from cohortflow.plans import reactivation as P
from cohortflow.session import cut_lineage
from cohortflow.sources import testbed as T
from cohortflow.sources.testbed import Sources
from cohortflow.streaming.daily import window_for
from oracle.compare import compare
from tests.conftest import SF01

DAY0 = dt.date(2024, 1, 1)


def day(k):
    return DAY0 + dt.timedelta(days=k)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("blended", [False, True])
def test_each_anchor_equals_the_single_anchor_job(spark, blended):
    src = P.ReactivationSources.from_testbed(Sources(spark, SF01))
    anchors = [dt.date(1999, 5, 12), dt.date(1999, 5, 13), dt.date(2001, 9, 17), dt.date(2030, 1, 1)]  # the last day has no order
    start, cities = dt.date(1997, 1, 1), (1, 2) if blended else (1,)
    many = MA.reactivation_features(src, anchors, start, 20, cities, not blended, blended).cache()
    assert many.count() > 20
    for a in anchors:
        got = many.where(F.col("anchor") == a).drop("anchor")
        ref = P.reactivation_features(src, window_for(a, start, 20), cities, not blended, blended)
        assert compare(got.columns, rows(got), ref.columns, rows(ref)) == [], a
    many.unpersist()


def test_the_history_is_scanned_once(spark):
    src = P.ReactivationSources.from_testbed(Sources(spark, SF01))
    plans = [MA.reactivation_features(src, a, dt.date(1997, 1, 1), 20)._jdf.queryExecution().optimizedPlan().toString().count("Relation")
             for a in ([day(0)], [day(k) for k in range(40)])]
    assert plans[0] == plans[1]


def test_each_fact_table_is_joined_once(spark, monkeypatch):
    """The joins of lines and orders below all that is written and returned: one for each of anchor days, order lines, rides and food."""
    plans = []
    monkeypatch.setattr(MA, "cut_lineage", lambda df: plans.append(df) or cut_lineage(df))
    src = P.ReactivationSources.from_testbed(Sources(spark, SF01))
    plans.append(MA.reactivation_features(src, [dt.date(1999, 5, 12), dt.date(2000, 1, 21)], dt.date(1997, 1, 1), 20))
    lines = [p._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") > 0 for p in plans]
    scans = sum(sum("Relation" in x and "l_orderkey#" in x for x in p._jdf.queryExecution().optimizedPlan().toString().split("\n")) for p in plans)
    assert sum(lines) == scans == 3  # the anchor days were written by their ranking


def history(seed=3, n=400):
    """customer, order, day, amount; a third of the rows of one customer; orders of several days, null ids, repeated rows."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        c = 1 if rng.random() < 0.34 else rng.randint(2, 6)
        o = None if rng.random() < 0.05 else rng.randint(1, 40) * 10 + c
        out.append((c, o, day(rng.randint(0, 90)), rng.randint(-5, 50)))
    return out + out[:20]


def test_states_equal_brute_force(spark):
    data, recent = history(), 7
    df = spark.createDataFrame(data, "c long, o long, d date, x long").repartition(5)
    df = df.withColumns({"at": F.date_add("d", 1), "until": F.date_add("d", recent)})
    events = [df.groupBy("c", "at").agg(F.sum("x").alias("x"), F.min("d").alias("first"), F.max("d").alias("last")),
              order_events(df, "c", "o", "at", "until", "n", "n_recent")]
    anchors = [day(k) for k in (-3, 0, 1, 8, 30, 31, 60, 97, 98, 200)]
    asked = spark.createDataFrame([(c, a) for c in range(1, 8) for a in anchors], "c long, anchor date")
    got = cumulated(events, asked.union(asked), "c", {"x": SUM, "first": LEAST, "last": GREATEST, "n": SUM, "n_recent": SUM})
    want = set()
    for c in range(1, 8):
        for a in anchors:
            seen = [r for r in data if r[0] == c and r[2] < a]
            days = [r[2] for r in seen]
            want.add((c, a, sum(r[3] for r in seen), min(days, default=None), max(days, default=None), len({r[1] for r in seen} - {None}),
                      len({r[1] for r in seen if (a - r[2]).days <= recent} - {None})))
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)


def test_states_of_disjoint_orders_merge(spark):
    df = spark.createDataFrame(history(), "c long, o long, d date, x long").withColumn("at", F.date_add("d", 1))
    asked = df.select("c", F.lit(day(60)).alias("anchor")).distinct()
    whole = cumulated([order_events(df, "c", "o", "at")], asked, "c", {"n": SUM})
    halves = [order_events(df.where(F.col("o") % 20 < 10), "c", "o", "at"), order_events(df.where(F.col("o") % 20 >= 10), "c", "o", "at")]
    assert sorted(rows(whole)) == sorted(rows(cumulated(halves, asked, "c", {"n": SUM})))


def test_states_of_nothing(spark):
    none = spark.createDataFrame([], "c long, o long, at date")
    asked = spark.createDataFrame([(1, day(0))], "c long, anchor date")
    assert rows(cumulated([order_events(none, "c", "o", "at")], asked, "c", {"n": SUM})) == [(1, day(0), 0)]
    assert rows(cumulated([order_events(none, "c", "o", "at")], asked.limit(0), "c", {"n": SUM})) == []


def test_key_set_keeps_every_key_of_the_set(spark):
    keys = spark.range(0, 3000, 7).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,)], "k long"))
    facts = spark.range(0, 3000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("x")).unionByName(spark.createDataFrame([(None, 1)], "k long, x long"))
    for words in (1 << 12, 2):  # with two words nearly all bits are set: fewer rows go, none is lost
        s = KeySet(keys, "k", words)
        likely = s.likely(facts)
        assert sorted(rows(s.exactly(likely))) == sorted(rows(facts.join(keys, "k", "left_semi")))
        assert likely.count() < 800 if words > 2 else likely.count() <= 3000
        assert likely.columns == facts.columns and likely.where("k IS NULL").isEmpty()
    assert KeySet(keys.limit(0), "k").likely(facts).isEmpty()


def test_other_customers_do_not_reach_the_shuffle(spark):
    """Between the scan of each history and its first exchange stands the key set's broadcast join."""
    W = T.ANCHOR_DAY_W
    src = P.ReactivationSources.from_testbed(Sources(spark, SF01))
    keys = KeySet(spark.createDataFrame([(5,)], "customer_id long"))
    value = P.value_features(spark.createDataFrame([(5,)], "customer_id long"), src, W, restrict=keys)
    plan = value._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__bits") >= 4
    assert P.ride_value(keys.likely(P.with_key(src.trips), "__key"), W).count() <= 3 < P.ride_value(src.trips, W).count()
