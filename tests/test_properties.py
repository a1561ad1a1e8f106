"""Property tests: native expressions against plain-Python references on generated inputs."""

from __future__ import annotations

import math
import struct

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortflow import rules as R
from cohortflow.functions import bands as B
from cohortflow.functions import geo as G

coords = st.floats(min_value=-180.0, max_value=180.0, allow_nan=False, allow_infinity=False).filter(
    lambda x: x == 0.0 or abs(x) > 1e-300)


def _ewkb(lat: float, lon: float) -> str:
    return "0101000020E6100000" + struct.pack("<d", lon).hex() + struct.pack("<d", lat).hex()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(coords, coords), min_size=1, max_size=40))
def test_decode_point_roundtrip(spark, pts):
    df = spark.createDataFrame([(_ewkb(a, b),) for a, b in pts], "h string").select(G.decode_point("h").alias("p"))
    got = [(r.p.lat, r.p.lon) for r in df.collect()]
    assert got == [(a if a != 0 else 0.0, b if b != 0 else 0.0) for a, b in pts]


def _py_band(v, rules, else_=None):
    if v is None:
        return else_
    for lo, hi, label in rules:
        if (lo is None or v >= lo) and (hi is None or v <= hi):
            return label
    return else_


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-20, max_value=200)), min_size=1, max_size=60))
def test_bands_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    rows = df.select(B.band("v", R.ORDER_COUNT_BANDS).alias("a"),
                     B.band("v", R.RECENCY_BANDS, R.RECENCY_ELSE).alias("b"),
                     B.band("v", R.LAST_SEEN_BANDS, R.LAST_SEEN_ELSE, R.LAST_SEEN_NULL).alias("c")).collect()
    for v, r in zip(values, rows):
        assert r.a == _py_band(v, R.ORDER_COUNT_BANDS)
        assert r.b == _py_band(v, R.RECENCY_BANDS, R.RECENCY_ELSE)
        assert r.c == (R.LAST_SEEN_NULL if v is None else _py_band(v, R.LAST_SEEN_BANDS, R.LAST_SEEN_ELSE))


def _py_hav(a, b, c, d, radius=R.EARTH_RADIUS_KM):
    p1, p2 = math.radians(a), math.radians(c)
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
    return 1000 * 2 * radius * math.asin(math.sqrt(min(1.0, x)))


lat = st.floats(min_value=-89.0, max_value=89.0, allow_nan=False)
lon = st.floats(min_value=-179.0, max_value=179.0, allow_nan=False)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(lat, lon, lat, lon), min_size=1, max_size=40))
def test_haversine_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(G.haversine_m("a", "b", "c", "d")).collect()]
    for (a, b, c, d), g in zip(rows, got):
        assert abs(g - _py_hav(a, b, c, d)) <= 1e-6 * max(1.0, g)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2, 3, None]), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=120),
       st.integers(min_value=1, max_value=6))
def test_rank_within_matches_windows(spark, rows, parts):
    """row_number / dense_rank from range-partitioned ranks equal Spark's windows for any mix of a
    hot key, NULL keys, NULL and repeated order values, and partition counts."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from cohortflow.operators.windows import rank_within

    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k int, t int, id int")
    got = rank_within(df, "k", [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()], out="r", num_partitions=parts)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    ref = df.withColumn("r", F.row_number().over(w))
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, ref.select("id", "r").collect()))
    dense = rank_within(df, "k", ["t"], out="d", dense=True, num_partitions=parts)
    ref_d = df.withColumn("d", F.dense_rank().over(Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last())))
    assert sorted(map(tuple, dense.select("id", "d").collect())) == sorted(map(tuple, ref_d.select("id", "d").collect()))
