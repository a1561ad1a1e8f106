"""Column expressions on hand-made edge rows (FIXTURES part D)."""

from __future__ import annotations

import datetime as dt
import math
import struct

from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions import bands as B
from cohortflow.functions import geo as G
from cohortflow.functions import measures as M
from cohortflow.functions.keys import norm_key


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_order_count_and_recency_bands(spark):
    got = _col(spark, [(v,) for v in (0, 1, 2, 4, 5, 10, 11)], "n int", B.band("n", R.ORDER_COUNT_BANDS))
    assert got == ["0", "1", "2-4", "2-4", "5-10", "5-10", "10+"]
    rec = (30, 31, 45, 46, 60, 90, 120, 121, None)
    got = _col(spark, [(v,) for v in rec], "n int", B.band("n", R.RECENCY_BANDS, R.RECENCY_ELSE))
    # The first label covers everything up to 45; NULL falls to the else label
    assert got == ["30-45", "30-45", "30-45", "45-60", "45-60", "60-90", "90-120", "120+", "120+"]


def test_last_seen_band_null_and_negative(spark):
    got = _col(spark, [(None,), (0,), (7,), (8,), (120,), (121,), (-3,)], "n int",
               B.band("n", R.LAST_SEEN_BANDS, R.LAST_SEEN_ELSE, R.LAST_SEEN_NULL))
    assert got == ["n/a", "0-7", "0-7", "8-14", "91-120", "120+", "120+"]


def test_spend_gap_and_null(spark):
    # 24 < avg <= 25 is low, NULL spend is low, NULL distance has no band
    vals = [24.0, 24.5, 25.0, 25.01, None]
    spend = _col(spark, [(v,) for v in vals], "x double", B.compare_band("x", R.SPEND_RULES, R.SPEND_ELSE))
    assert spend == ["medium", "low", "low", "high", "low"]
    dist = _col(spark, [(v,) for v in (12.0, 16.0, 16.01, 11.99, None)], "x double", B.compare_band("x", R.DISTANCE_RULES))
    assert dist == ["medium", "medium", "high", "low", None]


def test_time_of_day_bucket_local_shift(spark):
    ts = [dt.datetime(2024, 1, 1, h, 30) for h in (1, 2, 5, 6, 11, 12, 15, 16, 23)]
    got = _col(spark, [(t,) for t in ts] + [(None,)], "ts timestamp_ntz",
               B.hour_bucket("ts", 4, R.TIME_OF_DAY_RULES, R.TIME_OF_DAY_ELSE))
    # +4h: 5,6,9,10,15,16,19,20,3 ; NULL -> Night
    assert got == ["Night", "Morning", "Morning", "Day", "Day", "Evening", "Evening", "Night", "Night", "Night"]


def test_membership_type_rules(spark):
    rows = [("Regular", "1", "x"), ("monthly", "23", "x"), ("monthly", "1", "x-free-renewal-y"),
            ("monthly", "1", "inv_freeXrenewal"), ("Trial_No_Commitment", "1", "x"), ("Free Trial", "1", "x"),
            ("annual", "1", "x"), ("trial_x", "1", "x")]
    expr = B.membership_type("t", "p", "i", paid_types=R.PAID_SUBSCRIPTION_TYPES, paid_plans=R.PAID_PLAN_IDS,
                             free_renewal=R.FREE_RENEWAL_PATTERN, trial_commitment=R.TRIAL_COMMITMENT_PATTERN,
                             trial=R.TRIAL_PATTERN)
    got = _col(spark, rows, "t string, p string, i string", expr)
    # T7: '_' in the pattern matches any character
    assert got == ["paid", "paid", "paid", "paid", "trial_without_commitment", "trial", None, None]


def test_adoption_label_cases(spark):
    a, e = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    d = dt.date
    rows = [(d(2023, 1, 1), None, None),            # base-only
            (d(2024, 1, 5), None, None),            # base after the anchor -> NULL
            (d(2023, 1, 1), d(2024, 1, 1), None),   # +A on the anchor
            (d(2023, 1, 1), None, d(2024, 1, 31)),  # +B
            (d(2023, 1, 1), d(2024, 1, 2), d(2024, 1, 3)),
            (d(2023, 1, 1), d(2023, 12, 31), None),  # A before the anchor -> NULL (T24)
            (d(2023, 1, 1), d(2024, 2, 1), None),   # A exactly at the end (exclusive) -> NULL
            (d(2023, 1, 1), d(2024, 1, 2), d(2023, 6, 1))]
    got = _col(spark, rows, "b date, a date, c date", B.adoption_label("b", "a", "c", a, e, R.ADOPTION_LABELS))
    only, a_, b_, ab = R.ADOPTION_LABELS
    assert got == [only, None, a_, b_, ab, None, None, None]


def test_between_flag_inclusive(spark):
    got = _col(spark, [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 21),), (dt.date(2024, 1, 22),), (None,)], "d date",
               B.between_flag("d", dt.date(2024, 1, 1), dt.date(2024, 1, 21)))
    assert got == [True, True, False, False]


def test_clean_category_and_place_class(spark):
    got = _col(spark, [(" Male",), ("FEMALE ",), ("unknown",), (None,)], "s string", B.clean_category("s", R.GENDER_VALUES))
    assert got == ["male", "female", None, None]
    names = [("my office",), ("gym",), ("uni campus",), ("terminal 3",), ("city mall",), ("premier inn",), ("clinic",),
             ("mom",), ("emirates towers",)]
    got = _col(spark, names, "n string", B.place_class("n", F.lit("x"), R.PLACE_CLASSES))
    # first match wins: 'emirates towers' is a mall by pattern order
    assert got == ["work", "sport", "school", "airport", "mall", "hotel", "hospital", "mom", "mall"]


def test_elapsed_vs_calendar_days(spark):
    anchor = dt.date(2024, 1, 21)
    ts = [dt.datetime(2024, 1, 20, 13, 0), dt.datetime(2024, 1, 20, 0, 0), dt.datetime(2024, 1, 22, 13, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    rows = df.select(M.elapsed_days("ts", anchor), M.calendar_days("ts", anchor), M.days_since(anchor, "ts")).collect()
    # 13:00 the day before is 0 whole days but 1 calendar day; negatives truncate toward zero
    assert [tuple(r) for r in rows] == [(0, 1, -1), (1, 1, -1), (-1, -1, 1)]


def test_safe_ratio_and_blended(spark):
    df = spark.createDataFrame([(10.0, 4), (10.0, 0), (None, 2)], "x double, n int")
    assert [r[0] for r in df.select(M.safe_ratio("x", "n")).collect()] == [2.5, None, None]
    df = spark.createDataFrame([(1.0, 2.0, None, 1, 0, None), (0.0, 0.0, 0.0, 0, 0, 0)],
                               "a double, b double, c double, na int, nb int, nc int")
    got = [r[0] for r in df.select(M.blended_margin(["a", "b", "c"], ["na", "nb", "nc"])).collect()]
    assert got == [3.0, None]  # T13: zero divisor -> NULL, not an error


def test_wilson_lower_bounds(spark):
    rows = [(0, 0), (0, 10), (10, 10), (5, 11), (3, 4)]
    got = _col(spark, rows, "k long, n long", M.wilson_lower("k", "n", 0.95))
    assert got[0] == 0.0
    for (k, n), w in zip(rows[1:], got[1:]):
        assert 0.0 <= w <= k / n + 1e-12
    z = 1.959963984540054
    p = 5 / 11
    ref = (p + z * z / 22 - z * math.sqrt((p * (1 - p) + z * z / 44) / 11)) / (1 + z * z / 11)
    assert abs(got[3] - ref) < 1e-12


def _ewkb(lat, lon, srid=True):
    body = struct.pack("<d", lon).hex().upper() + struct.pack("<d", lat).hex().upper()
    return ("0101000020E6100000" if srid else "0101000000") + body


def test_decode_point_exact(spark):
    pts = [(25.2048, 55.2708), (0.0, 0.0), (-33.8688, -151.2093), (1e-3, 179.999)]
    rows = [(_ewkb(a, b),) for a, b in pts] + [(_ewkb(1.5, 2.5, srid=False),), ("00FF",), (None,)]
    df = spark.createDataFrame(rows, "h string").select(G.decode_point("h").alias("p"))
    got = [(r.p.lat, r.p.lon) if r.p is not None else None for r in df.collect()]
    assert got[:4] == pts
    assert got[4] == (1.5, 2.5)
    assert got[5] is None and got[6] is None


def test_decode_point_payload_with_srid_bytes(spark):
    # A coordinate whose bytes contain the SRID pattern must still decode (fixed offsets)
    lon = struct.unpack("<d", bytes.fromhex("20E6100000000040"))[0]
    h = _ewkb(10.0, lon)
    assert "20E61000" in h[18:]
    r = spark.createDataFrame([(h,)], "h string").select(G.decode_point("h").alias("p")).first().p
    assert (r.lat, r.lon) == (10.0, lon)


def test_haversine_and_round(spark):
    df = spark.createDataFrame([(25.0, 55.0, 25.0, 55.0), (25.0, 55.0, 25.0009, 55.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(G.haversine_m("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert abs(got[1] - 100.07) < 0.05  # ~0.0009 deg of latitude
    lat, lon = G.round_point(F.lit(25.12345), F.lit(55.9876), 3)
    r = spark.range(1).select(lat, lon).first()
    assert (r[0], r[1]) == (25.123, 55.988)


def test_hex_cell_neighbourhood(spark):
    # points 1 km apart share a cell or are neighbours; far points differ
    rows = [(25.0, 55.0), (25.001, 55.0), (25.5, 55.5)]
    got = _col(spark, rows, "a double, b double", G.hex_cell("a", "b", R.HEX_EDGE_KM))
    assert got[0] == got[1]
    assert got[0] != got[2]
    assert all(":" in c for c in got)


def test_norm_key(spark):
    got = _col(spark, [("CPLS-123",), ("CPLS-x1",), (None,)], "s string", norm_key("s", 5))
    assert got == [123, None, None]
    got = _col(spark, [(" 42",), ("7",)], "s string", norm_key("s"))
    assert got == [42, 7]


def test_taxonomy_rows_fixed_values():
    rows = dict(R.taxonomy_rows())
    assert rows["smoothies "] == "Healthy & Specialty" and rows["smoothies"] == "Healthy & Specialty"
    assert len(set(rows.values())) == 15
    assert len(rows) == 145  # 146 listed, one listed twice


def test_hex_cells_equal_area_across_latitudes(spark):
    """Boxes of equal ground area at the equator and at 60 degrees hold about as many cells."""
    def cells(lat0, dlat, dlon):
        pts = [(lat0 + i * dlat / 60, j * dlon / 60) for i in range(60) for j in range(60)]
        return len(set(_col(spark, pts, "a double, b double", G.hex_cell("a", "b", R.HEX_EDGE_KM))))
    equator, north = cells(0.0, 1.0, 1.0), cells(60.0, 1.0, 2.0)  # 2 deg of longitude at 60N = 1 deg at 0
    assert equator > 250 and abs(equator - north) / equator < 0.15


def test_staged_decode_equals_expression(spark):
    rows = [(_ewkb(25.5, 55.25),), (_ewkb(-1.0, 2.0, srid=False),), ("junk",), (None,)]
    df = spark.createDataFrame(rows, "h string")
    staged = [(r.lat, r.lon) for r in G.with_decoded_point(df, "h").collect()]
    expr = [(r.p.lat, r.p.lon) if r.p else (None, None) for r in df.select(G.decode_point("h").alias("p")).collect()]
    assert staged == expr == [(25.5, 55.25), (-1.0, 2.0), (None, None), (None, None)]
