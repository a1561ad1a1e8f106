"""Operator-level registered queries, each over whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions import bands as B
from cohortflow.functions import geo as G
from cohortflow.functions import measures as M
from cohortflow.functions.keys import norm_key
from cohortflow.operators import aggregates as A
from cohortflow.operators import daybits as D
from cohortflow.operators import filters as FL
from cohortflow.operators import joins as J
from cohortflow.operators import scans as S
from cohortflow.operators import versions as V
from cohortflow.operators import windows as WN
from cohortflow.plans import crosssell as X
from cohortflow.plans import locations as L
from cohortflow.plans import places as PL
from cohortflow.plans import postcross as PC
from cohortflow.plans import reactivation as P
from cohortflow.plans import status as ST
from cohortflow.registry import register
from cohortflow.registry.jobs import TRIP_THRESHOLDS, cohort
from cohortflow.session import cut_lineage, ensure_checkpoint_dir
from cohortflow.sources import testbed as T
from cohortflow.sources.rejects import rejected_ids
from cohortflow.sources.sinks import write_days
from cohortflow.sources.testbed import Sources

CW, RW, AW, EW = T.CROSS_SELL_W, T.REACTIVATION_W, T.ANCHOR_DAY_W, T.EVENTS_W
RIDES_SINCE = "1995-01-01"


def _money(df, cols):
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- 2.2 scans -------------------------------------------------------------------------------

@register("scan_window_half_open")
def scan_window_half_open(spark, d):
    t = S.scan_window(Sources(spark, d).trips, "day", CW.source_start, CW.anchor)
    return t.select("trip_id", "customer_id", "day")


@register("scan_window_variants")
def scan_window_variants(spark, d):
    o = Sources(spark, d).orders.select("customer_id", "order_id", "day")
    W = AW
    parts = {
        "anchor_day": S.scan_window(o, "day", W.anchor, W.anchor, hi_inclusive=True),
        "after_to_end": S.scan_window(o, "day", W.anchor, W.outcome_end_inclusive, lo_inclusive=False, hi_inclusive=True),
        "before_anchor": S.scan_window(o, "day", None, W.anchor),
        "anchor_to_target": S.scan_window(o, "day", W.anchor, W.target_end),
    }
    out = None
    for name, p in parts.items():
        a = p.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_orders")).select(
            F.lit(name).alias("variant"), "n_rows", "n_orders")
        out = a if out is None else out.unionByName(a)
    return out


def _value_trips(spark, d):
    t = FL.valid_trips(Sources(spark, d).trips, FL.VALUE_TRIP_RULES)
    return t.select("day", norm_key("customer_id").alias("customer_id"), "trip_id",
                    F.col("revenue").cast("double").alias("revenue"), F.col("cogs").cast("double").alias("cogs"))


@register("scan_history_distinct")
def scan_history_distinct(spark, d):
    return S.scan_window(_value_trips(spark, d), "day", RIDES_SINCE, RW.anchor).distinct()


@register("union_disjoint_ranges")
def union_disjoint_ranges(spark, d):
    ranges = [("1995-01-01", "1995-12-31", True), ("1996-01-01", "1997-12-31", True),
              ("1998-01-01", "1998-12-31", True), ("1999-01-01", RW.anchor, False)]
    return S.union_ranges(_value_trips(spark, d), "day", ranges).distinct()


@register("latest_snapshot")
def latest_snapshot(spark, d):
    s = S.latest_snapshot(Sources(spark, d).platform_status, "day", EW.anchor, 3)
    return s.select("customer_id", "monthly_status", "all_time_tx", "last_tx_date", "day")


@register("exact_snapshot")
def exact_snapshot(spark, d):
    s = S.exact_snapshot(Sources(spark, d).platform_status, "day", EW.anchor)
    return s.select("customer_id", "monthly_status", "all_time_tx", "last_tx_date", "day")


def by_day(spark, d, name):
    """A binding laid out by day in the shared folder, as the upstream tables are."""
    path = f"{ensure_checkpoint_dir(spark)}/by-day-{name}-{uuid.uuid4().hex}"
    df = getattr(Sources(spark, d), name)
    write_days(df, path)
    return spark.read.schema(df.schema).parquet(path)


@register("latest_snapshot_by_day")
def latest_snapshot_by_day(spark, d):
    """S3 over a table laid out by day: one folder is read."""
    s = S.latest_snapshot(by_day(spark, d, "platform_status"), "day", EW.anchor, 3)
    return s.select("customer_id", "monthly_status", "all_time_tx", "last_tx_date", "day")


@register("scan_window_by_day")
def scan_window_by_day(spark, d):
    """S1 over a table laid out by day."""
    return S.scan_window(by_day(spark, d, "bookings"), "day", EW.source_start, EW.anchor).select("booking_id", "customer_id", "day")


# ---- 2.3 filters -----------------------------------------------------------------------------

@register("filter_valid_trips")
def filter_valid_trips(spark, d):
    return FL.valid_trips(Sources(spark, d).trips).select("trip_id", "customer_id", "day")


@register("filter_completed")
def filter_completed(spark, d):
    return FL.completed_bookings(Sources(spark, d).bookings).select("booking_id", "customer_id", "day")


@register("filter_delivered")
def filter_delivered(spark, d):
    return FL.delivered(Sources(spark, d).orders).select("order_id", "line_no", "customer_id", "order_status")


@register("filter_name_contains")
def filter_name_contains(spark, d):
    return FL.name_contains(Sources(spark, d).orders, "merchant_name", R.B_BRAND_WORD).select("order_id", "line_no",
                                                                                     "merchant_name")


@register("filter_exclude_text")
def filter_exclude_text(spark, d):
    det = Sources(spark, d).place_details.select(
        "location_bookmark_id", "last_updated", F.lower("saved_name").alias("sl_name"),
        F.lower("address_type").alias("sl_address_type"), F.lower("building_type").alias("sl_building_type"),
        F.lower("place_name").alias("sl_place_name"))
    return FL.exclude_like(det, R.RESIDENTIAL_EXCLUSIONS, require_not_null=["sl_name"]).select(
        "location_bookmark_id", "last_updated", "sl_name")


@register("norm_key")
def norm_key_q(spark, d):
    s = Sources(spark, d)
    a = s.subscription_events.select(F.col("userid").alias("raw_id"), norm_key("userid", 5).alias("customer_id"))
    b = s.profile.select(F.col("customer_id").alias("raw_id"), norm_key("customer_id").alias("customer_id"))
    return a.unionByName(b).distinct()


@register("norm_key_rejects")
def norm_key_rejects(spark, d):
    """F6 with its rejects counted: ids as text, some with a prefix that is not taken off."""
    s = Sources(spark, d)
    return rejected_ids({"subscription_events": (s.subscription_events, "userid", 5), "profile": (s.profile, "customer_id", 0),
                         "subscription_events, prefix left on": (s.subscription_events, "userid", 0), "trips": (s.trips, "captain_id", 0)})


@register("filter_active_at")
def filter_active_at(spark, d):
    s = FL.active_at(Sources(spark, d).subscription_events, "startedat", "expiresat", AW.anchor)
    return s.select("userid", "event_seq", "startedat", "expiresat")


@register("filter_lapsed_graduated")
def filter_lapsed_graduated(spark, d):
    s = Sources(spark, d)
    life = P.lifetime_features(P.lapsed_service_history(s.orders, s.merchants, RW), RW)
    return FL.at_least(FL.lapsed(life, "recency_days", 30), "lifetime_orders", 5).select(
        "customer_id", "recency_days", "lifetime_orders")


@register("filter_first_on_anchor")
def filter_first_on_anchor(spark, d):
    s = Sources(spark, d)
    firsts = X.service_first_dates(s.first_orders, X.valid_users(s.trips, CW))
    return FL.first_on(firsts, "food_first_order_date", CW.anchor).select("customer_id", "food_first_order_date")


@register("filter_credit_usage")
def filter_credit_usage(spark, d):
    c = FL.credit_usage(S.scan_window(Sources(spark, d).credits, "day", CW.source_start, CW.anchor))
    return c.select("booking_id", "day", "credit_type")


# ---- 2.4 joins -------------------------------------------------------------------------------

@register("join_inner_dim")
def join_inner_dim(spark, d):
    s = Sources(spark, d)
    o = FL.delivered(s.orders).select("order_id", "line_no", "merchant_id", "customer_id")
    return J.join_dim(o, s.merchants, "merchant_id").select("order_id", "line_no", "customer_id", "merchant_name")


@register("join_left_assemble")
def join_left_assemble(spark, d):
    s = Sources(spark, d)
    a = s.order_level.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))
    b = s.value_lines.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_lines"))
    c = s.profile.select(norm_key("customer_id").alias("customer_id"), "nationality")
    return J.assemble(s.customers, [a, b, c], "customer_id")


@register("join_semi")
def join_semi(spark, d):
    t = S.scan_window(Sources(spark, d).trips, "day", CW.source_start, CW.anchor)
    t = t.select("trip_id", norm_key("customer_id").alias("customer_id"))
    return J.restrict_to(t, X.crossed_on(Sources(spark, d).trips, Sources(spark, d).first_orders, CW, "a"),
                         "customer_id")


@register("join_exists_flag")
def join_exists_flag(spark, d):
    s = Sources(spark, d)
    t = S.scan_window(s.trips, "day", CW.source_start, CW.anchor).select("trip_id", "booking_id")
    cred = FL.credit_usage(S.scan_window(s.credits, "day", CW.source_start, CW.anchor))
    return J.flag_exists(t, cred, "booking_id", "booking_id", "member_credit")


def _places(spark, d):
    s = Sources(spark, d)
    return PL.saved_places(s.place_locations, s.place_coordinates, s.place_details, cohort(spark, d))


@register("join_latest_versions")
def join_latest_versions(spark, d):
    return _places(spark, d)


@register("join_proximity_time")
def join_proximity_time(spark, d):
    s = Sources(spark, d)
    b = PL.completed_dropoffs(s.bookings, cohort(spark, d), EW)
    p = _places(spark, d)
    j = J.near_join(b, p, key="customer_id", place_key="sl_customer_id", ev_lat="drop_off_latitude",
                    ev_lon="drop_off_longitude", pl_lat="sl_lat", pl_lon="sl_lon", metres=R.PLACE_RADIUS_M,
                    extra=F.col("pick_up_time") > F.col("created_at"), how="left")
    return j.select("customer_id", "booking_id", "location_id",
                    F.round(G.haversine_m("drop_off_latitude", "drop_off_longitude", "sl_lat", "sl_lon"), 3).alias("metres"))


@register("join_proximity_salted")
def join_proximity_salted(spark, d):
    """J6 with the events of cells of more than ten spread over eight tasks."""
    b = cut_lineage(PL.completed_dropoffs(Sources(spark, d).bookings, cohort(spark, d), EW))
    j = J.near_join(b, _places(spark, d), key="customer_id", place_key="sl_customer_id", ev_lat="drop_off_latitude",
                    ev_lon="drop_off_longitude", pl_lat="sl_lat", pl_lon="sl_lon", metres=R.PLACE_RADIUS_M,
                    extra=F.col("pick_up_time") > F.col("created_at"), how="left", heavy_rows=10, salts=8)
    return j.select("customer_id", "booking_id", "location_id",
                    F.round(G.haversine_m("drop_off_latitude", "drop_off_longitude", "sl_lat", "sl_lon"), 3).alias("metres"))


@register("join_bridge_tags")
def join_bridge_tags(spark, d):
    s = Sources(spark, d)
    o = FL.delivered(s.orders, statuses=(R.DELIVERED_STATUS,), case_insensitive=False, city_col=None,
                     order_type=R.A_ORDER_TYPE)
    j = J.join_bridge(o.select("order_id", "line_no", "merchant_id"), s.merchant_tags, s.tags, fact_key="merchant_id",
                      bridge_fact_key="merchant_id", bridge_dim_key="tag_id", dim_key="id",
                      bridge_filter=F.lower("status") == R.TAG_STATUS_ACTIVE,
                      dim_filter=F.col("type") == R.TAG_TYPE_CUISINE)
    return j.select("order_id", "line_no", F.col("name").alias("cuisine"))


# ---- 2.5 aggregates --------------------------------------------------------------------------

@register("agg_lifetime")
def agg_lifetime(spark, d):
    s = Sources(spark, d)
    h = P.lapsed_service_history(s.orders, s.merchants, RW)
    return A.lifetime(h, key="customer_id", day="day", order_id="order_id", anchor=RW.anchor)


@register("agg_value_lineitems")
def agg_value_lineitems(spark, d):
    v = P.second_service_value(Sources(spark, d).value_lines, RW)
    return _money(v, {"food_gmv", "food_gp"})


@register("agg_value_orders")
def agg_value_orders(spark, d):
    v = P.lapsed_service_value(Sources(spark, d).order_level, RW)
    return _money(v, {"shop_gmv", "shop_gp"})


@register("agg_value_trips")
def agg_value_trips(spark, d):
    v = P.ride_value(Sources(spark, d).trips, RW, RIDES_SINCE)
    return _money(v, {"ride_gmv", "ride_gp"})


@register("agg_recent_distinct")
def agg_recent_distinct(spark, d):
    t = S.scan_window(_value_trips(spark, d), "day", RIDES_SINCE, RW.anchor)
    return A.recent_distinct(t, key="customer_id", order_id="trip_id", recent=M.calendar_days("day", RW.anchor) <= 30,
                             names={"n": "n_trips", "n_recent": "n_trips_30"})


@register("agg_outcome_after")
def agg_outcome_after(spark, d):
    o = P.outcome_after(P.ReactivationSources.from_testbed(Sources(spark, d)), AW, R.OUTCOME_CITIES_ALL)
    return _money(o, {"basket_after", "promo_after", "spend_after"})


@register("agg_first_date")
def agg_first_date(spark, d):
    s = Sources(spark, d)
    return X.service_first_dates(s.first_orders, X.valid_users(s.trips, CW))


@register("agg_active_days")
def agg_active_days(spark, d):
    a = S.scan_window(Sources(spark, d).active_subs, "day", EW.source_start, EW.anchor)
    return A.active_days(a.select(norm_key("customer_id").alias("customer_id"), "day"), key="customer_id", day="day")


@register("agg_active_days_merged")
def agg_active_days_merged(spark, d):
    """A6 as bitmaps: the words of two overlapping periods, merged, count each day once."""
    a = Sources(spark, d).active_subs.select(norm_key("customer_id").alias("customer_id"), "day")
    mid = EW.source_start + (EW.anchor - EW.source_start) // 2
    early = D.day_words(S.scan_window(a, "day", EW.source_start, mid + dt.timedelta(days=2)), ["customer_id"], "day")
    late = D.within(D.day_words(a, ["customer_id"], "day"), mid, EW.anchor)
    return D.count_days(D.merged(early.unionByName(late), ["customer_id"]), ["customer_id"])


@register("agg_active_days_anchors")
def agg_active_days_anchors(spark, d):
    """A3 / A6 for many anchors: the active days in the ten days before each anchor."""
    words = D.day_words(Sources(spark, d).active_subs.select(norm_key("customer_id").alias("customer_id"), "day"), ["customer_id"], "day")
    anchors = words.select("customer_id").distinct().select(
        "customer_id", F.explode(F.array(*(F.lit(EW.source_start + dt.timedelta(days=k)) for k in (5, 12, 20)))).alias("anchor"))
    return D.active_at_anchors(words, "customer_id", anchors, 10)


def _window_trips(spark, d):
    t = FL.valid_trips(S.scan_window(Sources(spark, d).trips, "day", CW.source_start, CW.anchor))
    return t.select(norm_key("customer_id").alias("customer_id"), "booking_id", F.lower("cct").alias("cct"),
                    "distance_travelled", "duration_time", F.col("trip_price").alias("revenue"),
                    M.elapsed_days("booking_date", CW.anchor).alias("age"), "booking_promo_code")


@register("agg_usage_summary")
def agg_usage_summary(spark, d):
    u = A.usage_summary(_window_trips(spark, d), key="customer_id",
                        averages={"avg_distance": "distance_travelled", "avg_duration": "duration_time",
                                  "avg_revenue": "revenue"},
                        total=("total_gmv", "revenue"), count="trip_count", age="age")
    return _money(u, {"avg_revenue", "total_gmv"})


def _events(spark, d):
    return T.read_table(spark, d, "events")


@register("agg_decay_weights")
def agg_decay_weights(spark, d):
    e = S.scan_window(_events(spark, d), "ts", None, F.lit(EW.anchor).cast("timestamp_ntz"))
    e = e.withColumn("age", M.elapsed_days("ts", EW.anchor))
    return A.decayed_count(e, key="user_id", age="age", taus=R.DECAY_TAUS, decimals=6)


@register("agg_promo_share")
def agg_promo_share(spark, d):
    promo = F.col("booking_promo_code").isNotNull() & (F.col("booking_promo_code") != "")
    a = A.share_pct(_window_trips(spark, d), key="customer_id", cond=promo, out="promo_perc")
    return a.select("customer_id", "promo_perc",
                    F.when(F.col("promo_perc") > TRIP_THRESHOLDS.promo_percent_threshold, F.lit(R.PROMO_LABELS[0]))
                     .otherwise(F.lit(R.PROMO_LABELS[1])).alias("promo_behaviour"))


@register("agg_ride_count")
def agg_ride_count(spark, d):
    return A.point_counts(_window_trips(spark, d), ["customer_id"], out="total_rides")


@register("agg_category_share_flag")
def agg_category_share_flag(spark, d):
    return A.category_share_flag(_window_trips(spark, d), key="customer_id", cat="cct", values=R.CHILD_PRODUCTS,
                                 threshold=TRIP_THRESHOLDS.min_share_pct, labels=R.PARENT_LABELS, out="parent_status")


@register("agg_distinct_rows")
def agg_distinct_rows(spark, d):
    t = FL.valid_trips(S.scan_window(Sources(spark, d).trips, "day", CW.source_start, CW.anchor))
    rlat, rlon = G.round_point("drop_off_latitude", "drop_off_longitude", 3)
    return t.select(norm_key("customer_id").alias("customer_id"), "booking_id", rlat.alias("latitude"),
                    rlon.alias("longitude")).distinct()


def _event_points(spark, d):
    e = _events(spark, d)
    return e.select("event_id", F.col("user_id").alias("customer_id"),
                    (F.lit(25.0) + (F.col("event_id") % 97) * F.lit(0.002)).alias("latitude"),
                    (F.lit(55.0) + (F.col("event_id") % 89) * F.lit(0.002)).alias("longitude"))


@register("agg_point_counts")
def agg_point_counts(spark, d):
    p = _event_points(spark, d)
    rlat, rlon = G.round_point("latitude", "longitude", 2)
    return A.point_counts(p.select("customer_id", rlat.alias("latitude"), rlon.alias("longitude")),
                          ["customer_id", "latitude", "longitude"], out="trip_cnts")


def _areas(spark, d):
    c = T.read_table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("string").alias("area"),
                    (F.col("c_acctbal") > 5000).alias("flag"))


@register("agg_area_stats")
def agg_area_stats(spark, d):
    s = A.area_stats(_areas(spark, d), area="area", flag="flag", n_name="n_customers", k_name="n_adopters")
    return s.where(F.col("n_customers") > R.MIN_AREA_CUSTOMERS)


@register("agg_argmax_cell")
def agg_argmax_cell(spark, d):
    p = _event_points(spark, d).withColumn("trip_cnts", F.lit(1))
    return L.dominant_cell(p)


@register("agg_dominant_bucket")
def agg_dominant_bucket(spark, d):
    e = S.scan_window(_events(spark, d), "ts", None, F.lit(EW.anchor).cast("timestamp_ntz"))
    e = e.select("user_id", B.hour_bucket("ts", 4, R.TIME_OF_DAY_RULES, R.TIME_OF_DAY_ELSE).alias("tod"))
    return A.dominant_bucket_of(e, key="user_id", bucket="tod", order=R.TIME_OF_DAY_ORDER, min_count=10,
                                labels=R.COMMUTER_LABELS, else_label=R.COMMUTER_LABELS["Night"],
                                out="time_of_day_commuter")


# ---- 2.6 windows / 2.7 top-k, set ops --------------------------------------------------------

@register("win_latest_row")
def win_latest_row(spark, d):
    demo = Sources(spark, d).demographics
    return WN.latest_by(demo, ["customer_id"], ["day", "updated_at", "event_id"],
                        ["day", "sex_prediction", "tourist_flag", "tourist_country_simcard"])


@register("win_latest_merged")
def win_latest_merged(spark, d):
    """W1 kept up by merging: the log arrives in three pieces, the middle one last."""
    demo = Sources(spark, d).demographics
    path = f"{ensure_checkpoint_dir(spark)}/latest-{uuid.uuid4().hex}"
    a, b = EW.source_start + dt.timedelta(days=7), EW.source_start + dt.timedelta(days=15)
    for piece in (F.col("day") < a, F.col("day") >= b, (F.col("day") >= a) & (F.col("day") < b)):
        table = V.merge_latest(path, demo.where(piece), ["customer_id"], ["day", "updated_at", "event_id"], V.key_hash(["customer_id"], 4))
    return table.select("customer_id", "day", "sex_prediction", "tourist_flag", "tourist_country_simcard")


@register("win_latest_membership")
def win_latest_membership(spark, d):
    return P.latest_membership(Sources(spark, d).subscription_events, RW)


def _multi_day_orders(spark, d):
    o = FL.delivered(Sources(spark, d).orders)
    return o.select("customer_id", "order_id", "line_no", "order_received_timestamp")


@register("win_order_sequence")
def win_order_sequence(spark, d):
    o = _multi_day_orders(spark, d)
    return WN.rank_within(o, "customer_id", [F.col("order_received_timestamp").asc_nulls_last(),
                                             F.col("order_id").asc_nulls_last(), F.col("line_no").asc_nulls_last()],
                          out="seq")


@register("win_dense_rank")
def win_dense_rank(spark, d):
    return WN.rank_within(_multi_day_orders(spark, d), "customer_id", ["order_received_timestamp"], out="order_rank",
                          dense=True)


@register("win_preferred_category")
def win_preferred_category(spark, d):
    return WN.preferred(_window_trips(spark, d), "customer_id", "cct", 3, out="preferred_cct")


def _event_type_counts(spark, d):
    return A.point_counts(_events(spark, d), ["user_id", "event_type"], "cnt")


@register("win_share_of_total")
def win_share_of_total(spark, d):
    s = WN.share_of_total(_event_type_counts(spark, d), "user_id", "cnt", "percentage")
    return s.withColumn("percentage", F.round("percentage", 6))


@register("win_best_match")
def win_best_match(spark, d):
    s = Sources(spark, d)
    m = PL.matched_places(PL.completed_dropoffs(s.bookings, cohort(spark, d), EW), _places(spark, d))
    return m.select("customer_id", "booking_id", "location_id")


@register("win_top_by_share")
def win_top_by_share(spark, d):
    return WN.top1_by_count(_event_type_counts(spark, d), "user_id", "event_type", "cnt", 15, out="top_type")


@register("topk_per_key")
def topk_per_key(spark, d):
    return WN.top_k(_event_type_counts(spark, d), "user_id",
                    [F.col("cnt").desc(), F.col("event_type").asc()], 3, out="rank")


# ---- 2.8 classification ----------------------------------------------------------------------

@register("band_order_count")
def band_order_count(spark, d):
    life = agg_lifetime(spark, d)
    return life.select("customer_id", "delivered_orders",
                       B.band("delivered_orders", R.ORDER_COUNT_BANDS).alias("order_cohort"))


@register("band_recency")
def band_recency(spark, d):
    life = agg_lifetime(spark, d)
    return life.select("customer_id", "recency", B.band("recency", R.RECENCY_BANDS, R.RECENCY_ELSE).alias("recency_band"))


@register("band_status_snapshot")
def band_status_snapshot(spark, d):
    return ST.platform_status_bands(Sources(spark, d).platform_status, EW.anchor, lookback_days=3)


@register("status_snapshot_distinct")
def status_snapshot_distinct(spark, d):
    return ST.service_status_snapshot(Sources(spark, d).service_status, EW.anchor)


@register("band_usage")
def band_usage(spark, d):
    c = agg_ride_count(spark, d)
    return c.select("customer_id", "total_rides", B.band("total_rides", R.USAGE_BANDS, R.USAGE_ELSE).alias("usage"))


@register("band_spend")
def band_spend(spark, d):
    u = agg_usage_summary(spark, d)
    return u.select("customer_id",
                    B.compare_band("avg_revenue", R.SPEND_RULES, R.SPEND_ELSE).alias("spend_bucket"),
                    B.compare_band("avg_distance", R.DISTANCE_RULES).alias("distance_bucket"),
                    B.compare_band("avg_duration", R.DURATION_RULES).alias("duration_bucket"),
                    B.compare_band("trip_count", R.TRIP_COUNT_RULES).alias("trip_bucket"))


@register("band_time_of_day")
def band_time_of_day(spark, d):
    return _events(spark, d).select("event_id", B.hour_bucket("ts", 4, R.TIME_OF_DAY_RULES, R.TIME_OF_DAY_ELSE).alias("tod"))


@register("label_adoption")
def label_adoption(spark, d):
    return cohort(spark, d).select("customer_id", "service")


@register("map_taxonomy")
def map_taxonomy(spark, d):
    s = Sources(spark, d)
    names = (s.merchant_tags.join(s.tags, F.col("tag_id") == F.col("id"))
             .select("merchant_id", F.col("name").alias("cuisine")))
    return PC.map_taxonomy(names, "cuisine", PC.taxonomy_frame(spark))


@register("classify_place")
def classify_place(spark, d):
    det = WN.latest_by(Sources(spark, d).place_details, ["location_bookmark_id"],
                       ["last_updated", "saved_name", "address_type", "building_type", "place_name"])
    return det.select("location_bookmark_id",
                      B.place_class(F.lower("saved_name"), F.lower("building_type"), R.PLACE_CLASSES).alias("place_class"))


@register("clean_categorical")
def clean_categorical(spark, d):
    return Sources(spark, d).demographics.select(
        "event_id", B.clean_category("sex_prediction", R.GENDER_VALUES).alias("gender"),
        B.clean_category("tourist_flag", R.TOURIST_VALUES).alias("tourist"))


@register("flag_between")
def flag_between(spark, d):
    return cohort(spark, d).select("customer_id", B.between_flag("food_first_order_date", CW.source_start, CW.anchor)
                                   .alias("flag"))


# ---- 2.9 measures ----------------------------------------------------------------------------

@register("measure_safe_ratio")
def measure_safe_ratio(spark, d):
    o = Sources(spark, d).orders
    a = o.groupBy("customer_id").agg(
        F.sum("delivery_fee").alias("fees"),
        F.count(F.when(F.col("promo_code").isNotNull(), F.lit(1))).alias("n_promo"))
    return a.select("customer_id", M.safe_ratio("fees", "n_promo").alias("fee_per_promo"))


def _react_value(spark, d):
    s = Sources(spark, d)
    src = P.ReactivationSources.from_testbed(s)
    spine = s.customers.select("customer_id")
    return P.value_features(spine, src, RW, RIDES_SINCE)


@register("measure_defaults")
def measure_defaults(spark, d):
    return _react_value(spark, d).select("customer_id", "food_recency", "ride_recency", "n_rides", "n_food_orders",
                                         "n_shop_orders", "food_gmv")


@register("measure_total_value")
def measure_total_value(spark, d):
    return _react_value(spark, d).select("customer_id", "total_gmv")


@register("measure_blended_margin")
def measure_blended_margin(spark, d):
    return _react_value(spark, d).select("customer_id", "blended_gppo")


@register("measure_age_elapsed")
def measure_age_elapsed(spark, d):
    return _events(spark, d).select("event_id", M.elapsed_days("ts", EW.anchor).alias("elapsed_days"))


@register("measure_age_calendar")
def measure_age_calendar(spark, d):
    return _events(spark, d).select("event_id", M.calendar_days("ts", EW.anchor).alias("calendar_days"),
                                    M.days_since(EW.anchor, "ts").alias("days_since_anchor"))


@register("measure_wilson_lower")
def measure_wilson_lower(spark, d):
    s = A.area_stats(_areas(spark, d), area="area", flag="flag", n_name="n", k_name="k")
    return s.select("area", F.round(M.wilson_lower("k", "n", R.WILSON_CONFIDENCE), 6).alias("wilson_lower"))


@register("measure_promo_override")
def measure_promo_override(spark, d):
    s = Sources(spark, d)
    t = S.scan_window(s.trips, "day", CW.source_start, CW.anchor).select("booking_id", "booking_promo_code")
    cred = FL.credit_usage(S.scan_window(s.credits, "day", CW.source_start, CW.anchor))
    t = J.flag_exists(t, cred, "booking_id", "booking_id", "member_credit")
    return t.select("booking_id", M.override_when("member_credit", "", "booking_promo_code").alias("promo_code"))


# ---- 2.10 geo --------------------------------------------------------------------------------

@register("geo_decode_point")
def geo_decode_point(spark, d):
    c = Sources(spark, d).place_coordinates
    return G.with_decoded_point(c, "lng_lat").select("location_bookmark_id", "last_updated", "lat", "lon")


@register("geo_haversine")
def geo_haversine(spark, d):
    t = FL.valid_trips(Sources(spark, d).trips)
    return t.select("trip_id", F.round(G.haversine_m("pick_up_latitude", "pick_up_longitude", "drop_off_latitude",
                                                     "drop_off_longitude"), 3).alias("metres"))


@register("geo_round_point")
def geo_round_point(spark, d):
    t = Sources(spark, d).trips
    rlat, rlon = G.round_point("pick_up_latitude", "pick_up_longitude", 3)
    return t.select("trip_id", rlat.alias("latitude"), rlon.alias("longitude"))


@register("geo_hex_cell")
def geo_hex_cell(spark, d):
    p = _event_points(spark, d)
    return p.select("event_id", G.hex_cell("latitude", "longitude", R.HEX_EDGE_KM).alias("cell"))

