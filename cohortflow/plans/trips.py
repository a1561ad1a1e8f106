"""Trip habit features (P9) in a single pass over the trips.

Upstream computes nine CTEs that each re-read the trip set. Here one ``groupBy(customer, product,
payment type, hour bucket)`` builds a cube of counts and sums with a map-side partial aggregate, so
a trip is one row in one wide shuffle. A second aggregate brings the cells of a customer together,
at most one for each product, payment type and bucket, and the margins are read from them:
preferences (W4), shares (W5), the dominant hour bucket (A16) and the child-product share (A11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.bands import band, compare_band, hour_bucket
from cohortflow.functions.keys import norm_key
from cohortflow.functions.measures import decay_weight, elapsed_days, override_when
from cohortflow.operators.aggregates import dominant_bucket
from cohortflow.operators.filters import credit_usage, valid_trips
from cohortflow.operators.joins import flag_exists, restrict_to
from cohortflow.operators.scans import scan_window
from cohortflow.params import ObservationWindow, TripThresholds


def prepared_trips(trips: DataFrame, base: DataFrame, credits: DataFrame, W: ObservationWindow,
                   th: TripThresholds = TripThresholds()) -> DataFrame:
    """F1 + J3 + F11/J4 + M8 + C7 + M5: one row per valid trip of a cohort customer."""
    t = valid_trips(scan_window(trips, "day", W.source_start, W.anchor)).withColumn("customer_id", norm_key("customer_id"))
    t = restrict_to(t, base, "customer_id")
    cred = credit_usage(scan_window(credits, "day", W.source_start, W.anchor))
    t = flag_exists(t, cred, "booking_id", "booking_id", "member_credit")
    return t.select(
        "customer_id", "booking_id",
        F.lower("cct").alias("cct"),
        F.trim(F.lower("customer_payment_selection")).alias("payment_type"),
        hour_bucket("booking_date", th.tz_offset_hours, R.TIME_OF_DAY_RULES, R.TIME_OF_DAY_ELSE).alias("time_of_day"),
        elapsed_days("booking_date", W.anchor).alias("days_from_anchor"),
        "distance_travelled", "duration_time", F.col("trip_price").alias("revenue"),
        override_when("member_credit", "", "booking_promo_code").alias("booking_promo_code"),
        F.when(F.col("member_credit"), F.lit(R.CREDIT_USAGE_LABELS[0]))
         .otherwise(F.lit(R.CREDIT_USAGE_LABELS[1])).alias("cplus_promo_usage"),
    )


def _rides(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0).cast("long"), lambda total, c: total + c["n"])


def _in_bucket(bucket: str):
    return lambda c: c["time_of_day"] == bucket


def _first(counts: Column) -> Column:
    """The value with the most rides (ties: the smallest) and their number."""
    return F.transform(F.slice(counts, 1, 1), lambda x: F.struct(x["v"].alias("v"), (-x["nn"]).alias("n")))[0]


def _decay(tau: float, legacy: bool) -> Column:
    if not legacy:
        return decay_weight("days_from_anchor", tau)
    return F.exp(F.round(-F.col("days_from_anchor").cast("double") / F.lit(float(tau)), 1))


def trip_features(trips: DataFrame, base: DataFrame, credits: DataFrame, W: ObservationWindow,
                  th: TripThresholds = TripThresholds(), decimals: int = 6,
                  legacy_decimal_scale: bool = False) -> DataFrame:
    """24 trip habit features, one row per cohort customer with a valid trip.

    Shares and decay exponents are exact doubles. ``legacy_decimal_scale=True`` reproduces the
    upstream dialect's decimal arithmetic instead (T3): ``count * 1.0 / total`` and
    ``-days / 90.0`` carry one decimal place (rounded half up), so shares move in 10 % steps."""
    t = prepared_trips(trips, base, credits, W, th)
    promo = (F.col("booking_promo_code").isNotNull() & (F.col("booking_promo_code") != "")).cast("long")
    measures = {"d": "distance_travelled", "t": "duration_time", "r": "revenue"}
    cube = t.groupBy("customer_id", "cct", "payment_type", "time_of_day").agg(
        F.count(F.lit(1)).alias("n"), F.sum(promo).alias("promo_n"),
        *(F.sum(c).alias(f"sum_{m}") for m, c in measures.items()), *(F.count(c).alias(f"n_{m}") for m, c in measures.items()),
        F.max("days_from_anchor").alias("age_max"), F.min("days_from_anchor").alias("age_min"),
        *(F.sum(_decay(tau, legacy_decimal_scale)).alias(f"w{tau}") for tau in R.DECAY_TAUS))
    mean = lambda m: F.sum(f"sum_{m}") / F.sum(f"n_{m}")
    cust = cube.groupBy("customer_id").agg(
        F.sum("n").alias("total_rides"), F.sum("promo_n").alias("promo_n"), mean("d").alias("avg_d"), mean("t").alias("avg_t"),
        mean("r").cast("decimal(38,6)").alias("avg_r"), F.sum("sum_r").alias("gmv"),
        F.max("age_max").alias("age_max"), F.min("age_min").alias("age_min"), *(F.sum(f"w{tau}").alias(f"w{tau}") for tau in R.DECAY_TAUS),
        F.collect_list(F.struct("cct", "payment_type", "time_of_day", "n")).alias("cells"))
    counts = lambda field: F.sort_array(F.transform(
        F.array_distinct(F.transform("cells", lambda c: c[field])),
        lambda v: F.struct((-_rides(F.filter("cells", lambda c: c[field].eqNullSafe(v)))).alias("nn"), v.alias("v"))))
    cust = cust.withColumns({"top_cct": _first(counts("cct")), "top_pay": _first(counts("payment_type"))})
    of = lambda cond: F.when(F.exists("cells", cond), _rides(F.filter("cells", cond)))
    best_child = F.array_max(F.transform(F.array(*(F.lit(p) for p in R.CHILD_PRODUCTS)), lambda p: of(lambda c: c["cct"] == p)))
    cust = cust.withColumns({**{f"tod_{b}": of(_in_bucket(b)) for b in R.TIME_OF_DAY_ORDER}, "child_n": best_child})

    def pct(n: Column) -> Column:
        share = n.cast("double") * F.lit(1.0) / F.col("total_rides").cast("double")
        return (F.round(share, 1) if legacy_decimal_scale else share) * F.lit(100.0)

    tod_pct = {b: F.coalesce(F.when(F.col(f"tod_{b}") >= th.fav_commute_time_min_trip_cnt, pct(F.col(f"tod_{b}"))),
                             F.lit(0.0))
               for b in R.TIME_OF_DAY_ORDER}
    any_tod = None
    for b in R.TIME_OF_DAY_ORDER:
        c = F.col(f"tod_{b}") >= th.fav_commute_time_min_trip_cnt
        any_tod = c if any_tod is None else any_tod | c
    avg_d = F.round(F.col("avg_d"), 2)
    avg_t = F.round(F.col("avg_t"), 2)
    avg_r = F.round(F.col("avg_r"), 2)
    promo_perc = pct(F.col("promo_n"))
    return cust.select(
        "customer_id",
        F.when(F.col("top_cct.n") >= th.fav_cct_min_trip_cnt, F.col("top_cct.v")).alias("preferred_cct"),
        "total_rides",
        band("total_rides", R.USAGE_BANDS, R.USAGE_ELSE).alias("ride_usage_behaviour"),
        F.when(F.coalesce(any_tod, F.lit(False)),
               dominant_bucket(tod_pct, R.COMMUTER_LABELS, R.COMMUTER_LABELS["Night"])).alias("time_of_day_commuter"),
        F.when(F.col("top_pay.n") >= th.fav_payment_min_trip_cnt, F.col("top_pay.v")).alias("preferred_payment_method"),
        F.when(F.coalesce(pct(F.col("child_n")), F.lit(0.0)) >= th.min_share_pct, F.lit(R.PARENT_LABELS[0]))
         .otherwise(F.lit(R.PARENT_LABELS[1])).alias("parent_status"),
        promo_perc.alias("promo_perc"),
        F.when(promo_perc > th.promo_percent_threshold, F.lit(R.PROMO_LABELS[0]))
         .otherwise(F.lit(R.PROMO_LABELS[1])).alias("promo_behaviour"),
        compare_band(avg_r, R.SPEND_RULES, R.SPEND_ELSE).alias("spend_bucket"),
        compare_band(avg_d, R.DISTANCE_RULES).alias("distance_bucket"),
        compare_band(avg_t, R.DURATION_RULES).alias("duration_bucket"),
        compare_band("total_rides", R.TRIP_COUNT_RULES).alias("trip_bucket"),
        avg_d.alias("avg_distance"), avg_t.alias("avg_duration"), avg_r.cast("double").alias("avg_revenue"),
        F.col("gmv").cast("double").alias("trips_total_gmv"),
        F.col("total_rides").alias("trip_count"),
        F.col("age_max").alias("days_since_least_recent_trip"),
        F.col("age_min").alias("days_since_most_recent_trip"),
        *[F.round(F.col(f"w{tau}"), decimals).alias(f"exp_weight_{tau}") for tau in R.DECAY_TAUS],
    )
