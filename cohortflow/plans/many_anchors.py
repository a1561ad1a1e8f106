"""Reactivation features (P1 / P2) for a list of anchors in one plan.

The single-anchor job reads the whole history for each anchor. Here each history is read once and becomes daily states
(``operators.states``): an order, ride or amount is an event on the first anchor that sees it, and what an anchor sees is
the running sum of the states up to it. The outcome after an anchor is the same thing backwards: an order of day d
belongs to the anchors from d minus the outcome days to the day before d.

The histories, cut to the anchors' customers, are stored once: the daily sums, the order events and, of the order lines,
both lifetime and outcome read the stored rows, so a fact table is joined and shuffled once and not for each of them.

The result equals the single-anchor job for each anchor, with the anchor as a column, so one write replaces the
partitions of all of them. All anchors have the same start of history and the same number of outcome days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.measures import safe_ratio
from cohortflow.operators.filters import VALUE_TRIP_RULES, delivered, valid_trips
from cohortflow.operators.joins import assemble
from cohortflow.operators.keysets import KeySet
from cohortflow.operators.scans import scan_window, window_predicate
from cohortflow.operators.states import GREATEST, LEAST, SUM, cumulated, order_events
from cohortflow.operators.windows import latest_by, rank_within
from cohortflow.plans import reactivation as P
from cohortflow.session import cut_lineage

#: Sums of the outcome and the columns that they are of.
OUTCOME = {"basket_after": "basket_amount", "promo_after": "promo_amount", "spend_after": "net_basket_amount_with_tax"}


def anchor_orders(src: P.ReactivationSources, anchors: Sequence[dt.date], cities=R.LAPSED_SERVICE_CITIES) -> DataFrame:
    """The order lines of all anchor days with their sequence within the customer's day (W2); ``anchor`` is the day."""
    o = src.orders.where(F.col("day").isin(list(anchors))).select(
        "customer_id", "order_id", "line_no", "merchant_id", "order_status", "city_id", "order_type", "order_received_timestamp", "day",
        "promo_code", "basket_amount", "promo_amount", "net_basket_amount_with_tax")
    o = delivered(o, cities=cities).join(src.merchants.select("merchant_id"), "merchant_id", "inner")
    o = o.withColumn("__of", F.struct("day", "customer_id"))
    ranked = rank_within(o, "__of", [F.col("order_received_timestamp").asc_nulls_last(), F.col("order_id").asc_nulls_last(),
                                     F.col("line_no").asc_nulls_last()], out="day_order_rn")
    return ranked.drop("__of").withColumnRenamed("day", "anchor")


def _after(day: str):
    return F.date_add(F.col(day), 1)


def lifetime_events(src: P.ReactivationSources, keys: KeySet, lo, hi, cities=R.LAPSED_SERVICE_CITIES, order_type: str = R.B_ORDER_TYPE) -> list[DataFrame]:
    """A1: first and last day, last merchant and distinct orders of the lapsed service."""
    o = keys.likely(scan_window(src.orders, "day", lo, hi).select(
        "customer_id", "order_id", "merchant_id", "order_status", "city_id", "order_type", "order_received_timestamp", "day"))
    h = delivered(o, cities=cities, order_type=order_type).join(src.merchants, "merchant_id", "inner").withColumn("at", _after("day"))
    newest = F.struct(F.col("order_received_timestamp").alias("ts"), F.col("order_id").alias("order_id"), F.col("merchant_name").alias("merchant_name"))
    days = h.groupBy("customer_id", "at").agg(F.min("day").alias("first_order_date"), F.max("day").alias("last_order_date"), F.max(newest).alias("newest"))
    return [days, order_events(h, "customer_id", "order_id", "at", n="lifetime_orders")]


def ride_events(src: P.ReactivationSources, keys: KeySet, since, hi, recent_days: int = R.RECENT_DAYS) -> list[DataFrame]:
    """S2 + A2c + A3: value of the de-duplicated rides, rides and recent rides."""
    t = keys.likely(P.with_key(valid_trips(scan_window(src.trips, "day", since, hi), VALUE_TRIP_RULES)), "__key")
    t = cut_lineage(t.select("day", F.col("__key").alias("customer_id"), "trip_id", "revenue", "cogs").distinct())
    t = t.withColumns({"at": _after("day"), "until": F.date_add("day", recent_days)})
    days = t.groupBy("customer_id", "at").agg(F.sum("revenue").alias("ride_gmv"), F.sum(F.col("revenue") - F.col("cogs")).alias("ride_gp"),
                                              F.max("day").alias("last_ride_date"))
    return [days, order_events(t, "customer_id", "trip_id", "at", "until", "n_rides", "n_rides_30")]


def food_events(src: P.ReactivationSources, keys: KeySet, hi, recent_days: int = R.RECENT_DAYS) -> list[DataFrame]:
    """A2a + A3: line-item value of the second service; ages are whole 24 hours, so a line of midnight is recent for
    a day less than a later one."""
    ts = F.col("order_received_timestamp")
    f = cut_lineage(keys.likely(src.value_lines.where(ts < F.lit(hi).cast("timestamp_ntz"))))
    day = ts.cast("date")
    f = f.withColumns({"at": F.date_add(day, 1), "until": F.date_add(day, recent_days + F.when(ts > day.cast("timestamp_ntz"), 1).otherwise(0))})
    days = f.groupBy("customer_id", "at").agg(
        F.sum("gtv").alias("food_gmv"), F.sum(F.col("gtv") - F.col("cogs") - F.col("partner_share")).alias("food_gp"), F.max(ts).alias("last_food_order_ts"))
    return [days, order_events(f, "customer_id", "order_id", "at", "until", "n_food_orders", "n_food_orders_30")]


def shop_events(src: P.ReactivationSources, keys: KeySet, hi) -> list[DataFrame]:
    """Order-level value of the lapsed service."""
    q = cut_lineage(keys.likely(src.order_level.where(F.col("day") < F.lit(hi)))).withColumn("at", _after("day"))
    days = q.groupBy("customer_id", "at").agg(F.sum("gmv").alias("shop_gmv"), F.sum(F.col("net_revenue") + F.col("delivery_costs") + F.col("wastage")).alias("shop_gp"))
    return [days, order_events(q, "customer_id", "order_id", "at", n="n_shop_orders")]


def outcome_events(src: P.ReactivationSources, keys: KeySet, anchors: Sequence[dt.date], outcome_days: int, cities) -> list[DataFrame]:
    """A4: an order of day d is in the outcome of the anchors from d - outcome_days to d - 1: amounts are put in on the
    first of these and taken out on d."""
    span = dt.timedelta(days=outcome_days)
    o = src.orders.select("customer_id", "order_id", "merchant_id", "order_status", "city_id", "order_type", "day", *OUTCOME.values())
    o = keys.likely(scan_window(o, "day", min(anchors), max(anchors) + span, lo_inclusive=False, hi_inclusive=True))
    o = delivered(o, cities=cities).join(src.merchants.select("merchant_id"), "merchant_id", "inner")
    o = o.withColumns({"at": F.date_sub("day", outcome_days), "until": F.date_sub("day", 1)})
    days = o.groupBy("customer_id", "day").agg(
        *(F.sum(c).alias(n) for n, c in OUTCOME.items()), *(F.count(c).alias(f"k_{n}") for n, c in OUTCOME.items()), F.count(F.lit(1)).alias("k_rows"))
    change = lambda day, sign: F.struct(day.alias("at"), *((F.col(c) * sign).alias(c) for c in [*OUTCOME, *(f"k_{n}" for n in OUTCOME), "k_rows"]))
    moved = days.select("customer_id", F.explode(F.array(change(F.date_sub("day", outcome_days), 1), change(F.col("day"), -1))).alias("e"))
    return [moved.select("customer_id", "e.*"), order_events(o, "customer_id", "order_id", "at", "until", None, "n_orders_after")]


KINDS = {
    "first_order_date": LEAST, "last_order_date": GREATEST, "newest": GREATEST, "lifetime_orders": SUM,
    "ride_gmv": SUM, "ride_gp": SUM, "last_ride_date": GREATEST, "n_rides": SUM, "n_rides_30": SUM,
    "food_gmv": SUM, "food_gp": SUM, "last_food_order_ts": GREATEST, "n_food_orders": SUM, "n_food_orders_30": SUM,
    "shop_gmv": SUM, "shop_gp": SUM, "n_shop_orders": SUM,
    **{c: SUM for n in OUTCOME for c in (n, f"k_{n}")}, "k_rows": SUM, "n_orders_after": SUM,
}


def order_history(src: P.ReactivationSources, keys: KeySet, anchors: Sequence[dt.date], history_start, outcome_days: int, cities) -> DataFrame:
    """The delivered order lines of the keys' customers that the lifetime or the outcome of any anchor reads, stored."""
    before = window_predicate("day", history_start, max(anchors))
    after = window_predicate("day", min(anchors), max(anchors) + dt.timedelta(days=outcome_days), lo_inclusive=False, hi_inclusive=True)
    o = src.orders.select("customer_id", "order_id", "merchant_id", "order_status", "city_id", "order_type", "order_received_timestamp", "day",
                          *OUTCOME.values())
    return cut_lineage(keys.likely(delivered(o.where(before | after), cities=cities)))


def states(src: P.ReactivationSources, keys: KeySet, anchors: Sequence[dt.date], history_start, outcome_days: int, outcome_cities, rides_since) -> list[DataFrame]:
    hi = max(anchors)
    cities = sorted({*R.LAPSED_SERVICE_CITIES, *outcome_cities})
    src = replace(src, orders=order_history(src, keys, anchors, history_start, outcome_days, cities))
    return [*lifetime_events(src, keys, history_start, hi), *ride_events(src, keys, rides_since, hi), *food_events(src, keys, hi),
            *shop_events(src, keys, hi), *outcome_events(src, keys, anchors, outcome_days, outcome_cities)]


def memberships_at(subs: DataFrame, keys: KeySet, anchors: Sequence[dt.date]) -> DataFrame:
    """W1m + C11 + F7 for each anchor: the latest started subscription that is active then."""
    s = P.typed_memberships(P.memberships(subs, keys), F.col("startedat").try_cast("date").alias("lo"), F.col("expiresat").try_cast("date").alias("hi"))
    active = F.filter(F.array(*(F.lit(a) for a in anchors)), lambda a: (F.col("hi") >= a) & (F.col("lo") < a))
    s = s.select("customer_id", "day", "event_seq", "member_type", F.explode(active).alias("anchor"))
    latest = latest_by(s, ["customer_id", "anchor"], ["day", "event_seq"], ["member_type"])
    return latest.select("customer_id", "anchor", F.lit(1).alias("member_flag"), "member_type")


def reactivation_features(src: P.ReactivationSources, anchors: Sequence[dt.date], history_start, outcome_days: int = 91,
                          outcome_cities=R.OUTCOME_CITIES, with_city: bool = True, with_blended: bool = False, rides_since=None) -> DataFrame:
    """P1 / P2 for all ``anchors``: ``anchor`` and the columns of the single-anchor job."""
    anchors = sorted(set(anchors))
    today = cut_lineage(anchor_orders(src, anchors))  # read by each key filter
    keys = KeySet(today)
    seen = cumulated(states(src, keys, anchors, history_start, outcome_days, outcome_cities, rides_since), today.select("customer_id", "anchor"), "customer_id", KINDS)
    rates = {f"{s}_gppo": safe_ratio(f"{s}_gp", n) for s, n in (("ride", "n_rides"), ("food", "n_food_orders"), ("shop", "n_shop_orders"))}
    joined = assemble(seen.withColumns(rates), [P.residency(keys.likely(src.customers))], "customer_id")
    joined = joined.select(
        "customer_id", "anchor", F.when(F.col("k_rows") > 0, F.col("n_orders_after")).alias("n_orders_after"),
        *(F.when(F.col(f"k_{n}") > 0, F.col(n)).alias(n) for n in OUTCOME), "first_order_date", "last_order_date",
        F.col("newest.merchant_name").alias("last_merchant"), F.datediff("anchor", "last_order_date").cast("long").alias("recency_days"),
        "lifetime_orders", "is_resident", *P.value_columns(F.col("anchor")))
    # as in the single-anchor job, customers without a history have no value features
    always = {"customer_id", "anchor", "n_orders_after", *OUTCOME}
    known = F.col("last_order_date").isNotNull()
    feats = joined.select(*(F.col(c) if c in always else F.when(known, F.col(c)).alias(c) for c in joined.columns))
    out = (today.join(feats, ["customer_id", "anchor"], "left").join(memberships_at(src.subscriptions, keys, anchors), ["customer_id", "anchor"], "left")
           .join(P.profile_features(src.profile, keys), "customer_id", "left"))
    return out.select("anchor", *P.feature_columns(with_city, with_blended))

