"""Reactivation jobs (P1-P4): lapsed cohorts, lifetime / value / recency features per service,
membership, profile, and the outcome after the anchor.

Service roles are parameters (``lapsed`` = the service customers lapsed from, ``second`` and
``base`` = the other two services); column names follow the role prefixes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.bands import band, membership_type
from cohortflow.functions.keys import norm_key
from cohortflow.functions.measures import blended_margin, calendar_days, elapsed_days, total_value
from cohortflow.operators import aggregates as A
from cohortflow.operators.filters import VALUE_TRIP_RULES, active_at, delivered, lapsed, valid_trips
from cohortflow.operators.joins import assemble, one_per_key
from cohortflow.operators.keysets import KeySet
from cohortflow.operators.scans import scan_window
from cohortflow.operators.windows import latest_by, rank_within
from cohortflow.params import ObservationWindow
from cohortflow.session import cut_lineage

MONEY = "double"


@dataclass(frozen=True)
class ReactivationSources:
    orders: DataFrame          # delivery order lines (both order tables)
    merchants: DataFrame       # merchant allow-list of the lapsed service
    customers: DataFrame       # customer_id, is_resident
    value_lines: DataFrame     # second service, line-item level
    order_level: DataFrame     # lapsed service, order level (profit table)
    trips: DataFrame           # base service trips
    subscriptions: DataFrame   # membership change log
    profile: DataFrame         # profile dimension

    @staticmethod
    def from_testbed(src) -> "ReactivationSources":
        return ReactivationSources(src.orders, src.merchants, src.customers, src.value_lines, src.order_level,
                                   src.trips, src.subscription_events, src.profile)


def lapsed_service_history(orders: DataFrame, merchants: DataFrame, W: ObservationWindow,
                           cities=R.LAPSED_SERVICE_CITIES, order_type: str = R.B_ORDER_TYPE) -> DataFrame:
    """S1 + F3 + J1: delivered orders of the lapsed service in ``[history_start, anchor)``."""
    o = orders.select("customer_id", "order_id", "line_no", "merchant_id", "order_status", "city_id", "order_type",
                      "order_received_timestamp", "day")
    o = delivered(scan_window(o, "day", W.history_lo, W.anchor), cities=cities, order_type=order_type)
    return o.join(merchants, "merchant_id", "inner")


def lifetime_features(history: DataFrame, W: ObservationWindow) -> DataFrame:
    """A1 + last merchant (one aggregate) + C1/C2 bands."""
    life = A.lifetime(history, key="customer_id", day="day", order_id="order_id", anchor=W.anchor,
                      last_value="merchant_name",
                      last_order=["order_received_timestamp", "order_id", "merchant_name"],
                      names={"orders": "lifetime_orders", "recency": "recency_days", "last_value": "last_merchant"})
    return life.select(
        "customer_id", "recency_days", "first_order_date", "last_order_date",
        band("lifetime_orders", R.ORDER_COUNT_BANDS).alias("order_cohort"),
        band("recency_days", R.RECENCY_BANDS, R.RECENCY_ELSE).alias("recency_band"),
        "lifetime_orders", "last_merchant")


def lapsed_base(src: ReactivationSources, W: ObservationWindow, min_recency: int = R.LAPSE_MIN_DAYS,
                min_orders: int = R.GRADUATED_MIN_ORDERS) -> DataFrame:
    """Lapsed, resident customers with at least ``min_orders`` delivered orders."""
    life = lapsed(lifetime_features(lapsed_service_history(src.orders, src.merchants, W), W), "recency_days", min_recency)
    base = life.select(F.lit(W.anchor).alias("day"), *life.columns)
    base = base.join(residency(src.customers), "customer_id", "left")
    return base.where((F.col("is_resident") == F.lit(True)) & (F.col("lifetime_orders") >= min_orders)).select(
        "day", "customer_id", "recency_days", "first_order_date", "last_order_date", "order_cohort", "recency_band",
        "lifetime_orders", "last_merchant", "is_resident")


def ride_value(trips: DataFrame, W: ObservationWindow, since=None, recent_days: int = R.RECENT_DAYS) -> DataFrame:
    """S2 + A2c + A3: de-duplicated value trips before the anchor, over one range (T10 fixed).

    ``since`` is a lower bound of the day; None has none: the ride history is longer than the order
    history, whose start does not cut it."""
    t = valid_trips(scan_window(trips, "day", since, W.anchor), VALUE_TRIP_RULES)
    # Plain distinct: its map-side partial step removes copies before the shuffle, so even a
    # group of copies holding a third of all rows never reaches one task whole.
    t = t.select("day", norm_key("customer_id").alias("customer_id"), "trip_id", "revenue", "cogs").distinct()
    return A.value_stats(
        t, key="customer_id", order_id="trip_id", gross=F.col("revenue"), margin=F.col("revenue") - F.col("cogs"),
        recent=calendar_days("day", W.anchor) <= recent_days, last="day",
        names={"n": "n_rides", "n_recent": "n_rides_30", "gmv": "ride_gmv", "gp": "ride_gp", "gppo": "ride_gppo",
               "last": "last_ride_date"})


def second_service_value(lines: DataFrame, W: ObservationWindow, recent_days: int = R.RECENT_DAYS) -> DataFrame:
    """A2a + A3: line-item value of the second service before the anchor (ages in whole 24 h)."""
    f = lines.where(F.col("order_received_timestamp") < F.lit(W.anchor).cast("timestamp_ntz"))
    return A.value_stats(
        f, key="customer_id", order_id="order_id", gross=F.col("gtv"),
        margin=F.col("gtv") - F.col("cogs") - F.col("partner_share"),
        recent=elapsed_days("order_received_timestamp", W.anchor) <= recent_days, last="order_received_timestamp",
        names={"n": "n_food_orders", "n_recent": "n_food_orders_30", "gmv": "food_gmv", "gp": "food_gp",
               "gppo": "food_gppo", "last": "last_food_order_ts"})


def lapsed_service_value(order_level: DataFrame, W: ObservationWindow) -> DataFrame:
    """Order-level value of the lapsed service before the anchor."""
    q = order_level.where(F.col("day") < F.lit(W.anchor))
    return A.value_stats(
        q, key="customer_id", order_id="order_id", gross=F.col("gmv"),
        margin=F.col("net_revenue") + F.col("delivery_costs") + F.col("wastage"),
        names={"n": "n_shop_orders", "gmv": "shop_gmv", "gp": "shop_gp", "gppo": "shop_gppo"})


def memberships(subs: DataFrame, keys: KeySet | None = None) -> DataFrame:
    """Started subscriptions of the membership areas."""
    s = subs.where((F.lower("eventtype") == R.MEMBERSHIP_EVENT) & F.col("serviceareaid").isin(R.MEMBERSHIP_AREAS))
    return s if keys is None else keys.likely(with_key(s, "userid", 5), "__key")


def latest_membership(subs: DataFrame, W: ObservationWindow, keys: KeySet | None = None) -> DataFrame:
    """W1m + C11 + F7: membership type from the latest started subscription active at the anchor."""
    s = active_at(memberships(subs, keys), "startedat", "expiresat", W.anchor)
    latest = latest_by(typed_memberships(s), ["customer_id"], ["day", "event_seq"], ["member_type"])
    return latest.select("customer_id", F.lit(1).alias("member_flag"), "member_type")


def typed_memberships(s: DataFrame, *more: str) -> DataFrame:
    """C11: customer_id, day, event_seq and member_type of subscriptions, and the columns ``more``."""
    return s.select(norm_key("userid", 5).alias("customer_id"), "day", "event_seq", *more,
                    membership_type("subscriptiontype", "planid", "invoiceid",
                                    paid_types=R.PAID_SUBSCRIPTION_TYPES, paid_plans=R.PAID_PLAN_IDS,
                                    free_renewal=R.FREE_RENEWAL_PATTERN, trial_commitment=R.TRIAL_COMMITMENT_PATTERN,
                                    trial=R.TRIAL_PATTERN).alias("member_type"))


def profile_features(profile: DataFrame, keys: KeySet | None = None) -> DataFrame:
    """Profile columns, one row per customer (duplicates cannot fan out, T11)."""
    if keys is not None:
        profile = keys.likely(with_key(profile), "__key")
    return one_per_key(profile.select(norm_key("customer_id").alias("customer_id"), "nationality", "region",
                                      "sub_region", "is_loyal"), "customer_id")


def residency(customers: DataFrame) -> DataFrame:
    """Residency flag, one row per customer."""
    return one_per_key(customers.select("customer_id", "is_resident"), "customer_id")


def with_key(df: DataFrame, col: str = "customer_id", prefix_len: int = 0) -> DataFrame:
    """``df`` with the normalised id beside it, for a key set (its own column keeps its form)."""
    return df.withColumn("__key", norm_key(col, prefix_len))


def value_columns(anchor) -> list[Column]:
    """The value and recency columns with their defaults (M2-M6) from joined value statistics; ``anchor`` is a date
    or a column of dates."""
    z = F.lit(0)
    return [
        F.coalesce("n_food_orders_30", z).alias("n_food_orders_30"),
        F.coalesce("food_gmv", z).cast(MONEY).alias("food_gmv"),
        F.coalesce("n_rides_30", z).alias("n_rides_30"),
        F.coalesce("ride_gmv", z).cast(MONEY).alias("ride_gmv"),
        F.coalesce(elapsed_days("last_food_order_ts", anchor), F.lit(R.MISSING_RECENCY_DAYS)).alias("food_recency"),
        F.coalesce(calendar_days("last_ride_date", anchor), F.lit(R.MISSING_RECENCY_DAYS)).alias("ride_recency"),
        F.coalesce("n_rides", z).alias("n_rides"),
        F.coalesce("ride_gp", z).cast(MONEY).alias("ride_gp"),
        F.coalesce("ride_gppo", F.lit(0.0)).alias("ride_gppo"),
        F.coalesce("n_food_orders", z).alias("n_food_orders"),
        F.coalesce("food_gp", z).cast(MONEY).alias("food_gp"),
        F.coalesce("food_gppo", F.lit(0.0)).alias("food_gppo"),
        F.coalesce("n_shop_orders", z).alias("n_shop_orders"),
        F.coalesce("shop_gp", z).cast(MONEY).alias("shop_gp"),
        F.coalesce("shop_gppo", F.lit(0.0)).alias("shop_gppo"),
        F.coalesce("shop_gmv", z).cast(MONEY).alias("shop_gmv"),
        total_value("ride_gmv", "food_gmv", "shop_gmv").cast(MONEY).alias("total_gmv"),
        blended_margin(["ride_gp", "food_gp", "shop_gp"],
                       ["n_rides", "n_food_orders", "n_shop_orders"]).alias("blended_gppo"),
    ]


def value_tables(src: ReactivationSources, W: ObservationWindow, rides_since=None, restrict: KeySet | None = None) -> dict[str, DataFrame]:
    """Value statistics of rides, food and shop and the residency, a row for each customer.

    With ``restrict`` the histories are cut to those customers at the scan, by the key set's bits, so other customers
    do not reach the shuffle; the few that the bits let through go in the join with the spine."""
    trips, lines, order_level, people = src.trips, src.value_lines, src.order_level, src.customers
    if restrict is not None:
        trips, lines, order_level, people = (restrict.likely(x, k) for x, k in (
            (with_key(trips), "__key"), (lines, "customer_id"), (order_level, "customer_id"), (people, "customer_id")))
    return {"rides": ride_value(trips, W, rides_since), "food": second_service_value(lines, W), "shop": lapsed_service_value(order_level, W),
            "resident": residency(people)}


def value_features(spine: DataFrame, src: ReactivationSources, W: ObservationWindow, rides_since=None,
                   restrict: KeySet | None = None) -> DataFrame:
    """Cross-service value and recency features with the 0 / 365 defaults (M2, M3) on a spine."""
    j = assemble(spine, list(value_tables(src, W, rides_since, restrict).values()), "customer_id")
    return j.select(*spine.columns, *value_columns(W.anchor), "is_resident")


def reactivation_targets(src: ReactivationSources, W: ObservationWindow, min_recency: int = R.LAPSE_MIN_DAYS,
                         min_orders: int = R.GRADUATED_MIN_ORDERS,
                         rides_since=None) -> DataFrame:
    """Lapsed customers with value features, membership and profile; residents with at least
    ``min_orders`` orders in the profit table. The lapsed customers are materialised once: they are the key set that
    cuts every other history at its scan."""
    life = lapsed(lifetime_features(lapsed_service_history(src.orders, src.merchants, W), W), "recency_days", min_recency)
    spine = cut_lineage(life.select(F.lit(W.anchor).alias("day"), *life.columns))  # read by each key filter
    keys = KeySet(spine)
    feats = value_features(spine, src, W, rides_since, restrict=keys)
    feats = assemble(feats, [latest_membership(src.subscriptions, W, keys), profile_features(src.profile, keys)], "customer_id")
    out = feats.withColumn("member_flag", F.coalesce("member_flag", F.lit(0)))
    return out.where((F.col("is_resident") == F.lit(True)) & (F.col("n_shop_orders") >= min_orders)).drop("blended_gppo")


def anchor_day_lines(src: ReactivationSources, W: ObservationWindow, cities=R.LAPSED_SERVICE_CITIES) -> DataFrame:
    """Delivered order lines of the anchor day at allow-listed merchants (one day partition)."""
    o = src.orders.select("customer_id", "order_id", "line_no", "merchant_id", "order_status", "city_id", "order_type",
                          "order_received_timestamp", "day", "promo_code", "basket_amount", "promo_amount",
                          "net_basket_amount_with_tax")
    o = delivered(scan_window(o, "day", W.anchor, W.anchor, hi_inclusive=True), cities=cities)
    return o.join(src.merchants.select("merchant_id"), "merchant_id", "inner")


def anchor_day_orders(src: ReactivationSources, W: ObservationWindow, cities=R.LAPSED_SERVICE_CITIES) -> DataFrame:
    """Orders of the anchor day with their sequence within the customer's day."""
    return rank_within(anchor_day_lines(src, W, cities), "customer_id",
                       [F.col("order_received_timestamp").asc_nulls_last(), F.col("order_id").asc_nulls_last(),
                        F.col("line_no").asc_nulls_last()], out="day_order_rn")


def outcome_after(src: ReactivationSources, W: ObservationWindow, cities=R.OUTCOME_CITIES,
                  restrict: KeySet | None = None) -> DataFrame:
    """A4: delivered orders in ``(anchor, end_date]``; ``restrict`` cuts other customers at the scan."""
    o = src.orders.select("customer_id", "order_id", "merchant_id", "order_status", "city_id", "order_type", "day",
                          "basket_amount", "promo_amount", "net_basket_amount_with_tax")
    o = delivered(scan_window(o, "day", W.anchor, W.outcome_end_inclusive, lo_inclusive=False, hi_inclusive=True),
                  cities=cities)
    if restrict is not None:
        o = restrict.likely(o)
    o = o.join(src.merchants.select("merchant_id"), "merchant_id", "inner")
    return A.outcome(o, key="customer_id", order_id="order_id", n_name="n_orders_after",
                     sums={"basket_after": "basket_amount", "promo_after": "promo_amount",
                           "spend_after": "net_basket_amount_with_tax"})


def reactivation_features(src: ReactivationSources, W: ObservationWindow, outcome_cities=R.OUTCOME_CITIES,
                          with_city: bool = True, with_blended: bool = False, rides_since=None) -> DataFrame:
    """One row per anchor-day order line with sequence, outcome, and history features.

    The ranked anchor day is materialised once (``rank_within``); its customers are the key set to
    which every other source is cut before it is aggregated."""
    today = anchor_day_orders(src, W)
    keys = KeySet(today)
    history = lapsed_service_history(keys.likely(src.orders), src.merchants, W)
    life = lifetime_features(history, W)
    feats = value_features(life, src, W, rides_since, restrict=keys)
    out = assemble(today, [outcome_after(src, W, outcome_cities, keys), feats, latest_membership(src.subscriptions, W, keys),
                           profile_features(src.profile, keys)], "customer_id")
    return out.select(*feature_columns(with_city, with_blended))


def feature_columns(with_city: bool = True, with_blended: bool = False) -> list:
    """The columns of P1 / P2 in order."""
    return ["customer_id"] + (["city_id"] if with_city else []) + [
        "day_order_rn", "promo_code",
        F.col("basket_amount").cast(MONEY).alias("basket_amount"),
        F.col("promo_amount").cast(MONEY).alias("promo_amount"),
        F.col("net_basket_amount_with_tax").cast(MONEY).alias("net_basket_amount_with_tax"),
        "n_orders_after",
        F.col("basket_after").cast(MONEY).alias("basket_after"),
        F.col("promo_after").cast(MONEY).alias("promo_after"),
        F.col("spend_after").cast(MONEY).alias("spend_after"),
        F.col("recency_days").alias("shop_recency"), "food_recency", "ride_recency",
        "first_order_date", "last_order_date", "lifetime_orders", "last_merchant",
        "n_rides", "n_rides_30", "ride_gmv", "ride_gp", "ride_gppo",
        "n_food_orders", "n_food_orders_30", "food_gmv", "food_gp", "food_gppo",
        "n_shop_orders", "shop_gp", "shop_gppo", "shop_gmv", "total_gmv"] + (
        ["blended_gppo"] if with_blended else []) + [
        "is_resident", F.coalesce("member_flag", F.lit(0)).alias("member_flag"), "member_type",
        "nationality", "region", "sub_region", "is_loyal"]
