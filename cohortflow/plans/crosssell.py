"""Cross-sell cohorts and per-customer features.

``base`` is always a DataFrame argument (one row per ``customer_id``); feature sources are cut to
it with a left-semi join before any aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.bands import adoption_label, clean_category, threshold_label
from cohortflow.functions.keys import norm_key
from cohortflow.operators import aggregates as A
from cohortflow.operators import daybits as D
from cohortflow.operators.filters import valid_trips
from cohortflow.operators.joins import one_per_key, restrict_to
from cohortflow.operators.keysets import KeySet
from cohortflow.operators.scans import scan_window
from cohortflow.params import ObservationWindow

BASE_SERVICES, A_SERVICES, B_SERVICES = R.BASE_SERVICES, R.A_SERVICES, R.B_SERVICES


def valid_users(trips: DataFrame, W: ObservationWindow) -> DataFrame:
    """Base-service customers with a valid trip in ``[source_start, anchor)`` (distinct keys)."""
    t = valid_trips(scan_window(trips, "day", W.source_start, W.anchor))
    return t.select(norm_key("customer_id").alias("customer_id")).distinct()


def service_first_dates(first_orders: DataFrame, users: DataFrame, city: str = R.HOME_CITY) -> DataFrame:
    """A5 in one pass: first date of the base service and of services A and B per customer,
    kept for customers of the base service who are valid users (J3)."""
    f = first_orders.where(F.col("city") == city).select(
        norm_key("userid").alias("customer_id"), "service", "first_order_date")
    d = A.first_dates(f, key="customer_id", service_col="service", date_col="first_order_date",
                      services={"ride_first_order_date": BASE_SERVICES, "food_first_order_date": A_SERVICES,
                                "shop_first_order_date": B_SERVICES})
    # the semi-join after the aggregate, whose partial step splits a hot customer
    return restrict_to(d.where(F.col("ride_first_order_date").isNotNull()), users, "customer_id")


def adoption_cohort(trips: DataFrame, first_orders: DataFrame, W: ObservationWindow,
                    labels=R.ADOPTION_LABELS) -> DataFrame:
    """P5: base-service customers with first dates per service and an adoption label."""
    d = service_first_dates(first_orders, valid_users(trips, W))
    return d.select("customer_id", "ride_first_order_date", "food_first_order_date", "shop_first_order_date",
                    adoption_label("ride_first_order_date", "food_first_order_date", "shop_first_order_date",
                                   W.anchor, W.target_end, labels).alias("service"))


def crossed_on(trips: DataFrame, first_orders: DataFrame, W: ObservationWindow, service: str = "a") -> DataFrame:
    """Customers whose first order of the service is exactly on the anchor (F9), with
    the base date; the other service's date only when it was also first used on the anchor."""
    d = service_first_dates(first_orders, valid_users(trips, W))
    mine, other = (("food_first_order_date", "shop_first_order_date") if service == "a"
                   else ("shop_first_order_date", "food_first_order_date"))
    d = d.where(F.col(mine) == F.lit(W.anchor))
    return d.select("customer_id", "ride_first_order_date", mine,
                    F.when(F.col(other) == F.lit(W.anchor), F.col(other)).alias(other))


SERVICES = {"ride_first_order_date": BASE_SERVICES, "food_first_order_date": A_SERVICES, "shop_first_order_date": B_SERVICES}


def cohort_table(trips: DataFrame, first_orders: DataFrame, city: str = R.HOME_CITY) -> tuple[DataFrame, DataFrame]:
    """What the cohorts of every anchor are made of: the first date of each service by customer (customers of the base
    service), and the days with a valid trip as bitmaps. Both are one small row or a few for each customer, merge with
    those of new days (least date, ``daybits.merged``), and hold no anchor."""
    f = first_orders.where(F.col("city") == city).select(norm_key("userid").alias("customer_id"), "service", "first_order_date")
    d = A.first_dates(f, key="customer_id", service_col="service", date_col="first_order_date", services=SERVICES)
    t = valid_trips(trips).select(norm_key("customer_id").alias("customer_id"), "day")
    return d.where(F.col("ride_first_order_date").isNotNull()), D.day_words(t, ["customer_id"], "day")


def valid_at(words: DataFrame, windows: Sequence[ObservationWindow]) -> DataFrame:
    """customer_id, source_start, anchor and target_end for each window in which the customer has a valid trip before
    the anchor. The windows are a literal in the plan; each word of days meets those that touch it."""
    every = F.array(*(F.struct(F.lit(w.source_start).alias("source_start"), F.lit(w.anchor).alias("anchor"), F.lit(w.target_end).alias("target_end"))
                      for w in windows))
    first = F.col(D.WORD) * 64
    touched = F.filter(every, lambda a: (F.unix_date(a["source_start"]) < first + 64) & (F.unix_date(a["anchor"]) > first))
    rows = words.select("customer_id", D.WORD, D.BITS, F.explode(touched).alias("a")).select("customer_id", D.WORD, D.BITS, "a.*")
    return D.within(rows, F.col("source_start"), F.col("anchor")).select("customer_id", "source_start", "anchor", "target_end").distinct()


def cohorts(first: DataFrame, words: DataFrame, windows: Sequence[ObservationWindow], labels=R.ADOPTION_LABELS) -> DataFrame:
    """P5-P8 for all anchors: one row for each (anchor, customer of P5), with the adoption label (P5), the anchor stamp
    (P8) and whether service A or B was first used on the anchor (P6, P7)."""
    d = first.join(valid_at(words, windows), "customer_id")
    food, shop = F.col("food_first_order_date"), F.col("shop_first_order_date")
    return d.select(F.col("anchor").alias("anchor_date"), "customer_id", "ride_first_order_date", "food_first_order_date", "shop_first_order_date",
                    adoption_label("ride_first_order_date", "food_first_order_date", "shop_first_order_date", F.col("anchor"), F.col("target_end"), labels).alias("service"),
                    F.coalesce(food == F.col("anchor"), F.lit(False)).alias("crossed_a"), F.coalesce(shop == F.col("anchor"), F.lit(False)).alias("crossed_b"))


def stamp_anchor(base: DataFrame, W: ObservationWindow) -> DataFrame:
    """Cohort plus a literal anchor-date column."""
    return base.withColumn("anchor_date", F.lit(W.anchor))


def membership_status(base: DataFrame, subs: DataFrame, W: ObservationWindow, threshold: int,
                      labels=R.MEMBERSHIP_STATUS_LABELS) -> DataFrame:
    """P10: A6 active days in the window, C12 Active/Inactive label (missing days = 0)."""
    s = scan_window(subs, "day", W.source_start, W.anchor).select(norm_key("customer_id").alias("customer_id"), "day")
    # days as bitmaps: a hot customer is a few words before its rows meet
    days = D.count_days(D.day_words(s, ["customer_id"], "day"), ["customer_id"])
    out = base.select("customer_id").join(days, "customer_id", "left")
    label = threshold_label("active_days", threshold, labels[0], labels[1])
    return out.select("customer_id", label.alias("membership_status"))


def last_known_features(demo: DataFrame, base: DataFrame, W: ObservationWindow) -> DataFrame:
    """Last known gender, tourist flag and SIM country per customer, in one aggregate.

    Each feature is ``max_by(value, ordering)`` where the ordering is NULL for rows that do not
    qualify (such rows are skipped), replacing three scans and three windows. ``base`` is read twice: materialise it."""
    d = scan_window(demo, "day", W.source_start, W.anchor).withColumn("customer_id", norm_key("customer_id"))
    d = KeySet(base).likely(d)  # other customers end at the scan
    order = F.struct("day", "updated_at", "event_id")
    gender = clean_category("sex_prediction", R.GENDER_VALUES)
    tourist = clean_category("tourist_flag", R.TOURIST_VALUES)
    sim = F.trim(F.lower("tourist_country_simcard"))
    found = d.groupBy("customer_id").agg(
        F.max_by(gender, F.when(gender.isNotNull(), order)).alias("gender"),
        F.max(F.when(tourist.isNotNull(), F.lit(1))).alias("is_tourist"),
        F.max_by(sim, F.when(F.col("tourist_country_simcard").isNotNull(), order)).alias("sim_country"),
    )
    return restrict_to(found, base, "customer_id")  # after the aggregate, whose partial step splits a hot customer


def profile_features(profile: DataFrame, base: DataFrame) -> DataFrame:
    """Profile columns for cohort members (inner join on the normalised key)."""
    p = profile.select(norm_key("customer_id").alias("customer_id"), "nationality",
                       F.col("nationality_score").cast("double").alias("confidence"), "region", "sub_region",
                       "is_loyal", "is_resident", "services_used_60d")
    p = one_per_key(restrict_to(p, base, "customer_id"), "customer_id")
    return p
