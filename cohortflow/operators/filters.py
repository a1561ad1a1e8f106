"""Row filters (F1-F11). Each returns ``df.where(...)`` so Catalyst can push it to the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R


@dataclass(frozen=True)
class TripRules:
    """F1 valid-trip bundle."""

    service_area_id: int | None = R.SERVICE_AREA_ID
    trip_outcome: int = R.TRIP_OUTCOME_COMPLETED
    positive_coords: tuple = ("pick_up_latitude", "pick_up_longitude", "drop_off_latitude", "drop_off_longitude")
    not_null: tuple = ("captain_id", "customer_id", "booking_id")
    valid_flag: str | None = "is_valid"
    business_types: tuple = tuple(R.RIDE_BUSINESS_TYPES)
    product_col: str | None = "cct"
    excluded_product_pattern: str = R.EXCLUDED_PRODUCT_PATTERN
    product_id_col: str | None = "cct_id"
    excluded_product_ids: tuple = tuple(R.EXCLUDED_PRODUCT_IDS)
    country: str | None = None


# The looser rule set of the value (gross/margin) features.
VALUE_TRIP_RULES = TripRules(
    service_area_id=None, positive_coords=(), not_null=(), valid_flag=None,
    business_types=tuple(R.VALUE_RIDE_BUSINESS_TYPES), product_col=None, product_id_col=None,
    country=R.VALUE_COUNTRY,
)


def valid_trips(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """F1. ``NOT LIKE`` / ``NOT IN`` drop NULL rows, as in SQL."""
    conds = []
    if rules.service_area_id is not None:
        conds.append(F.col("service_area_id") == rules.service_area_id)
    conds.append(F.col("trip_outcome") == rules.trip_outcome)
    conds += [F.col(c) > 0 for c in rules.positive_coords]
    conds += [F.col(c).isNotNull() for c in rules.not_null]
    if rules.valid_flag:
        conds.append(F.col(rules.valid_flag) == 1)
    conds.append(F.lower("business_type").isin(list(rules.business_types)))
    if rules.product_col:
        conds.append(~F.lower(rules.product_col).like(rules.excluded_product_pattern))
    if rules.product_id_col:
        conds.append(~F.col(rules.product_id_col).isin(list(rules.excluded_product_ids)))
    if rules.country:
        conds.append(F.lower("country") == rules.country)
    return df.where(reduce(lambda a, b: a & b, conds))


@dataclass(frozen=True)
class BookingRules:
    """F2 completed-booking bundle."""

    service_area_id: int = R.SERVICE_AREA_ID
    status: int = R.BOOKING_STATUS_COMPLETED
    true_flags: tuple = ("is_trip_ended", "is_assigned")
    false_flags: tuple = ("is_cancelled_customer", "is_cancelled_captain")
    not_null: tuple = ("booking_id", "captain_id")
    business_types: tuple = tuple(R.RIDE_BUSINESS_TYPES)


def completed_bookings(df: DataFrame, rules: BookingRules = BookingRules()) -> DataFrame:
    conds = [F.col("service_area_id") == rules.service_area_id, F.col("booking_status") == rules.status]
    conds += [F.col(c) == F.lit(True) for c in rules.true_flags]
    conds += [F.col(c) == F.lit(False) for c in rules.false_flags]
    conds += [F.col(c).isNotNull() for c in rules.not_null]
    conds.append(F.lower("business_type").isin(list(rules.business_types)))
    return df.where(reduce(lambda a, b: a & b, conds))


def delivered(df: DataFrame, *, status_col: str = "order_status", statuses: Sequence[str] = (R.DELIVERED_STATUS,),
              case_insensitive: bool = True, city_col: str | None = "city_id",
              cities: Sequence[int] | None = R.LAPSED_SERVICE_CITIES, type_col: str | None = "order_type",
              order_type: str | None = R.B_ORDER_TYPE) -> DataFrame:
    """status in list (case-insensitive or exact), city in list, order type/domain."""
    s = F.lower(status_col) if case_insensitive else F.col(status_col)
    vals = [v.lower() for v in statuses] if case_insensitive else list(statuses)
    cond = s.isin(vals)
    if city_col and cities is not None:
        cond = cond & F.col(city_col).isin(list(cities))
    if type_col and order_type is not None:
        cond = cond & (F.col(type_col) == order_type)
    return df.where(cond)


def name_contains(df: DataFrame, col: str, word: str) -> DataFrame:
    """case-insensitive substring match."""
    return df.where(F.lower(col).like(f"%{word.lower()}%"))


def exclude_like(df: DataFrame, patterns: Mapping[str, Sequence[str]], require_not_null: Sequence[str] = ()) -> DataFrame:
    """drop rows matching any pattern; a NULL in a tested column drops the row."""
    conds = [F.col(c).isNotNull() for c in require_not_null]
    for c, pats in patterns.items():
        conds += [~F.col(c).like(p) for p in pats]
    return df.where(reduce(lambda a, b: a & b, conds))


def active_at(df: DataFrame, start_col: str, end_col: str, anchor) -> DataFrame:
    """interval contains the anchor: ends on/after it and started before it. As with ids (F6), a date that
    cannot be cast is NULL and does not fail the job; its row drops out."""
    return df.where((F.col(end_col).try_cast("date") >= F.lit(anchor)) & (F.col(start_col).try_cast("date") < F.lit(anchor)))


def lapsed(df: DataFrame, recency_col: str, min_days: int) -> DataFrame:
    """F8: recency strictly above ``min_days``."""
    return df.where(F.col(recency_col) > min_days)


def at_least(df: DataFrame, col: str, minimum) -> DataFrame:
    return df.where(F.col(col) >= minimum)


def first_on(df: DataFrame, col: str, day) -> DataFrame:
    """F9 (applied after aggregation): first date equals the day."""
    return df.where(F.col(col) == F.lit(day))


@dataclass(frozen=True)
class CreditRules:
    title: str = R.CREDIT_TITLE
    types: tuple = tuple(R.MEMBERSHIP_CREDIT_TYPES)
    title_col: str = "credit_title"
    type_col: str = "credit_type"


def credit_usage(df: DataFrame, rules: CreditRules = CreditRules()) -> DataFrame:
    """membership credit rows (the caller applies the day window)."""
    return df.where((F.lower(rules.title_col) == rules.title) & F.lower(rules.type_col).isin(list(rules.types)))
