"""Main commute place from saved places near drop-offs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.bands import place_class
from cohortflow.functions.geo import with_decoded_point
from cohortflow.functions.keys import norm_key
from cohortflow.operators.aggregates import point_counts
from cohortflow.operators.filters import completed_bookings, exclude_like
from cohortflow.operators.joins import near_join, restrict_to
from cohortflow.operators.keysets import KeySet
from cohortflow.operators.scans import scan_window
from cohortflow.operators.windows import latest_by, share_of_total, top1_by_count
from cohortflow.params import ObservationWindow
from cohortflow.session import cut_lineage


def completed_dropoffs(bookings: DataFrame, base: DataFrame, W: ObservationWindow) -> DataFrame:
    """F2 in the window, cut to the cohort; distinct (customer, point, time, booking)."""
    b = completed_bookings(scan_window(bookings, "day", W.source_start, W.anchor))
    b = b.select(norm_key("customer_id").alias("customer_id"),
                 F.col("dropoff_lat").cast("double").alias("drop_off_latitude"),
                 F.col("dropoff_long").cast("double").alias("drop_off_longitude"),
                 F.col("booking_creation_date").cast("timestamp_ntz").alias("pick_up_time"),
                 norm_key("booking_id").alias("booking_id")).distinct()
    return restrict_to(b, base, "customer_id")


def saved_places(locations: DataFrame, coordinates: DataFrame, details: DataFrame, base: DataFrame) -> DataFrame:
    """Latest version of the place, its coordinates and its address details, inner-joined.

    Each latest-version pick is a ``max_by`` aggregate (W1) with all value columns as tie. The cohort's
    places are materialised once: the coordinate and detail tables are cut to their ids at the scan, so the
    version aggregates only see the places that can match."""
    loc = locations.select(norm_key("user_id").alias("sl_customer_id"), norm_key("id").alias("location_id"),
                           F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                           F.col("last_updated").cast("timestamp_ntz").alias("last_updated"))
    loc = restrict_to(loc, base, "sl_customer_id", "customer_id")
    loc = cut_lineage(latest_by(loc, ["sl_customer_id", "location_id"], ["last_updated", "created_at"]))
    ids = KeySet(loc, "location_id")
    coord = coordinates.select(norm_key("location_bookmark_id").alias("location_id"), "last_updated", "lng_lat")
    coord = ids.likely(coord)
    coord = with_decoded_point(coord, "lng_lat", "sl_lat", "sl_lon").drop("lng_lat")
    coord = latest_by(coord, ["location_id"], ["last_updated", "sl_lat", "sl_lon"], ["sl_lat", "sl_lon"])
    det = details.select(norm_key("location_bookmark_id").alias("location_id"), "last_updated",
                         F.col("saved_name").cast("string").alias("saved_name"),
                         F.col("address_type").cast("string").alias("address_type"),
                         F.col("building_type").cast("string").alias("building_type"),
                         F.col("place_name").cast("string").alias("place_name"))
    det = latest_by(ids.likely(det), ["location_id"],
                    ["last_updated", "saved_name", "address_type", "building_type", "place_name"],
                    ["saved_name", "address_type", "building_type", "place_name"])
    return loc.join(coord, "location_id", "inner").join(det, "location_id", "inner")


def matched_places(bookings: DataFrame, places: DataFrame, metres: float = R.PLACE_RADIUS_M) -> DataFrame:
    """J6 + W6: for each drop-off, the saved place within ``metres`` created before the booking,
    newest created first, then newest updated (then location id)."""
    j = near_join(bookings, places, key="customer_id", place_key="sl_customer_id",
                  ev_lat="drop_off_latitude", ev_lon="drop_off_longitude", pl_lat="sl_lat", pl_lon="sl_lon",
                  metres=metres, extra=F.col("pick_up_time") > F.col("created_at"), how="inner")
    j = j.select("customer_id", "booking_id", "location_id", "created_at", "last_updated",
                 F.lower("saved_name").alias("sl_name"), F.lower("address_type").alias("sl_address_type"),
                 F.lower("building_type").alias("sl_building_type"), F.lower("place_name").alias("sl_place_name"))
    return latest_by(j, ["customer_id", "booking_id"], ["created_at", "last_updated", "location_id"])


def commute_place(bookings: DataFrame, locations: DataFrame, coordinates: DataFrame, details: DataFrame,
                  base: DataFrame, W: ObservationWindow, min_count: int, metres: float = R.PLACE_RADIUS_M,
                  legacy_decimal_scale: bool = False) -> DataFrame:
    """The place class a customer travels to most, when seen at least ``min_count`` times.

    Best match first (W6), residential exclusions after (F5, T22), class (C10), counts (A13),
    top by share (W7). ``legacy_decimal_scale=True`` ranks by the share rounded to one decimal of
    a fraction (10 % steps, the upstream decimal arithmetic, T3); ties then go to the smallest
    class name instead of the larger count."""
    best = matched_places(completed_dropoffs(bookings, base, W), saved_places(locations, coordinates, details, base),
                          metres)
    kept = exclude_like(best, R.RESIDENTIAL_EXCLUSIONS, require_not_null=["sl_name"])
    classified = kept.select("customer_id",
                             place_class("sl_name", "sl_building_type", R.PLACE_CLASSES).alias("classified_location"))
    counts = point_counts(classified, ["customer_id", "classified_location"], out="location_count")
    if legacy_decimal_scale:
        shares = share_of_total(counts, "customer_id", "location_count", "__pct")
        rank = F.round(F.col("__pct") / F.lit(100.0), 1)
        best = F.min_by(F.struct(F.col("classified_location").alias("v"), F.col("location_count").alias("n")),
                        F.struct((-rank).alias("r"), F.col("classified_location").alias("t")))
        top = (shares.groupBy("customer_id").agg(best.alias("__b"))
                     .select("customer_id", F.col("__b.v").alias("commute_type"), F.col("__b.n").alias("location_count"))
                     .where(F.col("location_count") >= min_count))
        return top
    top = top1_by_count(counts, "customer_id", "classified_location", "location_count", min_count, out="commute_type")
    return top.select("customer_id", "commute_type", "location_count")
