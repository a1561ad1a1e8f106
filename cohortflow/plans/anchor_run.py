"""One anchor's cross-sell feature tables over one materialized cohort.

Upstream, each feature query re-derives the customer base from a text prefix. Here the base is
built once, written to the checkpoint directory (reliable, survives executor loss), and every
feature job reads it; ``write_tables`` stores each result as Parquet partitioned by anchor with
dynamic overwrite, so rerunning an anchor replaces only that anchor's partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from cohortflow import rules as R
from cohortflow.params import ObservationWindow, TripThresholds
from cohortflow.plans import crosssell as X
from cohortflow.plans import locations as L
from cohortflow.plans import places as PL
from cohortflow.plans import postcross as PC
from cohortflow.plans import trips as TR
from cohortflow.session import cut_lineage
from cohortflow.sources.sinks import write_partitioned


@dataclass(frozen=True)
class CrossSellSources:
    trips: DataFrame
    first_orders: DataFrame
    credits: DataFrame
    active_subs: DataFrame
    bookings: DataFrame
    place_locations: DataFrame
    place_coordinates: DataFrame
    place_details: DataFrame
    demographics: DataFrame
    profile: DataFrame

    @staticmethod
    def from_testbed(src) -> "CrossSellSources":
        return CrossSellSources(src.trips, src.first_orders, src.credits, src.active_subs, src.bookings,
                                src.place_locations, src.place_coordinates, src.place_details, src.demographics,
                                src.profile)


def cross_sell_tables(src: CrossSellSources, W: ObservationWindow, *, thresholds: TripThresholds = TripThresholds(),
                      membership_days: int = 18, place_min_count: int = 1, lines: Sequence[str] = ("food",),
                      feature_window: ObservationWindow | None = None, base: str = "adoption",
                      cell_expr: Column | None = None) -> dict[str, DataFrame]:
    """All cross-sell outputs for one anchor.

    ``W`` defines the cohort; ``feature_window`` (default ``W``) the history of the behavioural
    features. ``base`` is the customer base: ``adoption`` (P5), ``crossed_a`` (P6) or ``crossed_b``
    (P7). Area scores (adoption base only) come for each of the ``lines``. The base and the points
    of both sides are materialised once, as several tables read them."""
    FW = feature_window or W
    build = {"adoption": lambda: X.adoption_cohort(src.trips, src.first_orders, W),
             "crossed_a": lambda: X.crossed_on(src.trips, src.first_orders, W, "a"),
             "crossed_b": lambda: X.crossed_on(src.trips, src.first_orders, W, "b")}
    customers = cut_lineage(build[base]())
    drop_pts = cut_lineage(L.point_counts(src.trips, customers, FW, "dropoff"))
    pick_pts = cut_lineage(L.point_counts(src.trips, customers, FW, "pickup"))
    drop_cell, pick_cell = L.dominant_cell(drop_pts, cell_expr=cell_expr), L.dominant_cell(pick_pts, cell_expr=cell_expr)
    out = {
        "customer_base": X.stamp_anchor(customers, W),
        "trip_features": TR.trip_features(src.trips, customers, src.credits, FW, thresholds),
        "membership_status": X.membership_status(customers, src.active_subs, FW, membership_days),
        "commute_place": PL.commute_place(src.bookings, src.place_locations, src.place_coordinates,
                                          src.place_details, customers, FW, place_min_count),
        "last_known_features": X.last_known_features(src.demographics, customers, FW),
        "profile_features": X.profile_features(src.profile, customers),
        "dropoff_points": drop_pts,
        "pickup_points": pick_pts,
        "home_cell_dropoff": drop_cell,
        "home_cell_pickup": pick_cell,
    }
    for line in lines if base == "adoption" else ():
        first_col = f"{line}_first_order_date"
        frame = L.area_frame(customers, drop_cell, pick_cell, first_col)
        for side in L.SIDES:
            out[f"area_scores/{line}/{side}"] = L.area_scores(frame, area=f"cell_{side}", first_col=first_col,
                                                              start=W.source_start, end=W.anchor)
    return out


def post_cross_tables(src: CrossSellSources, orders: DataFrame, merchant_tags: DataFrame, tags: DataFrame,
                      W: ObservationWindow, word: str = R.B_BRAND_WORD) -> dict[str, DataFrame]:
    """What the customers who crossed on the anchor ordered in the outcome window."""
    crossed = {s: cut_lineage(X.crossed_on(src.trips, src.first_orders, W, s)) for s in "ab"}
    return {"post_cross_tagged": PC.post_cross_tagged(orders, crossed["a"], merchant_tags, tags, W, orders.sparkSession),
            "post_cross_orders": PC.post_cross_orders(orders, crossed["b"], W, word=word)}


def write_tables(tables: dict[str, DataFrame], root: str, anchor) -> dict[str, str]:
    """Write each table to ``root/<name>`` partitioned by anchor (dynamic partition overwrite). The
    tables ``area_scores/<line>/<side>`` go to one table partitioned by line, anchor and side, so a
    line does not replace another."""
    paths = {}
    for name, df in tables.items():
        table, *keys = name.split("/")
        path = paths[name] = f"{root.rstrip('/')}/{table}"
        if keys:
            L.write_scores(df, path, keys[0], anchor, keys[1])
        else:
            write_partitioned(df, path, {"anchor": anchor})
    return paths
