"""Trip end points, home cells and area adoption scores (P14, P15, P18, P19, sink S5).

The upstream notebook pulls the point table into pandas and loops over rows; here the cell is a
column expression, the busiest cell is an aggregate, and the Wilson bound is a column, so the
whole chain is one lazy plan ending in a partitioned Parquet write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.bands import between_flag
from cohortflow.functions.geo import hex_cell, round_point
from cohortflow.functions.keys import norm_key
from cohortflow.functions.measures import wilson_lower
from cohortflow.operators import aggregates as A
from cohortflow.operators.filters import valid_trips
from cohortflow.operators.joins import assemble, restrict_to
from cohortflow.operators.keysets import KeySet
from cohortflow.operators.scans import scan_window
from cohortflow.params import ObservationWindow
from cohortflow.sources.sinks import write_partitioned

SIDES = {"dropoff": ("drop_off_latitude", "drop_off_longitude"), "pickup": ("pick_up_latitude", "pick_up_longitude")}


def point_counts(trips: DataFrame, base: DataFrame, W: ObservationWindow, side: str = "dropoff",
                 decimals: int = 3) -> DataFrame:
    """Trips per customer and rounded point (G3, A12, A13). ``base`` is read twice: materialise it."""
    lat, lon = SIDES[side]
    t = valid_trips(scan_window(trips, "day", W.source_start, W.anchor)).withColumn("customer_id", norm_key("customer_id"))
    t = KeySet(base).likely(t)  # other customers end at the scan
    rlat, rlon = round_point(lat, lon, decimals)
    pts = t.select("customer_id", norm_key("booking_id").alias("booking_id"), rlat.alias("latitude"),
                   rlon.alias("longitude")).distinct()
    # The semi-join comes last: above it, the counts would put all trips of a hot customer into one task.
    return restrict_to(A.point_counts(pts, ["customer_id", "latitude", "longitude"], out="trip_cnts"), base, "customer_id")


def dominant_cell(points: DataFrame, edge_km: float = R.HEX_EDGE_KM, ref_lat: float | None = None,
                  cell_col: str = "cell", cell_expr: Column | None = None) -> DataFrame:
    """The cell with the most trips per customer (G5 + A15; ties -> smallest cell id).

    ``cell_expr`` gives the cell of a point (columns latitude, longitude) in another grid."""
    p = points.withColumn(cell_col, hex_cell("latitude", "longitude", edge_km, ref_lat) if cell_expr is None else cell_expr)
    return A.argmax_by(p, key="customer_id", cat=cell_col, value="trip_cnts", out_value="trip_loc_cnts")


def area_frame(cohort: DataFrame, dropoff_cells: DataFrame, pickup_cells: DataFrame, first_col: str) -> DataFrame:
    """One row per cohort customer: first-order date of the line and both home cells."""
    d = dropoff_cells.select("customer_id", F.col("cell").alias("cell_dropoff"))
    p = pickup_cells.select("customer_id", F.col("cell").alias("cell_pickup"))
    return assemble(cohort.select("customer_id", first_col), [d, p], "customer_id")


def area_scores(frame: DataFrame, *, area: str, first_col: str, start, end, min_n: int = R.MIN_AREA_CUSTOMERS,
                confidence: float = R.WILSON_CONFIDENCE) -> DataFrame:
    """Per area, customers, adopters (first date within ``[start, end]``, C14) and the Wilson
    lower bound of the adoption share (M7); areas with more than ``min_n`` customers (A14)."""
    f = frame.withColumn("flag", between_flag(F.to_date(F.col(first_col)), start, end))
    s = A.area_stats(f, area=area, flag="flag", n_name="n_customers", k_name="n_adopters")
    return (s.withColumn("wilson_lower", wilson_lower("n_adopters", "n_customers", confidence))
             .where(F.col("n_customers") > min_n)
             .select(F.col(area).alias("area"), "n_customers", "n_adopters", "wilson_lower"))


def write_scores(scores: DataFrame, path: str, line: str, anchor, side: str, mode: str = "overwrite") -> None:
    """Parquet sink partitioned by business line, anchor and side (no single-file coalesce).

    Overwrite is dynamic: only the (line, anchor, side) partition being written is replaced, so
    both sides and many anchors share one table and a rerun is idempotent."""
    write_partitioned(scores, path, {"line": line, "anchor": anchor, "side": side}, mode)
