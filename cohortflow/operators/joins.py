"""Joins (J1-J8).

No join counts rows or hints a broadcast while a plan is built: the planner and AQE choose from
measured sizes (a side is broadcast when its shuffle turns out small), and AQE splits skewed
partitions of a sort-merge join. Dimensions are reduced to one row per key (``one_per_key``) so duplicate keys
cannot fan out facts, and the proximity join is an equi-join on grid cells (``near_join``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.geo import haversine_m
from cohortflow.rules import EARTH_RADIUS_KM


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join a fact to a dimension (allow-list + enrichment)."""
    return fact.join(dim, on, how)


def restrict_to(df: DataFrame, base: DataFrame, key: str, base_key: str | None = None) -> DataFrame:
    """``key IN (SELECT base_key FROM base)`` as a left-semi join (no fan-out)."""
    bk = base_key or key
    b = base.select(F.col(bk).alias("__k"))
    return df.join(b, df[key] == b["__k"], "left_semi")


def assemble(spine: DataFrame, features: Sequence[DataFrame], on: str) -> DataFrame:
    """Left-join one-row-per-key feature tables onto a spine.

    All inputs are keyed by ``on``; sort-merge joins on the same key reuse the hash
    partitioning, so the spine is shuffled once."""
    out = spine
    for f in features:
        out = out.join(f, on, "left")
    return out


def flag_exists(df: DataFrame, other: DataFrame, left_key: str, right_key: str, flag: str) -> DataFrame:
    """Boolean flag "key occurs in other" without fan-out (distinct keys first, T11)."""
    keys = other.select(F.col(right_key).alias("__fk")).where(F.col("__fk").isNotNull()).distinct()
    return (df.join(keys, df[left_key] == keys["__fk"], "left")
              .withColumn(flag, F.col("__fk").isNotNull())
              .drop("__fk"))


def join_bridge(fact: DataFrame, bridge: DataFrame, dim: DataFrame, *, fact_key: str, bridge_fact_key: str,
                bridge_dim_key: str, dim_key: str, bridge_filter: Column | None = None,
                dim_filter: Column | None = None) -> DataFrame:
    """Fact -> bridge -> dimension, inner (one output row per matching bridge row)."""
    b = bridge.where(bridge_filter) if bridge_filter is not None else bridge
    d = dim.where(dim_filter) if dim_filter is not None else dim
    bd = b.join(d, b[bridge_dim_key] == d[dim_key], "inner")
    return fact.join(bd, fact[fact_key] == bd[bridge_fact_key], "inner")


def near_join(events: DataFrame, places: DataFrame, *, key: str, ev_lat: str, ev_lon: str, pl_lat: str,
              pl_lon: str, metres: float, radius_km: float = EARTH_RADIUS_KM, extra: Column | None = None,
              how: str = "inner", place_key: str | None = None, heavy_rows: int | None = None, salts: int = 64) -> DataFrame:
    """Same key, place within ``metres`` of the event (haversine), plus an ``extra`` condition.

    Made an equi-join on ``(key, lat band, lon cell)``: each place is written into the 3x3 grid
    cells around it, each event probes its own cell, so an event only meets places of its key
    that are near it, never every place of the key. A band is ``metres`` (+5 %) tall; its
    longitude cells are at least ``metres`` wide at the band's most poleward edge and wrap
    around the antimeridian (cell index modulo the cells per band); bands touching a pole have
    one cell. So no match within ``metres`` is lost anywhere; the exact distance is the residual
    condition.

    With ``heavy_rows`` the events of each (key, cell) are counted first. Those of cells with more are dealt out over
    ``salts`` tasks by a hash of the row, and the places of these cells alone are replicated to all of them, so a key
    and cell with a third of all events is no single task's work, whether or not AQE can split it. The heavy cells
    are marked in a table of bounded size (``KeySet``), which both sides read: they agree on it by construction.
    """
    cell = math.degrees(metres / (1000.0 * radius_km)) * 1.05

    def n_cells(band: Column) -> Column:
        edge = F.greatest(F.abs(band * F.lit(cell)), F.abs((band + 1) * F.lit(cell))) + F.lit(2 * cell)
        cos_edge = F.cos(F.radians(F.least(F.lit(90.0), edge)))
        per_band = F.floor(F.lit(360.0) * cos_edge / F.lit(cell))
        return F.when(edge >= 90.0, F.lit(1)).otherwise(F.greatest(F.lit(1), per_band)).cast("long")

    def lon_cell(lon: Column, band: Column, shift: int = 0) -> Column:
        n = n_cells(band)
        k = F.floor((lon + F.lit(180.0)) / (F.lit(360.0) / n)).cast("long") + F.lit(shift)
        return F.pmod(k, n)

    pk = place_key or key
    # Per place: its band, then for each of the three bands around it the number of cells and the
    # place's cell index there (computed once, as columns), then the 3x3 neighbour keys.
    staged = places.withColumn("__b", F.floor(F.col(pl_lat) / F.lit(cell)).cast("long"))
    for d in (-1, 0, 1):
        staged = staged.withColumn(f"__n{d + 1}", n_cells(F.col("__b") + d))
    for d in (-1, 0, 1):
        n = F.col(f"__n{d + 1}")
        staged = staged.withColumn(f"__k{d + 1}", F.floor((F.col(pl_lon) + F.lit(180.0)) / (F.lit(360.0) / n)).cast("long"))
    neigh = F.explode(F.array_distinct(F.array(*[
        F.struct((F.col("__b") + d).alias("__band"),
                 F.pmod(F.col(f"__k{d + 1}") + F.lit(e), F.col(f"__n{d + 1}")).alias("__cell"))
        for d in (-1, 0, 1) for e in (-1, 0, 1)
    ])))
    p = staged.select(*[F.col(c) for c in places.columns], neigh.alias("__nb")).select(
        [F.col(c) for c in places.columns] + [F.col("__nb.__band").alias("__pband"), F.col("__nb.__cell").alias("__pcell")])
    e_band = F.floor(F.col(ev_lat) / F.lit(cell)).cast("long")
    e = events.withColumn("__eband", e_band).withColumn("__ecell", lon_cell(F.col(ev_lon), F.col("__eband")))
    salted = F.lit(True)
    if heavy_rows is not None:
        from cohortflow.operators.keysets import KeySet

        place = lambda k, band, c: F.xxhash64(F.col(k).cast("string"), F.col(band), F.col(c))
        e, p = e.withColumn("__cell_key", place(key, "__eband", "__ecell")), p.withColumn("__cell_key", place(pk, "__pband", "__pcell"))
        heavy = KeySet(e.groupBy("__cell_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy_rows), "__cell_key")
        row = F.pmod(F.xxhash64(*(F.col(c) for c in events.columns), F.monotonically_increasing_id()), F.lit(salts)).cast("int")
        e = heavy.flagged(e, "__heavy").withColumn("__esalt", F.when(F.col("__heavy"), row).otherwise(0)).drop("__heavy", "__cell_key")
        every = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        p = heavy.flagged(p, "__heavy").withColumn("__psalt", F.explode(every)).drop("__heavy", "__cell_key")
        salted = e["__esalt"] == p["__psalt"]
    cond = (salted & (e[key] == p[pk]) & (e["__eband"] == p["__pband"]) & (e["__ecell"] == p["__pcell"])
            & (haversine_m(e[ev_lat], e[ev_lon], p[pl_lat], p[pl_lon], radius_km) < F.lit(metres)))
    if extra is not None:
        cond = cond & extra
    out = e.join(p, cond, how)
    return out.drop("__eband", "__ecell", "__pband", "__pcell", "__esalt", "__psalt")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """A dimension reduced to one row per key before it is joined, so duplicate keys cannot
    fan out the fact rows. The kept row is the greatest by all other columns (deterministic); an
    aggregate, so a key with many duplicates is pre-reduced map-side."""
    from cohortflow.operators.windows import latest_by

    others = [c for c in df.columns if c != key]
    return latest_by(df, [key], others, others) if others else df.select(key).distinct()
