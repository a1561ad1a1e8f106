"""Per-key "window" operators (W1-W7, K1), written to survive a key that holds a third of all rows.

* Top-1 per key (latest row, preferred category, best match) is an aggregate
  ``max_by(struct(values), struct(order..., tie...))``: partial aggregation runs map-side, so a hot
  key never lands whole in one task (a sort aggregate, as the buffers are structs).
* Ranks within a key (row_number / dense_rank) use a range-partitioned global sort: a hot key is
  spread over several range partitions (a per-row salt as the last sort key splits even exact
  copies); each row's rank is its position inside its partition plus the row count of the same
  key in earlier partitions (a table of at most keys x partitions rows). The placed rows are
  written once through a reliable checkpoint so both branches see one range partitioning.
* Shares of a key total are an aggregate joined back on the key (AQE splits a skewed key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence, values: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` struct per key (order includes the tie columns).

    NULL order fields sort lowest, i.e. "DESC NULLS LAST" semantics."""
    keys = list(keys)
    vals = [c for c in (values or df.columns) if c not in keys]
    best = F.max_by(F.struct(*[F.col(v) for v in vals]), F.struct(*[_c(o) for o in order]))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col(f"__best.{v}").alias(v) for v in vals])


def top1_by_count(counts: DataFrame, key: str, cat: str, n_col: str = "cnt", min_count: int | None = None,
                  out: str | None = None) -> DataFrame:
    """W4/W7 core: category with the highest count per key; ties -> smallest category value.
    The minimum applies to the winner only (no row when the winner is under it)."""
    best = F.min_by(F.struct(F.col(cat).alias("v"), F.col(n_col).alias("n")),
                    F.struct((-F.col(n_col)).alias("negn"), F.col(cat).alias("t")))
    res = counts.groupBy(key).agg(best.alias("__b")).select(
        key, F.col("__b.v").alias(out or cat), F.col("__b.n").alias(n_col))
    if min_count is not None:
        res = res.where(F.col(n_col) >= min_count)
    return res


def preferred(df: DataFrame, key: str, cat: str, min_count: int, out: str | None = None) -> DataFrame:
    """Most frequent category per key, only when its count reaches ``min_count``."""
    counts = df.groupBy(key, cat).agg(F.count(F.lit(1)).alias("cnt"))
    return top1_by_count(counts, key, cat, "cnt", min_count, out).select(key, out or cat)


def share_of_total(counts: DataFrame, key: str, n_col: str = "cnt", pct_col: str = "percentage") -> DataFrame:
    """``100 * n / sum(n) over key`` as aggregate + join (no whole-key window)."""
    totals = counts.groupBy(key).agg(F.sum(n_col).alias("__total"))
    return (counts.join(totals, key, "inner")
                  .withColumn(pct_col, F.col(n_col).cast("double") * F.lit(100.0) / F.col("__total").cast("double"))
                  .drop("__total"))


def rank_within(df: DataFrame, key: str, order: Sequence, out: str = "rank", dense: bool = False,
                num_partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """``row_number`` (or ``dense_rank``) within ``key`` by ``order``, skew-safe.

    ``order`` items are column names or sort expressions (e.g. ``F.col('ts').asc_nulls_last()``);
    for ``row_number`` include a unique tie column. For ``dense_rank`` the distinct
    ``(key, order values)`` are numbered and joined back null-safely.

    ``materialize=False`` skips the checkpoint of the range-partitioned rows; only safe when the
    input's partitioning and row order are deterministic (e.g. a plain file scan), because the
    two branches then recompute the salt and the range bounds independently."""
    order_cols = [_c(o) for o in order]
    if dense:
        names = [o if isinstance(o, str) else None for o in order]
        if any(n is None for n in names):
            raise ValueError("dense rank needs plain column names in order (ascending, NULLS LAST)")
        if materialize:
            from cohortflow.session import cut_lineage
            df = cut_lineage(df)  # the distinct values and the join back read it
        distinct = df.select(key, *names).distinct()
        ranked = rank_within(distinct, key, [F.col(n).asc_nulls_last() for n in names], out, False, num_partitions,
                             materialize)
        cond = df[key].eqNullSafe(ranked[key])
        for n in names:
            cond = cond & df[n].eqNullSafe(ranked[n])
        return df.join(ranked, cond, "inner").select(df["*"], ranked[out])

    # A per-row salt as the last sort key lets the range partitioner split exact copies (rows equal
    # on key and order), so a group of copies is spread over partitions too; ranks among copies
    # are arbitrary, as with any row_number tie. Without an explicit count, AQE may coalesce
    # adjacent ranges of a small input; merged ranges keep the key order the ranks rely on.
    sort_exprs = [F.col(key).asc_nulls_last()] + order_cols + [F.col("__salt").asc()]
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    ranged = (salted.repartitionByRange(num_partitions, *sort_exprs) if num_partitions
              else salted.repartitionByRange(*sort_exprs))
    placed = (ranged
                .sortWithinPartitions(*sort_exprs)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id()))
    if materialize:
        # Both branches below (per-partition stats and the join back) must see the same range
        # partitioning. Two independent range exchanges would each sample their own bounds, so
        # the placed rows are written once to the reliable checkpoint directory (also survives
        # executor loss without recomputing a nondeterministic sample).
        from cohortflow.session import cut_lineage
        placed = cut_lineage(placed)
    stats = placed.groupBy(key, "__pid").agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(key).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0))).drop("__cnt")
    joined = placed.join(stats, (placed[key].eqNullSafe(stats[key])) & (placed["__pid"] == stats["__pid"]), "inner")
    return joined.select(
        placed["*"], (placed["__mid"] - stats["__first"] + F.lit(1) + stats["__off"]).alias(out)
    ).drop("__pid", "__mid", "__salt")


def rank_within_window(df: DataFrame, key: str, order: Sequence, out: str = "rank", dense: bool = False) -> DataFrame:
    """Plain window form (one shuffle, whole key in one task); for keys known to be bounded."""
    w = Window.partitionBy(key).orderBy(*[_c(o) for o in order])
    return df.withColumn(out, (F.dense_rank() if dense else F.row_number()).over(w))


def top_k(df: DataFrame, key: str, order: Sequence, k: int, out: str = "rank") -> DataFrame:
    """K1: the first ``k`` rows per key by ``order`` (include a tie column), with their rank.

    The filter on ``row_number`` becomes a group limit before the shuffle, so a task sends at most
    ``k`` rows of a key, however hot. For ``k == 1`` prefer ``latest_by`` / ``top1_by_count``."""
    w = Window.partitionBy(key).orderBy(*[_c(o) for o in order])
    return df.withColumn(out, F.row_number().over(w).cast("long")).where(F.col(out) <= k)
