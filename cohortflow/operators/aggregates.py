"""Per-key aggregates (A1-A16). All are ``groupBy(...).agg(...)`` with built-in functions, so
Spark runs a partial (map-side) aggregate before the shuffle and a hot key is pre-reduced."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.measures import safe_ratio


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lifetime(df: DataFrame, *, key: str, day: str, order_id: str, anchor, last_value: str | None = None,
             last_order: Sequence | None = None, names: Mapping[str, str] | None = None) -> DataFrame:
    """A1 (+ last merchant): first/last day, distinct orders, recency to the anchor in one pass.

    ``last_value`` is taken from the row with the greatest ``last_order`` struct (max_by),
    which replaces a separate row_number window over the same scan."""
    n = {"first": "first_order_date", "last": "last_order_date", "orders": "delivered_orders",
         "recency": "recency", "last_value": "last_value", **(names or {})}
    aggs = [F.min(day).alias(n["first"]), F.max(day).alias(n["last"]),
            F.count_distinct(order_id).alias(n["orders"])]
    if last_value:
        aggs.append(F.max_by(F.col(last_value), F.struct(*[_c(o) for o in (last_order or [day])])).alias(n["last_value"]))
    out = df.groupBy(key).agg(*aggs)
    return out.withColumn(n["recency"], F.datediff(F.lit(anchor), F.col(n["last"])).cast("long"))


def minor_units(df: DataFrame, amount: Column, scale: int) -> tuple[Column, Column] | None:
    """``amount`` in two parts that add up to it: a BIGINT count of 10^-scale units, and the amounts too
    large for it as DECIMAL (else NULL). None when its type has neither (DECIMAL with more than ``scale``
    places, or no exact type). Summing longs keeps the aggregation fast; below 2^50 units
    rint(double(x) * 10^s) is the exact count (the double error stays under 0.25 of a unit), and sums of
    thousands of such counts fit a BIGINT."""
    dt = df.select(amount.alias("__a")).schema["__a"].dataType
    if isinstance(dt, T.DecimalType) and dt.scale <= scale:
        small = F.abs(amount) < F.lit(2.0 ** 50 / 10 ** scale)
        return F.when(small, F.rint(amount.cast("double") * F.lit(float(10 ** scale))).cast("long")), F.when(~small, amount)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return amount.cast("long") * F.lit(10 ** scale), F.lit(None).cast("decimal(38,4)")
    return None


def from_minor_units(total: Column, scale: int) -> Column:
    """Exact DECIMAL back from a BIGINT count of 10^-scale units."""
    return (total.cast("decimal(28,0)") / F.lit(10 ** scale).cast("decimal(9,0)")).cast("decimal(38,4)")


def value_stats(df: DataFrame, *, key: str, order_id: str, gross: Column, margin: Column,
                names: Mapping[str, str], recent: Column | None = None, last: str | None = None,
                money_scale: int | None = 4) -> DataFrame:
    """A2a/A2b/A2c (+A3): distinct orders, recent distinct orders, gross, margin, margin per order,
    last activity. Money sums stay DECIMAL (exact, order-independent).

    Two-level aggregate instead of two ``count(DISTINCT)``: first per (key, order) - which also
    spreads a hot key over its orders - then per key, where the distinct counts are plain counts
    of order groups (with / without a recent row). No Expand, so no 3x row blow-up before the
    shuffle. Money is summed exactly: as BIGINT minor units when the amounts' types allow it
    (``money_scale`` places), else as DECIMAL; the result is DECIMAL either way."""
    g_units = minor_units(df, gross, money_scale) if money_scale is not None else None
    m_units = minor_units(df, margin, money_scale) if money_scale is not None else None
    in_units = g_units is not None and m_units is not None
    sums = {"__g": gross, "__m": margin}
    if in_units:
        sums = dict(zip(("__g", "__gl", "__m", "__ml"), (*g_units, *m_units), strict=True))
    per_order = [F.sum(c).alias(n) for n, c in sums.items()]
    if recent is not None:
        per_order.append(F.max(recent.cast("int")).alias("__r"))
    if last is not None:
        per_order.append(F.max(last).alias("__l"))
    o = df.groupBy(key, order_id).agg(*per_order)  # a NULL order id forms its own group: summed, not counted
    aggs = [F.count(order_id).alias(names["n"]), *(F.sum(n).alias(n) for n in sums)]
    if recent is not None:
        aggs.append(F.count(F.when(F.col("__r") == 1, F.col(order_id))).alias(names["n_recent"]))
    if last is not None:
        aggs.append(F.max("__l").alias(names["last"]))
    out = o.groupBy(key).agg(*aggs)

    def total(n: str) -> Column:
        if not in_units:
            return F.col(n)
        zero = F.lit(0).cast("decimal(38,4)")
        both = from_minor_units(F.coalesce(F.col(n), F.lit(0)), money_scale) + F.coalesce(F.col(f"{n}l").cast("decimal(38,4)"), zero)
        return F.when(F.col(n).isNotNull() | F.col(f"{n}l").isNotNull(), both)

    extra = [names[k] for k in ("n_recent", "last") if k in names]
    out = out.select(key, names["n"], total("__g").alias(names["gmv"]), total("__m").alias(names["gp"]),
                     *(c for c in extra if c in out.columns))
    return out.withColumn(names["gppo"], safe_ratio(F.col(names["gp"]), F.col(names["n"])))


def recent_distinct(df: DataFrame, *, key: str, order_id: str, recent: Column, names: Mapping[str, str]) -> DataFrame:
    """A3: distinct orders and distinct orders with a recent row per key, in two levels (no Expand)."""
    o = df.groupBy(key, order_id).agg(F.max(recent.cast("int")).alias("__r"))
    return o.groupBy(key).agg(F.count(order_id).alias(names["n"]),
                              F.count(F.when(F.col("__r") == 1, F.col(order_id))).alias(names["n_recent"]))


def outcome(df: DataFrame, *, key: str, order_id: str, sums: Mapping[str, str], n_name: str) -> DataFrame:
    """A4: distinct orders and sums per key (the caller applies the outcome window)."""
    return df.groupBy(key).agg(F.count_distinct(order_id).alias(n_name),
                               *[F.sum(src).alias(dst) for dst, src in sums.items()])


def first_dates(df: DataFrame, *, key: str, service_col: str, date_col: str,
                services: Mapping[str, Sequence[str]]) -> DataFrame:
    """A5: first date per service set in one pass: ``min(case when service in set then date)``.

    A key appears when it has a row for at least one of the service sets."""
    all_services = sorted({s for ss in services.values() for s in ss})
    d = F.to_date(F.col(date_col))
    return (df.where(F.col(service_col).isin(all_services))
              .groupBy(key)
              .agg(*[F.min(F.when(F.col(service_col).isin(list(ss)), d)).alias(name) for name, ss in services.items()]))


def active_days(df: DataFrame, *, key: str, day: str, out: str = "active_days") -> DataFrame:
    """Distinct active days per key."""
    return df.groupBy(key).agg(F.count_distinct(day).alias(out))


def point_counts(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def area_stats(df: DataFrame, *, area: str, flag: str, n_name: str, k_name: str) -> DataFrame:
    """Customers and successes per area; rows without an area are dropped (as a pandas
    groupby does)."""
    return (df.where(F.col(area).isNotNull())
              .groupBy(area)
              .agg(F.count(F.lit(1)).alias(n_name), F.sum(F.col(flag).cast("long")).alias(k_name)))


def argmax_by(df: DataFrame, *, key: str, cat: str, value: str, out_value: str) -> DataFrame:
    """Sum ``value`` per (key, cat), keep the cat with the largest sum per key; ties -> the
    smallest cat (first in sorted order)."""
    sums = df.groupBy(key, cat).agg(F.sum(value).alias(out_value))
    best = F.min_by(F.struct(F.col(cat).alias("c"), F.col(out_value).alias("v")),
                    F.struct((-F.col(out_value)).alias("nv"), F.col(cat).alias("t")))
    return sums.groupBy(key).agg(best.alias("__b")).select(key, F.col("__b.c").alias(cat), F.col("__b.v").alias(out_value))


def dominant_bucket(pcts: Mapping[str, Column], labels: Mapping[str, str], else_label: str) -> Column:
    """Ordered strict comparisons over per-bucket shares (already max-pivoted per key).

    Bucket i wins when its share is strictly greater than every later bucket's share; the last
    bucket is the fallback, so an exact tie goes to the later bucket."""
    order = list(pcts)
    expr = None
    for i, b in enumerate(order[:-1]):
        cond = None
        for later in order[i + 1:]:
            c = pcts[b] > pcts[later]
            cond = c if cond is None else cond & c
        expr = F.when(cond, F.lit(labels[b])) if expr is None else expr.when(cond, F.lit(labels[b]))
    return expr.otherwise(F.lit(else_label))


def usage_summary(df: DataFrame, *, key: str, averages: Mapping[str, str], total: tuple[str, str] | None = None,
                  count: str | None = None, age: str | None = None,
                  age_names: tuple[str, str] = ("oldest_age", "newest_age"),
                  decimals: int = 2) -> DataFrame:
    """Per key, averages rounded to ``decimals`` (``{out: column}``), an optional total
    ``(out, column)``, row count, and oldest / newest age."""
    aggs = [F.round(F.avg(src), decimals).alias(out) for out, src in averages.items()]
    if total:
        aggs.append(F.sum(total[1]).alias(total[0]))
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    if age:
        aggs += [F.max(age).alias(age_names[0]), F.min(age).alias(age_names[1])]
    return df.groupBy(key).agg(*aggs)


def decayed_count(df: DataFrame, *, key: str, age: str, taus: Sequence[float], prefix: str = "w_",
                  decimals: int | None = None) -> DataFrame:
    """``sum(exp(-age / tau))`` per key for each tau (age cast to double)."""
    from cohortflow.functions.measures import decay_weight

    def agg(tau):
        s = F.sum(decay_weight(age, tau))
        return (F.round(s, decimals) if decimals is not None else s).alias(f"{prefix}{tau}")
    return df.groupBy(key).agg(*[agg(t) for t in taus])


def share_pct(df: DataFrame, *, key: str, cond: Column, out: str) -> DataFrame:
    """Percentage of a key's rows meeting ``cond`` (``count_if * 1.0 / count * 100``)."""
    a = df.groupBy(key).agg(F.sum(cond.cast("long")).alias("__k"), F.count(F.lit(1)).alias("__n"))
    return a.select(key, ((F.col("__k").cast("double") / F.col("__n").cast("double")) * F.lit(100.0)).alias(out))


def category_share_flag(df: DataFrame, *, key: str, cat: str, values: Sequence[str], threshold: float,
                        labels: tuple[str, str], out: str) -> DataFrame:
    """Label when any listed category's share of the key's rows reaches ``threshold`` percent
    (max over the listed categories, not their sum)."""
    from cohortflow.operators.windows import share_of_total

    shares = share_of_total(point_counts(df, [key, cat], "__c"), key, "__c", "__pct")
    best = F.max(F.when(F.col(cat).isin(list(values)), F.col("__pct")).otherwise(F.lit(0.0)))
    return shares.groupBy(key).agg(
        F.when(best >= threshold, F.lit(labels[0])).otherwise(F.lit(labels[1])).alias(out))


def dominant_bucket_of(df: DataFrame, *, key: str, bucket: str, order: Sequence[str], min_count: int,
                       labels: Mapping[str, str], else_label: str, out: str) -> DataFrame:
    """A16 end to end: share of each bucket in the key's rows, buckets under ``min_count`` rows
    score 0, then the ordered strict comparison (ties to the later bucket). A key without any
    bucket reaching the minimum has no row."""
    from cohortflow.operators.windows import share_of_total

    shares = share_of_total(point_counts(df, [key, bucket], "__c"), key, "__c", "__pct")
    kept = shares.where(F.col("__c") >= min_count)
    piv = kept.groupBy(key).agg(*[F.max(F.when(F.col(bucket) == b, F.col("__pct")).otherwise(F.lit(0.0))).alias(f"__b{i}")
                                  for i, b in enumerate(order)])
    pcts = {b: F.col(f"__b{i}") for i, b in enumerate(order)}
    return piv.select(key, dominant_bucket(pcts, labels, else_label).alias(out))
