"""Mergeable daily states: histories that are cumulated for many anchors in one pass (A1-A4 for a list of anchors).

A row of history changes what an anchor sees from one day on, and some changes end on a later day: an order counts as
recent for thirty days, or belongs to the outcome of the ninety anchors before it. So each row becomes events (key, at,
changes), where ``at`` is the first anchor that sees the change; what ends is taken back by an event of its own. Events
of one key and day are added up, which is the state: sums, least and greatest values. States of disjoint sets of orders
merge by the same aggregate, and the value for an anchor is the sum of the states up to it.

Distinct orders are not sums over days, as the lines of an order may have several days: ``order_events`` makes the
events by order, so that an order counts once however many of its lines are in view.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUM, LEAST, GREATEST = "sum", "least", "greatest"
_AGG = {SUM: F.sum, LEAST: F.min, GREATEST: F.max}


def order_events(rows: DataFrame, key: str, order_id: str, at: str, until: str | None = None, n: str | None = "n",
                 n_within: str | None = None) -> DataFrame:
    """Events that count orders: ``n`` from the first ``at`` of an order on, ``n_within`` while an anchor is within
    ``at`` and ``until`` (both included) of any of its rows.

    Rows of one order whose spans touch or overlap make one span. An order has at most one span for each of its days;
    rows without an order id are not counted."""
    spans = F.sort_array(F.collect_set(F.struct(F.col(at).alias("lo"), F.col(until or at).alias("hi"))))
    orders = rows.where(F.col(order_id).isNotNull()).groupBy(key, order_id).agg(spans.alias("spans"))
    s = F.col("spans")
    event = lambda day, first, within: F.struct(day.alias("at"), F.lit(first).cast("long").alias("n"), F.lit(within).cast("long").alias("w"))
    parts = []
    if n:
        parts.append(F.array(event(s[0]["lo"], 1, 0)))
    if n_within:
        apart = lambda a, b: F.coalesce(b["lo"] > F.date_add(a["hi"], 1), F.lit(True))
        opens = F.filter(s, lambda x, i: apart(F.get(s, i - 1), x))
        closes = F.filter(s, lambda x, i: apart(x, F.get(s, i + 1)))
        parts += [F.transform(opens, lambda x: event(x["lo"], 0, 1)), F.transform(closes, lambda x: event(F.date_add(x["hi"], 1), 0, -1))]
    out = orders.select(key, F.explode(F.concat(*parts)).alias("e"))
    return out.select(key, F.col("e.at").alias("at"), *([F.col("e.n").alias(n)] if n else []), *([F.col("e.w").alias(n_within)] if n_within else []))


def cumulated(events: Sequence[DataFrame], anchors: DataFrame, key: str, kinds: Mapping[str, str]) -> DataFrame:
    """For each (key, anchor) of ``anchors``, each column of ``kinds`` (sum, least or greatest) over the events up to it.

    The events of a key and day are reduced before they meet, so a hot key brings one row for each day of its
    history to the running pass, however many rows it has. Sums are 0 where no event is seen, others null."""
    with_all = lambda df: df.select(key, "at", *((F.col(c) if c in df.columns else F.lit(None)).alias(c) for c in kinds))
    types = {c: next(df.schema[c].dataType for df in events if c in df.columns) for c in kinds}
    typed = lambda df: with_all(df).select(key, "at", *(F.col(c).cast(types[c]).alias(c) for c in kinds))
    union = reduce(DataFrame.unionByName, map(typed, events))
    state = union.groupBy(key, "at").agg(*(_AGG[k](c).alias(c) for c, k in kinds.items()))
    asked = anchors.select(key, F.col("anchor").alias("at")).distinct().select(
        key, "at", *(F.lit(None).cast(state.schema[c].dataType).alias(c) for c in kinds), F.lit(1).alias("__asked"))
    both = state.withColumn("__asked", F.lit(0)).unionByName(asked)
    w = Window.partitionBy(key).orderBy("at", "__asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(c: str, kind: str) -> Column:
        x = _AGG[kind](c).over(w)
        return (F.coalesce(x, F.lit(0)) if kind == SUM else x).alias(c)

    return (both.select(key, "at", "__asked", *(running(c, k) for c, k in kinds.items()))
            .where("__asked = 1").drop("__asked").withColumnRenamed("at", "anchor"))
