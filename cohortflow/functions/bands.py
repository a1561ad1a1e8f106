"""CASE-style classification as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(col, rules: Sequence[tuple], else_: str | None = None, null_label: str | None = None) -> Column:
    """Ordered inclusive bands ``[(lo, hi, label), ...]``; ``None`` is an open end.

    First matching band wins; NULL input gives ``null_label`` (when set) else falls to ``else_``
    only if ``else_`` is meant to catch NULL (CASE semantics: NULL matches no band, so it gets
    ``else_``)."""
    c = _col(col)
    expr = None
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for lo, hi, label in rules:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= F.lit(lo))
        if hi is not None:
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(else_)
    return expr.otherwise(F.lit(else_)) if else_ is not None else expr


def compare_band(col, rules: Sequence[tuple], else_: str | None = None) -> Column:
    """Ordered rules with operators: ``(">", v, label)``, ``("<", v, label)``,
    ``("between", (lo, hi), label)`` (inclusive)."""
    c = _col(col)
    expr = None
    for op, v, label in rules:
        if op == ">":
            cond = c > F.lit(v)
        elif op == "<":
            cond = c < F.lit(v)
        elif op == ">=":
            cond = c >= F.lit(v)
        elif op == "<=":
            cond = c <= F.lit(v)
        elif op == "between":
            cond = c.between(F.lit(v[0]), F.lit(v[1]))
        else:
            raise ValueError(op)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(else_)) if else_ is not None else expr


def like_any(col, patterns: Iterable[str]) -> Column:
    c = _col(col)
    pats = list(patterns)
    if not pats:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.like(p) for p in pats])


def first_match(rules: Sequence[tuple[Column, str]], else_=None) -> Column:
    """Ordered ``[(condition, label)]``; ``else_`` may be a column or literal."""
    expr = None
    for cond, label in rules:
        lab = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    if else_ is None:
        return expr
    return expr.otherwise(else_ if isinstance(else_, Column) else F.lit(else_))


def hour_bucket(ts, tz_offset_hours: int, rules: Sequence[tuple], else_: str) -> Column:
    """Local hour bucket: ``hour(ts + offset)`` in ``[from, to)`` ranges; NULL ts -> ``else_``."""
    h = F.hour(F.timestamp_add("HOUR", F.lit(tz_offset_hours), _col(ts)))
    return first_match([((h >= lo) & (h < hi), label) for lo, hi, label in rules], else_)


def clean_category(col, allowed: Sequence[str]) -> Column:
    """trim + lower, then keep only listed values (else NULL)."""
    v = F.trim(F.lower(_col(col)))
    return F.when(v.isin(list(allowed)), v)


def threshold_label(col, threshold, yes: str, no: str, default=0) -> Column:
    return F.when(F.coalesce(_col(col), F.lit(default)) >= F.lit(threshold), F.lit(yes)).otherwise(F.lit(no))


def adoption_label(base_first, a_first, b_first, anchor, target_end,
                   labels=("base-only", "base+a", "base+b", "base+a+b")) -> Column:
    """Base-only when neither A nor B and the base date precedes the anchor; +A / +B / +A+B
    when the adoption dates fall in ``[anchor, target_end)``; else NULL."""
    a, b, base = _col(a_first), _col(b_first), _col(base_first)
    lo, hi = F.lit(anchor), F.lit(target_end)
    a_in = (a >= lo) & (a < hi)
    b_in = (b >= lo) & (b < hi)
    return first_match([
        (a.isNull() & b.isNull() & (base < lo), labels[0]),
        (a.isNotNull() & b.isNull() & a_in, labels[1]),
        (a.isNull() & b.isNotNull() & b_in, labels[2]),
        (a.isNotNull() & b.isNotNull() & a_in & b_in, labels[3]),
    ])


def between_flag(col, lo, hi) -> Column:
    """C14: ``lo <= col <= hi`` (both inclusive), missing -> False."""
    return F.coalesce(_col(col).between(F.lit(lo), F.lit(hi)), F.lit(False))


def membership_type(subscription_type, plan_id, invoice_id, *,
                    paid_types, paid_plans, free_renewal, trial_commitment, trial) -> Column:
    """C11: ordered first match; unmatched -> NULL."""
    st = F.lower(_col(subscription_type))
    return first_match([
        (st.isin(list(paid_types)), "paid"),
        (_col(plan_id).isin(list(paid_plans)), "paid"),
        (F.lower(_col(invoice_id)).like(free_renewal), "paid"),
        (st.like(trial_commitment), "trial_without_commitment"),
        (st.like(trial), "trial"),
    ])


def place_class(name, building_type, classes) -> Column:
    """Ordered place classes; unmatched names keep themselves."""
    rules = []
    for label, name_pats, building_pats in classes:
        cond = like_any(name, name_pats)
        if building_pats:
            cond = cond | like_any(building_type, building_pats)
        rules.append((cond, label))
    return first_match(rules, _col(name))
