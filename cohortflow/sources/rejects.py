"""A count of rejected ids beside the result.

Ids come as text and are cast; one that cannot be cast becomes NULL and leaves every join without a trace. ``rejected_ids``
counts them for each source, in a pass of its own over the id column alone: an observation inside the job would count in
the same pass, but filters do not go below it, so the job would read every day of the source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.keys import norm_key

#: By job the sources with ids as text: the id column and the length of its prefix.
ID_COLUMNS = {
    "reactivation": {"trips": ("customer_id", 0), "subscription_events": ("userid", 5), "profile": ("customer_id", 0)},
    "cross-sell": {"trips": ("customer_id", 0), "first_orders": ("userid", 0), "profile": ("customer_id", 0), "active_subs": ("customer_id", 0),
                   "demographics": ("customer_id", 0), "bookings": ("customer_id", 0), "place_locations": ("user_id", 0)},
    "post-cross": {"trips": ("customer_id", 0), "first_orders": ("userid", 0)},
}


def rejected_ids(sources: Mapping[str, tuple[DataFrame, str, int]]) -> DataFrame:
    """source, n_rows, n_missing and n_rejected of each (frame, id column, prefix length)."""
    out = None
    for name, (df, col, prefix_len) in sources.items():
        bad = F.col(col).isNotNull() & norm_key(col, prefix_len).isNull()
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col(col).isNull().cast("long")), F.lit(0)).alias("n_missing"),
                     F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("n_rejected")).select(F.lit(name).alias("source"), "n_rows", "n_missing", "n_rejected")
        out = row if out is None else out.unionByName(row)
    return out
