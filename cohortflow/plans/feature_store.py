"""P1 / P2 from stored feature tables that join without a shuffle.

Each feature table, and the spine of order lines, is written once in buckets by customer, sorted within them. Joins of
tables with one key and one number of buckets read bucket by bucket: no Exchange, no Sort. The tables serve every further
assembly over the same anchor (other columns, another spine) without being shuffled again. A customer with a third of all
lines makes one bucket of the spine large; the features are one row for each customer, so no join multiplies it.

The number of buckets is a parameter of the store, since tables join so only if they agree on it: about one for each
200 MB of the largest table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cohortflow import rules as R
from cohortflow.operators.joins import assemble
from cohortflow.operators.keysets import KeySet
from cohortflow.params import ObservationWindow
from cohortflow.plans import reactivation as P
from cohortflow.sources.sinks import write_bucketed

KEY = "customer_id"


@dataclass
class FeatureStore:
    """Tables in buckets by customer under one folder of the shared file system."""

    spark: SparkSession
    folder: str
    buckets: int
    name: str = field(default_factory=lambda: f"features_{uuid.uuid4().hex}")

    def table(self, part: str) -> str:
        return f"{self.name}_{part}"

    def put(self, part: str, df: DataFrame) -> DataFrame:
        return write_bucketed(df, self.table(part), KEY, self.buckets, f"{self.folder}/{self.table(part)}")

    def get(self, part: str) -> DataFrame:
        return self.spark.table(self.table(part))

    def drop(self) -> None:
        """Forget the tables; their files stay until the folder is cleaned."""
        for t in self.spark.catalog.listTables(pattern=f"{self.name}_*"):
            self.spark.sql(f"DROP TABLE `{t.name}`")


def store_reactivation(store: FeatureStore, src: P.ReactivationSources, W: ObservationWindow, outcome_cities=R.OUTCOME_CITIES, rides_since=None) -> None:
    """The spine and the feature tables of P1 / P2 for one anchor."""
    today = store.put("spine", P.anchor_day_orders(src, W))
    keys = KeySet(today)
    tables = {
        "life": P.lifetime_features(P.lapsed_service_history(keys.likely(src.orders), src.merchants, W), W),
        **P.value_tables(src, W, rides_since, keys),
        "outcome": P.outcome_after(src, W, outcome_cities, keys),
        "membership": P.latest_membership(src.subscriptions, W, keys),
        "profile": P.profile_features(src.profile, keys),
    }
    for part, df in tables.items():
        store.put(part, df)


def reactivation_from(store: FeatureStore, W: ObservationWindow, with_city: bool = True, with_blended: bool = False) -> DataFrame:
    """P1 / P2 assembled from the store: all joins are bucket by bucket."""
    values = assemble(store.get("life"), [store.get(t) for t in ("rides", "food", "shop", "resident")], KEY)
    feats = values.select(*store.get("life").columns, *P.value_columns(W.anchor), "is_resident")
    out = assemble(store.get("spine"), [store.get("outcome"), feats, store.get("membership"), store.get("profile")], KEY)
    return out.select(*P.feature_columns(with_city, with_blended))
