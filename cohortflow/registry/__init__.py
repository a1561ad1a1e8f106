"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, over the test bindings.

Every query reads the driver's whole tables through ``cohortflow.sources.testbed`` (no id
subsets, no row caps) and runs the library operators on them. ``jobs`` holds the composed jobs
(SURVEY 2.1), ``operators`` the operator-level queries (SURVEY 2.2-2.10).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    from cohortflow.registry import jobs, operators  # noqa: F401  (registration side effects)

    return dict(REGISTRY)
