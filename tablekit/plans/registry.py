"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame`` plus
the equivalent SQL text for an independent engine (tables as plain views)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # Importing the modules fills the registry.
    from tablekit.plans import (  # noqa: F401
        aggregate_queries, io_queries, join_queries, projection_queries,
        scalar_queries, skew_queries, state_queries, upsert_queries,
    )
