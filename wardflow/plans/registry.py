"""Registry of named queries and their SQL oracles.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables.  The
oracle is an ANSI SQL string (DuckDB dialect) over the same tables with the
same output column names.  Queries without an oracle are checked by
rows-only comparison and by brute-force unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Decorator registering a query (and its oracle SQL, when it has one)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    # importing the modules fills the registry
    from wardflow.plans import (  # noqa: F401
        q_panel,
        q_sequence,
        q_relational,
        q_stats,
        q_impute,
        q_suites,
        q_models,
        q_cohorts,
        q_evaluation,
        q_chains,
    )
    return dict(QUERIES), dict(ORACLES)
