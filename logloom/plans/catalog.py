"""Named queries over the given tables, each with its DuckDB counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL of the same result."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def load_all() -> None:
    """Import the modules that register queries."""
    from logloom.plans import (  # noqa: F401
        queries_features,
        queries_ingest,
        queries_models,
        queries_reports,
        queries_sources,
        queries_streams,
    )
