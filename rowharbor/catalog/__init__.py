"""Registered queries: each operator over whole tables, next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the equivalent SQL."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_catalog() -> None:
    """Import every query module once."""
    from rowharbor.catalog import (  # noqa: F401
        conversions,
        hard_cases,
        keyed_loads,
        references,
        reports,
        sources,
        whole_loads,
    )
