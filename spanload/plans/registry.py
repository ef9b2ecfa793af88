"""Registry of the checked queries: a Spark callable and its SQL oracle.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame; the SQL
string computes the same answer independently in plain SQL over the same
tables.  Column names match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from spanload.plans import (clean_checks, load_checks,  # noqa: F401
                                split_checks)
