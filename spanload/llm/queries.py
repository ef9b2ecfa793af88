"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

from spanload.plans.registry import QueryFn

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

MODULES = ("q_web", "q_text", "q_dedup", "q_corpus")


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"spanload.llm.{m}")
