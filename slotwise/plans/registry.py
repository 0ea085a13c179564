"""Named queries: each runs over the given tables and may carry an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from slotwise.plans.bindings import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add
