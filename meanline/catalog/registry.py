"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL when one can express it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def values(rows: Iterable[Iterable[object]]) -> str:
    """Rows as the body of a SQL VALUES list; numbers with a point are doubles."""

    def text(value: object) -> str:
        if isinstance(value, float):
            return f"cast({value!r} as double)"
        return f"'{value}'" if isinstance(value, str) else str(value)

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
