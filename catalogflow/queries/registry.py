"""Named queries: a Spark callable and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a function ``(spark, sf_dir) -> DataFrame``."""

    def add(fn: QueryFn) -> QueryFn:
        key = name or fn.__name__
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = Query(key, fn, sql)
        return fn

    return add


def all_queries() -> dict[str, Query]:
    from catalogflow.queries import load

    load()
    return dict(_QUERIES)
