"""Named queries: a Spark DataFrame job plus its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.jobs.oracle import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, ctes: str = "",
             recursive: bool = False) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the oracle query (DuckDB dialect) over the base tables; fixture
    CTEs it references are prepended automatically.  Omit it for jobs whose
    result is random, physical or time dependent (rows-only check).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql, ctes, recursive)
        return fn
    return deco
