"""Name -> (Spark query, SQL check).  Modules of this package fill it on import."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickflow.fixtures import feeds_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the full check text, or None for rows-only."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def over_feeds(body: str, ctes: str = "", recursive: bool = False) -> str:
    """SQL over the feed views, with further CTEs if given."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + feeds_sql() + (",\n" + ctes if ctes else "") + "\n" + body


def r6(expr: str, digits: int = 6) -> str:
    """Round, with negative zero folded into zero as Spark's decimal rounding does."""
    return f"(CASE WHEN round({expr},{digits})=0 THEN CAST(0 AS DOUBLE) ELSE round({expr},{digits}) END)"
