"""Every operator as a query on the driver's tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.bindings.marts import Marts, plain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query built from the lazy pipeline tables."""

    def wrap(build: Callable[[Marts], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Marts(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return wrap


def register_direct(name: str, sql: str | None = None):
    """Add a query that reads the driver's tables itself."""

    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return wrap


def load() -> None:
    """Import the modules that register queries."""
    from kerbside.bindings import (  # noqa: F401
        core_queries,
        incremental_queries,
        market_queries,
        metric_queries,
        quality_queries,
        stream_queries,
    )
