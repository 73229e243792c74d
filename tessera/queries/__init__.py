"""Registered queries of the engine, bound to the driver's tables; each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[..., DataFrame]], Query]:
    """Registers a function of a table reader t(name) under its own name."""

    def add(f: Callable[..., DataFrame]) -> Query:
        def bound(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = bound
        if sql:
            SQL[f.__name__] = sql
        return bound

    return add


from tessera.queries import entities, marts, published, relational, reports, sources, texts  # noqa: E402,F401
