"""The register of queries, each with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name or `name`, with its SQL."""

    def add(f: Query) -> Query:
        _QUERIES[name or f.__name__] = f
        _SQL[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def registered_sql() -> dict[str, str]:
    return dict(_SQL)
