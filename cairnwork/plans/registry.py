"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of a table reader under its own name."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        assert f.__name__ not in QUERIES
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
