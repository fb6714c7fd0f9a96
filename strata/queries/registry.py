"""Queries with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of (spark, tables) under its name; tables are read by attribute."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(spark, Tables(spark, sf_dir))
        if sql:
            SQL[key] = sql
        return f

    return register


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
