"""Registration and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with the SQL that gives the same rows."""
    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the schema once per session."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{folder}/{name}.parquet")
    return _TABLES[key]
