"""Registered queries over the test tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path
from millrace.sources.files import scan_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_staged: dict[tuple[str, str, str], str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{data}/{name}.parquet")


def staged(spark: SparkSession, data: str, name: str, build: Callable[[str], None]) -> str:
    """Path of a derived table; written to the shared folder once per application and data set."""
    key = (spark.sparkContext.applicationId, data, name)
    if key not in _staged:
        path = shared_path(spark, name)
        build(path)
        _staged[key] = path
    return _staged[key]


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Doubles whose last bits depend on the order of addition, made comparable."""
    return df.withColumns({c: F.round(c, places) for c in columns})
