"""Checks on input tables, and building a table only once."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from millrace.sources import storage


class MissingInput(Exception):
    """A table that an earlier job should have written is not there."""


class MissingColumns(ValueError):
    def __init__(self, columns: Sequence[str], path: str | None = None):
        self.columns, self.path = sorted(columns), path
        super().__init__(f"missing columns: {self.columns}" + (f" in {path}" if path else ""))


class WrongHeader(ValueError):
    """Files whose header is not the declared one."""

    def __init__(self, paths: Sequence[str]):
        self.paths = list(paths)
        super().__init__(f"header differs from the schema in {', '.join(self.paths)}")


class TooFewRows(ValueError):
    pass


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = set(columns) - set(df.columns)
    if missing:
        raise MissingColumns(list(missing))
    return df


def require_rows(df: DataFrame, floor: int, only_warn: bool = False) -> DataFrame:
    """Fail, or warn, if ``df`` has fewer rows than ``floor``; reads no more than it takes to tell."""
    n = df.limit(floor).count()
    if n < floor:
        message = f"{n} rows, expected at least {floor}"
        if not only_warn:
            raise TooFewRows(message)
        warnings.warn(message, stacklevel=2)
    return df


def read_required(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingInput(path) from e
        raise


def materialise(spark: SparkSession, build: Callable[[], DataFrame], path: str) -> DataFrame:
    """The table published at ``path``; built and published first where there is none.

    A build writes to a folder of its own below ``path``; publishing is the last step, one small file that names
    the folder. What a died build has left is never read. Of two builders at once one is published;
    each reads what is, and the other's folder goes.
    """
    marker = f"{path}/_published"
    if not storage.read_marker(spark, marker):
        own = f"data-{uuid.uuid4().hex}"
        build().write.parquet(f"{path}/{own}")
        if not storage.read_marker(spark, marker):
            storage.write_marker(spark, marker, own)
        if storage.read_marker(spark, marker) != own:
            storage.remove(spark, f"{path}/{own}")
    return read_required(spark, f"{path}/{storage.read_marker(spark, marker)}")
