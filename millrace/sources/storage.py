"""Names in a file system that Spark reaches: small marker files, and folders that are no longer read.

Only the driver calls these; tables are written and read by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder or file with all below it; an absent one is no error."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below a folder; nothing if it is absent."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def read_marker(spark: SparkSession, path: str) -> str | None:
    """The text of a marker, None if there is none."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Write a marker aside and rename it into place, so nobody reads half of it.

    A file system that refuses to rename onto a file that is there, as HDFS does, keeps the first of two writers' markers.
    """
    fs, aside = _at(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(aside, _at(spark, path)[1]):
        fs.delete(aside, False)
