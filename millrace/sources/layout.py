"""Writers: codecs, file counts, folders by key."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import row_order
from millrace.sources.files import path_size

# Format name -> (writer format, codec)
CODECS = {
    "csv_gzip": ("csv", "gzip"),
    "parquet_none": ("parquet", "none"),
    "parquet_snappy": ("parquet", "snappy"),
    "parquet_gzip": ("parquet", "gzip"),
    "parquet_zstd": ("parquet", "zstd"),
}


def spread(scan: DataFrame) -> DataFrame:
    """A stored table in fewer splits than cores, dealt out over the cores; for work that costs more than moving it.

    A table with splits for half of the cores stays as it is: to sort and move all of a large one for the
    other half costs more. Only for plain scans: the number of splits of a derived frame is not known before it runs.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if 2 * scan.rdd.getNumPartitions() < cores else scan


def in_files(df: DataFrame, n: int, shuffle: bool = True) -> DataFrame:
    """``df`` in ``n`` partitions; the number is the caller's, whatever the size.

    ``shuffle=False`` only joins neighbouring partitions, if there are more than ``n``. Use it for stored
    tables: on a derived frame it would narrow the work above it as well.
    """
    return df.repartition(n) if shuffle or df.rdd.getNumPartitions() < n else df.coalesce(n)


def files_for(stored: int, least: int, each: int = 32 << 20) -> int:
    """How many files a table of ``stored`` Parquet bytes is cut into, so that a task sorts rows of ``each`` bytes; at least ``least``."""
    return max(least, ceil(stored / each))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_files(df: DataFrame, path: str, n: int, shuffle: bool = True) -> None:
    in_files(df, n, shuffle).write.mode("overwrite").parquet(path)


def write_dim(df: DataFrame, path: str) -> None:
    """A dimension in one file; one that outgrows a file of advisory size gets more."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_text(df: DataFrame, path: str) -> None:
    """Lines in files of advisory size; how many follows from the bytes."""
    df.hint("rebalance").write.mode("overwrite").text(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """One folder per key value.

    ``rebalance`` brings the rows of a key together, so folders hold few files,
    and splits a hot key over several tasks.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int) -> None:
    """Files and row groups that each hold a narrow range of ``by``: readers of a few keys skip the others by their statistics."""
    df.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def folder_count(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of folders that ``write_partitioned`` makes for ``df``."""
    return df.select(*by).distinct().agg(F.count("*").alias("folders"))


def codec_sweep(df: DataFrame, out: str, n: int = 4) -> DataFrame:
    """Write ``df`` as plain CSV and in every format of ``CODECS``; rows read back, files, sizes and ratios against plain CSV.

    Each format is a job of ``n`` tasks, one a file; the jobs run side by side, so that they fill more than ``n`` cores.
    """
    spark = df.sparkSession
    spread = in_files(df, n, shuffle=False)

    def write(name: str, fmt: str, codec: str) -> None:
        writer = spread.write.mode("overwrite").format(fmt).option("compression", codec)
        (writer.option("header", True) if fmt == "csv" else writer).save(f"{out}/{name}")

    formats = {"csv_plain": ("csv", "none")} | CODECS
    with ThreadPoolExecutor(len(formats)) as pool:
        list(pool.map(lambda name: write(name, *formats[name]), formats))
    plain = path_size(spark, f"{out}/csv_plain").first()["bytes"]
    sizes = []
    for name, (fmt, _) in CODECS.items():
        back = (spark.read.option("header", True).csv if fmt == "csv" else spark.read.parquet)(f"{out}/{name}")
        rows = back.agg(F.count("*")).scalar()
        sizes.append(path_size(spark, f"{out}/{name}").select("*", F.lit(name).alias("format"), rows.alias("rows")))
    return reduce(DataFrame.unionByName, sizes).select(
        "format", "rows", "files", "bytes", "mb", F.round(F.lit(plain) / F.col("bytes"), 2).alias("ratio")
    )


def split_small(df: DataFrame, rows: int, files: int, path: str) -> None:
    """The first ``rows`` rows in column order, cut into ``files`` small CSV files."""
    first = df.orderBy(*row_order(df)).limit(rows)
    first.repartition(files).write.mode("overwrite").option("header", True).csv(path)
