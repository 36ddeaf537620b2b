"""Joins of a fact with dimensions and with other facts. Strategies are hints; sizes decide broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
UNKNOWN_BYTES = 1 << 62  # from here on the planner's size is a default, not an estimate


def checked_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``dim`` is proven to fit, else leave the choice to Spark.

    The proof counts rows and bytes where they lie; none moves. A table whose files are over 64 times
    the bound, as the planner knows them, is not even counted. Pass a stored table.
    """
    known = dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if 64 * max_bytes < known < UNKNOWN_BYTES:
        return dim
    size = dim.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*dim.columns)))).alias("b")).first()
    fits = size["n"] <= max_rows and (size["b"] or 0) <= max_bytes
    return F.broadcast(dim) if fits else dim


def join_dim(fact: DataFrame, dim: DataFrame, on: Column) -> DataFrame:
    """Fact and small dimension with differently named keys; the fact is not shuffled."""
    return fact.join(checked_broadcast(dim), on, "inner")


def join_facts(a: DataFrame, b: DataFrame, on: Column | Sequence[str], strategy: str = "merge") -> DataFrame:
    """Two large tables. ``merge`` sorts both sides; ``shuffle_hash`` builds from ``b``, the smaller one, unsorted."""
    return a.join(b.hint(strategy), on, "inner")


def join_rare(a: DataFrame, b: DataFrame, on: Column | Sequence[str], rare: Column) -> DataFrame:
    """Fact and a rare subset. Adaptive execution turns the planned merge join into a broadcast once it sees the size."""
    return a.join(b.where(rare), on, "inner")


def filter_session(spark: SparkSession, scan_bytes: int = 10 << 30) -> SparkSession:
    """A session in which a join of two large tables sends a Bloom filter of one side's keys to the other's scan.

    For a rare side that has outgrown a broadcast: rows without a partner go before the shuffle. Spark builds the
    filter only if that side is filtered, and uses it on scans of over ``scan_bytes``.
    """
    session = spark.newSession()
    for key, value in {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(scan_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }.items():
        session.conf.set(key, value)
    return session


def join_outcome(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str = "left") -> DataFrame:
    """Fact and dimension on a key that is NULL on most fact rows; strategy left to Spark."""
    return fact.join(dim, fact[key] == dim[dim_key], how)


def join_outcome_apart(fact: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Left join in which NULL-key rows, which cannot match, skip the join and its shuffle."""
    keyed = join_outcome(fact.where(F.col(key).isNotNull()), dim, key, dim_key)
    bare = fact.where(F.col(key).isNull()).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in dim.schema}
    )
    return keyed.unionByName(bare)


def unmatched(fact: DataFrame, dim: DataFrame, on: Column) -> DataFrame:
    """Fact rows an inner join with ``dim`` would drop."""
    return fact.join(dim, on, "left_anti")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side the other lacks, counting copies; empty if both hold the same rows. One shuffle, in which tasks combine equal rows first."""
    signed = a.withColumn("_sign", F.lit(1)).unionByName(b.withColumn("_sign", F.lit(-1)))
    left_over = signed.groupBy(*a.columns).agg(F.sum("_sign").alias("_copies")).where("_copies <> 0")
    side = F.when(F.col("_copies") > 0, "left").otherwise("right").alias("side")
    return left_over.select(*a.columns, side, F.explode(F.sequence(F.lit(1), F.abs("_copies"))).alias("_copy")).drop("_copy")


def by_flag(joined: DataFrame, flag: str, value: str) -> DataFrame:
    """Count and mean by a dimension attribute. Reading the attribute keeps the join in the plan."""
    return joined.groupBy(flag).agg(F.count("*").alias("n"), F.avg(value).alias("avg_value"))
