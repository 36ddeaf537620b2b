"""Skew: profiles of keys and partitions, salting, partition counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import hash_partition, salt
from millrace.operators.aggregates import workload
from millrace.operators.joins import by_flag, join_outcome
from millrace.session import stored

PARTITIONS = 16


def _key_counts(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows per (key column, value), with the partition the value hashes to; one scan for all keys."""
    pairs = [
        F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"), hash_partition(k, n).alias("pid"))
        for k in keys
    ]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.key", "p.value", "p.pid")
        .agg(F.count("*").alias("n"))
    )


def _ratio():
    return F.round(F.max("n") / F.percentile("n", F.lit(0.5)), 2)


def _profile_keys(counts: DataFrame) -> DataFrame:
    # min over (-n, value): most rows first, then the smallest value, NULL before all.
    # percentile keeps one entry per different count, at most sqrt(2 * rows) of them.
    return counts.groupBy("key").agg(
        F.count("*").alias("distinct_keys"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("hottest_key"),
        F.max("n").alias("hottest_rows"),
        F.percentile("n", F.lit(0.5)).alias("median_rows"),
        _ratio().alias("skew_ratio"),
    )


def _profile_partitions(counts: DataFrame) -> DataFrame:
    per_pid = counts.groupBy("key", "pid").agg(F.sum("n").alias("n"))
    return per_pid.groupBy("key").agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("partitions_nonempty"),
        F.max("n").alias("max_rows"),
        F.percentile("n", F.lit(0.5)).alias("median_rows"),
        F.min("n").alias("min_rows"),
        _ratio().alias("partition_skew_ratio"),
    )


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys, the hottest one and its rows, median rows per key, and their ratio. NULL is a key."""
    return _profile_keys(_key_counts(df, [key], PARTITIONS))


def partition_profile(df: DataFrame, key: str, n: int = PARTITIONS) -> DataFrame:
    """Rows per partition if ``df`` were hashed on ``key`` into ``n``, without moving it. Empty ones do not count."""
    return _profile_partitions(_key_counts(df, [key], n))


def partition_sizes(df: DataFrame, key: str, n: int = 8) -> DataFrame:
    """Rows of each of ``n`` hash partitions, empty ones included."""
    sizes = df.groupBy(hash_partition(key, n).alias("pid")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias("pid"))
    return every.join(sizes, "pid", "left").select("pid", F.coalesce("n", F.lit(0)).alias("n"))


def fair_share(df: DataFrame, keys: Sequence[str], n: int = PARTITIONS) -> DataFrame:
    """Rows of an even partition, and the hottest value of each key in units of it."""
    counts = _key_counts(df, keys, n)
    return (
        counts.groupBy("key")
        .agg(F.sum("n").alias("_total"), F.max("n").alias("hottest_rows"))
        .select(
            "key",
            (F.col("_total") / n).alias("fair_share"),
            "hottest_rows",
            F.round(F.col("hottest_rows") / (F.col("_total") / n), 2).alias("hottest_shares"),
        )
    )


def profile_keys(df: DataFrame, keys: Sequence[str], n: int = PARTITIONS) -> DataFrame:
    """Key and partition ratios of several keys; ``widest`` marks the key where they differ most."""
    counts = _key_counts(df, keys, n)
    by_key = _profile_keys(counts).select("key", "distinct_keys", "hottest_key", "hottest_rows", "median_rows", "skew_ratio")
    by_pid = _profile_partitions(counts).select("key", "partitions_nonempty", "max_rows", "partition_skew_ratio")
    gap = F.abs(F.col("skew_ratio") - F.col("partition_skew_ratio"))
    first = Window.orderBy(F.desc("_gap"), "key")  # one row per profiled column
    return (
        by_key.join(by_pid, "key")
        .withColumn("_gap", gap)
        .withColumn("widest", F.row_number().over(first) == 1)
        .drop("_gap")
    )


def with_salt(df: DataFrame, stable: Sequence[str], n: int) -> DataFrame:
    return df.withColumn("_salt", salt(stable, n))


def explode_dim(dim: DataFrame, n: int) -> DataFrame:
    """Every dimension row once per salt."""
    return dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def heavy_keys(df: DataFrame, key: str, slots: int, spread: float = 2.0) -> DataFrame:
    """Keys that fill over one of ``slots`` equal parts of the non-NULL rows, and how many salts each gets: ``spread`` times its share of the slots.

    One pass with a mergeable sketch that tracks 16 items a slot; no key is shuffled. Counts are near enough to balance tasks,
    and no result depends on them. All salts together are at most ``spread * slots``, so what they copy is as well.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {slots}, {min(1_000_000, 16 * slots)})")
    top = df.where(F.col(key).isNotNull()).agg(sketch.alias("top"), F.count("*").alias("rows"))
    salts = F.floor(F.col("heavy.count") * spread * slots / F.col("rows")).cast("int")
    rows = top.select(F.explode("top").alias("heavy"), "rows").where(F.col("heavy.count") * slots > F.col("rows"))
    return stored(rows.select(F.col("heavy.item").alias("_hot_key"), F.greatest(salts, F.lit(1)).alias("_salts")), "heavy-keys")


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str, stable: Sequence[str], n: int | None = None, spread: float = 2.0
) -> DataFrame:
    """Left join in which each heavy key (see ``heavy_keys``) spreads over as many salts as its share of ``n`` slots asks for, and its dimension rows with it.

    All other keys have one salt, so their dimension rows are not copied. Rows with a NULL key match nothing and are dealt
    over all slots. ``n`` is by default the number of shuffle partitions. The fact is read twice: for the sketch and for the join.
    """
    n = n or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(fact, key, n, spread))  # under n rows
    marked = fact.join(heavy, F.col(key) == F.col("_hot_key"), "left")
    slot = F.when(F.col(key).isNull(), salt(stable, n)).otherwise(F.when(F.col("_salts").isNull(), 0).otherwise(salt(stable, F.col("_salts"))))
    f = marked.withColumn("_salt", slot).drop("_hot_key", "_salts")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    d = dim.join(heavy, F.col(dim_key) == F.col("_hot_key"), "left").withColumn("_dim_salt", F.explode(salts)).drop("_hot_key", "_salts").hint("merge")
    return f.join(d, (F.col(key) == F.col(dim_key)) & (F.col("_salt") == F.col("_dim_salt")), "left").drop("_salt", "_dim_salt")


def skew_bytes(stored_bytes: int, partitions: int) -> int:
    """What a shuffle partition of a stored table holds on average; Spark's own 256 MB where that is more."""
    return max(1, min(256 << 20, stored_bytes // partitions))


def skew_session(spark: SparkSession, partition_bytes: int = 256 << 20, factor: float = 5.0, advisory: int = 64 << 20) -> SparkSession:
    """A session of the same application in which adaptive execution splits partitions above ``partition_bytes``.

    A partition counts as skewed only above both the bytes and ``factor`` times the median; ``skew_bytes``
    gives bytes that fit a table. Only the output of several map tasks can be split: store the fact in several files.
    """
    session = spark.newSession()
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": str(factor),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }.items():
        session.conf.set(key, value)
    return session


def skew_join(fact: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Left join of stored tables read in a ``skew_session``; Spark splits the hot partition at run time."""
    return join_outcome(fact, dim.hint("merge"), key, dim_key)


def salt_sweep(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, stable: Sequence[str], measure: str,
               flag: str, counts: Sequence[int] = (4, 16, 64)) -> DataFrame:
    """The flag report of ``salted_join`` for several numbers of slots."""
    reports = [
        by_flag(salted_join(fact, dim, key, dim_key, stable, n), flag, measure).withColumn("salts", F.lit(n))
        for n in counts
    ]
    return reduce(DataFrame.unionByName, reports)


def partition_sweep(df: DataFrame, key: str, value: str, counts: Sequence[int]) -> DataFrame:
    """The workload on ``df`` cut into 1, 2, ... partitions; its answer must not depend on the cut. ``used`` counts the partitions that got rows.

    The input is stored first. Each cut runs once: what it used is observed while the workload runs over it.
    """
    rows = stored(df.select(key, value), "sweep-input")
    runs = []
    for n in counts:
        seen = Observation()
        cut = rows.repartition(n).withColumn("_part", F.spark_partition_id())
        report = stored(workload(cut.observe(seen, F.size(F.collect_set("_part")).alias("used")), key, value), "sweep")
        runs.append(report.select("*", F.lit(n).alias("partitions"), F.lit(seen.get["used"]).cast("long").alias("used")))
    return reduce(DataFrame.unionByName, runs)
