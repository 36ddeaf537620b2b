"""A partitioned append-only log as tables.

A log folder holds ``records``, one folder per partition, with the seven columns
of a Kafka read, and ``ends``, the next offset of each partition after every
append. Ends never move back, also when retention has taken every record.
With ``servers`` the same calls read and write Kafka topics; that needs the Kafka
connector on the class path.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import hash_partition
from millrace.operators.ranking import numbered
from millrace.sources.files import inline

LOG_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
LOG_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"
)
ENDS_SCHEMA = "partition INT, end_offset BIGINT"
EVENT_VALUE = (
    "id STRING, type STRING, actor STRING, repo STRING, created_at STRING, public BOOLEAN, payload_bytes INT"
)

Bound = str | Mapping[int, int]


def assign(df: DataFrame, n: int, key: str | None = None, seq: str = "seq") -> DataFrame:
    """Give each record a partition: by the hash of its key, or in turn along ``seq`` without a key."""
    place = hash_partition(key, n) if key else F.pmod(F.col(seq), F.lit(n))
    return df.withColumn("partition", place.cast("int"))


def with_offsets(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Dense 0-based offset inside each partition, in ``seq`` order."""
    return numbered(df, [F.col(seq)], within=["partition"], out="offset")


def produce(
    records: DataFrame, topic: str, n: int, key: str | None = None, seq: str = "seq", servers: str | None = None
) -> None:
    """Append (seq, entity, type, value, timestamp) rows to a log; ``key`` is ``entity``, ``type`` or None.

    One writer per log. ``topic`` is the log folder, or the topic name on Kafka.
    """
    spark = records.sparkSession
    key_bytes = F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")
    value_bytes = F.col("value").cast("binary")
    if servers:
        out = records.select(key_bytes.alias("key"), value_bytes.alias("value"), "timestamp")
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        return
    placed = with_offsets(assign(records, n, key, seq), seq)
    start = {r["partition"]: r["end_offset"] for r in end_offsets(spark, topic).collect()}  # one row per partition
    base = inline(spark, [(p, start.get(p, 0)) for p in range(n)], ENDS_SCHEMA)
    # Offsets are taken before records are written: an append that dies leaves a gap, never an offset used twice.
    counts = placed.groupBy("partition").agg(F.count("*").alias("_new"))
    taken = F.broadcast(base).join(counts, "partition", "left")
    taken.select("partition", (F.col("end_offset") + F.coalesce("_new", F.lit(0))).alias("end_offset")).coalesce(
        1
    ).write.mode("append").parquet(f"{topic}/ends")
    rows = placed.join(F.broadcast(base), "partition").select(
        key_bytes.alias("key"),
        value_bytes.alias("value"),
        F.lit(topic.rstrip("/").rsplit("/", 1)[-1]).alias("topic"),
        "partition",
        (F.col("offset") + F.col("end_offset")).alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows.write.mode("append").partitionBy("partition").parquet(f"{topic}/records")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def next_offsets(records: DataFrame) -> DataFrame:
    """One past the highest offset of each partition among ``records``."""
    return records.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def read_log(
    spark: SparkSession, topic: str, start: Bound = "earliest", end: Bound = "latest", servers: str | None = None
) -> DataFrame:
    """A bounded read. Bounds are ``earliest``, ``latest`` or offsets by partition; ``end`` is exclusive."""
    if servers:
        name = topic.rsplit("/", 1)[-1]
        offsets = [b if isinstance(b, str) else json.dumps({name: {str(p): o for p, o in b.items()}}) for b in (start, end)]
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", name)
            .option("startingOffsets", offsets[0])
            .option("endingOffsets", offsets[1])
            .load()
        )
    log = _table(spark, f"{topic}/records", LOG_SCHEMA).select(LOG_COLUMNS)
    if not isinstance(start, str):
        log = log.where(_bound(start, lambda o: F.col("offset") >= o))
    if not isinstance(end, str):
        log = log.where(_bound(end, lambda o: F.col("offset") < o))
    return log


def _bound(bounds: Mapping[int, int], test) -> Column:
    keep = F.lit(False)
    for partition, offset in bounds.items():
        keep = keep | ((F.col("partition") == partition) & test(F.lit(offset)))
    return keep


def end_offsets(spark: SparkSession, topic: str) -> DataFrame:
    """The offset the next record of each partition will get, from the kept table."""
    ends = _table(spark, f"{topic}/ends", ENDS_SCHEMA)
    return ends.groupBy("partition").agg(F.max("end_offset").alias("end_offset"))


def earliest_offsets(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Oldest readable offset per partition; the end where nothing is left."""
    first = log.groupBy("partition").agg(F.min("offset").alias("_first"))
    return ends.join(first, "partition", "left").select(
        "partition", F.coalesce("_first", "end_offset").alias("earliest_offset"), "end_offset"
    )


def log_profile(log: DataFrame, n: int) -> DataFrame:
    """Records and share per partition, and the ratio of the fullest to the emptiest, infinite if one is empty."""
    counts = log.groupBy("partition").agg(F.count("*").alias("_n"))
    every = log.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    rows = every.join(counts, "partition", "left").select("partition", F.coalesce("_n", F.lit(0)).alias("records"))
    whole = Window.partitionBy()  # n rows
    low = F.min("records").over(whole)
    ratio = F.when(low > 0, F.max("records").over(whole) / low).otherwise(F.lit(float("inf")))
    total = F.greatest(F.sum("records").over(whole), F.lit(1))
    return rows.select(
        "partition",
        "records",
        F.round(F.col("records") * 100 / total, 1).alias("share"),
        F.round(ratio, 2).alias("max_min_ratio"),
    )


def read_slice(log: DataFrame, partition: int, offset: int, most: int) -> DataFrame:
    """Up to ``most`` records of one partition from ``offset`` on, in order.

    Without gaps they are the next ``most`` offsets, and only their part of the
    partition is read; else the rest of the partition is searched.
    """
    rest = log.where((F.col("partition") == partition) & (F.col("offset") >= offset))
    near = rest.where(F.col("offset") < offset + most)
    rows = near if near.count() == most else rest
    return rows.orderBy("offset").limit(most)


def keys_per_partition(log: DataFrame) -> DataFrame:
    return log.groupBy("partition").agg(F.count_distinct("key").alias("keys"))


def partitions_per_key(log: DataFrame) -> DataFrame:
    """Number of partitions that hold each key; a keyed log has 1 everywhere."""
    return log.groupBy("key").agg(F.count_distinct("partition").alias("partitions"))


def reassign(df: DataFrame, key: str, counts: tuple[int, ...] = (4, 40)) -> DataFrame:
    """Partitions that hold any record for several partition counts; distinct keys cap the number."""
    by_key = df.groupBy(key).agg(F.count("*").alias("n"))
    slots = [F.struct(F.lit(n).alias("partitions"), hash_partition(key, n).alias("pid")) for n in counts]
    placed = by_key.select("n", F.explode(F.array(*slots)).alias("s")).groupBy("s.partitions", "s.pid").agg(
        F.sum("n").alias("n"), F.count("*").alias("keys")
    )
    return placed.groupBy("partitions").agg(
        F.count("*").alias("used"),
        F.sum("keys").alias("distinct_keys"),
        F.sum("n").alias("records"),
        F.max("n").alias("max_records"),
        F.min("n").alias("min_records"),
    )


def reconcile(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows per partition against its end offset."""
    counts = log.groupBy("partition").agg(F.count("*").alias("records"))
    both = counts.join(ends, "partition", "full")
    return both.select(
        "partition",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("end_offset", F.lit(0)).alias("end_offset"),
        F.coalesce("records", F.lit(0)).eqNullSafe(F.coalesce("end_offset", F.lit(0))).alias("matches"),
    )


def decode(log: DataFrame, schema: str = EVENT_VALUE) -> DataFrame:
    """Key and value as text, the value parsed."""
    text = log.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
    return text.withColumn("event", F.from_json("value", schema))


def lag(committed: DataFrame, ends: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Position, end and distance per group and each of ``n`` partitions; a group without a commit is at 0.

    ``committed`` has (group, partition, current), ``groups`` a row per group.
    """
    seats = groups.select("group").distinct().withColumn("partition", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    at = committed.select("group", "partition", "current")
    return (
        seats.join(at, ["group", "partition"], "left")
        .join(ends, "partition")
        .withColumn("current", F.coalesce("current", F.lit(0)))
        .select("group", "partition", "current", "end_offset", (F.col("end_offset") - F.col("current")).alias("lag"))
    )


def commit(committed: DataFrame, group: str, read: DataFrame) -> DataFrame:
    """Positions after ``group`` has read ``read``: one past its last record; positions do not move back."""
    moved = next_offsets(read).select(F.lit(group).alias("group"), "partition", F.col("end_offset").alias("current"))
    both = committed.select("group", "partition", "current").unionByName(moved)
    return both.groupBy("group", "partition").agg(F.max("current").alias("current"))


def reset(committed: DataFrame, group: str, earliest: DataFrame) -> DataFrame:
    """Put ``group`` back to the oldest readable records; the log stays as it is."""
    others = committed.select("group", "partition", "current").where(F.col("group") != group)
    start = earliest.select(F.lit(group).alias("group"), "partition", F.col("earliest_offset").alias("current"))
    return others.unionByName(start)


def expire(log: DataFrame, now: Column | None, keep_seconds: int) -> DataFrame:
    """Records not older than ``keep_seconds`` at ``now``, by default the newest timestamp of the log."""
    at = now if now is not None else log.agg(F.max("timestamp")).scalar()
    return log.where(F.col("timestamp") >= at - F.expr(f"INTERVAL {int(keep_seconds)} SECONDS"))


def retention_bytes(log: DataFrame, keep_seconds: int) -> DataFrame:
    """Bytes the window before the newest record keeps, per partition."""
    return expire(log, None, keep_seconds).groupBy("partition").agg(
        F.count("*").alias("records"), F.sum(F.octet_length("value")).alias("bytes")
    )
