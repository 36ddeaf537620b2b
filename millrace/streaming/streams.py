"""Structured Streaming jobs over event files or a log.

Every job keeps its position in a checkpoint folder of its own, so consumers are
independent and resume where they stopped. ``availableNow`` reads what is there
and ends; leave it out for a job that runs on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import alerts
from millrace.operators.log import LOG_SCHEMA
from millrace.session import stored
from millrace.sources import storage

BATCH_BYTES = 64 << 30


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType | str,
    files_per_batch: int | None = None, bytes_per_batch: int = BATCH_BYTES,
) -> DataFrame:
    """Parquet files as a stream, oldest first. A batch holds ``bytes_per_batch``, or ``files_per_batch`` files for a paced replay."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def stream_log(
    spark: SparkSession, topic: str, servers: str | None = None, per_batch: int | None = None
) -> DataFrame:
    """A log as a stream, from its earliest record for a new consumer. ``per_batch`` counts files, on Kafka offsets."""
    if servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic.rsplit("/", 1)[-1])
            .option("startingOffsets", "earliest")
        )
        return (reader.option("maxOffsetsPerTrigger", per_batch) if per_batch else reader).load()
    return stream_files(spark, f"{topic}/records", LOG_SCHEMA, files_per_batch=per_batch)


def append_to(stream: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the rows of a stream to a Parquet table, each exactly once."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    return (writer.trigger(availableNow=True) if once else writer).start(out)


def consume(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Read what has arrived since the last call with this ``checkpoint``."""
    append_to(stream, out, checkpoint).awaitTermination()


def type_counts(stream: DataFrame, kind: str) -> DataFrame:
    """Running count per type."""
    return stream.groupBy(kind).agg(F.count("*").alias("n"))


def publish_totals(totals: DataFrame, out: str, checkpoint: str, once: bool = True, keep: int = 3) -> StreamingQuery:
    """Write the whole of a running aggregate after every batch, to a folder per batch.

    A batch that runs again overwrites its own folder. Its number is published once the folder is
    complete, and readers take the newest published one, so they never see part of a batch. The last ``keep`` batches
    stay for readers that have begun; older ones are removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out}/totals/batch_id={batch_id}")
        storage.write_marker(spark, f"{out}/published/{batch_id}", "complete")
        for number in storage.names(spark, f"{out}/published"):
            if number.isdigit() and int(number) <= batch_id - keep:
                storage.remove(spark, f"{out}/published/{number}")
                storage.remove(spark, f"{out}/totals/batch_id={number}")

    writer = totals.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    newest = max(int(number) for number in storage.names(spark, f"{out}/published") if number.isdigit())
    return spark.read.parquet(f"{out}/totals/batch_id={newest}")


def hourly(stream: DataFrame, ts: str, kind: str, delay: str) -> DataFrame:
    """Rows per hour and type; an hour comes out once the watermark has passed it, later rows are dropped."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    counts = timed.groupBy(F.window(ts, "1 hour"), kind).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), kind, "n")


def late_groups(query: StreamingQuery) -> tuple[int, int]:
    """Rows that a finished query has read, and groups that came after the watermark and were dropped, from its progress.

    Rows of an hour and type that arrive in one batch are one group by the time they meet the state.
    """
    done = query.recentProgress
    return sum(p["numInputRows"] for p in done), sum(s["numRowsDroppedByWatermark"] for p in done for s in p["stateOperators"])


def drop_batch(
    batch: DataFrame, batch_id: int, out: str, entity: str, ts: str, seq: str, value: str,
    last: int = 10, fall: float = 3.0, within: str | None = None, **slices,
) -> None:
    """One batch of ``stream_drops``: alerts to ``out/alerts``, the last rows of each entity to ``out/carry``.

    Both go to a folder of the batch, from the batch and what the batch before carried over, so a batch that runs again writes the
    same rows in place. Carry-overs of older batches are removed.
    """
    spark = batch.sparkSession
    new = batch.select(seq, ts, entity, value).withColumn("_new", F.lit(True))
    carried = f"{out}/carry/batch_id={batch_id - 1}"
    if batch_id > 0:
        new = new.unionByName(spark.read.schema(new.schema).parquet(carried).withColumn("_new", F.lit(False)))
    rows = stored(new, "alert-batch")  # read by several jobs
    found = alerts.drops(rows, entity, ts, seq, value, last, fall, within=within, **slices)
    of_batch = rows.where("_new").select(F.col(seq).alias("_seq"))
    found.join(of_batch, F.col(seq) == F.col("_seq"), "left_semi").write.mode("overwrite").parquet(f"{out}/alerts/batch_id={batch_id}")
    # tasks keep the last rows of an entity before the shuffle, so a hot one never meets in one task
    newest = Window.partitionBy(entity).orderBy(F.desc(ts), F.desc(seq))
    kept = rows.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") < last).drop("_age")
    if within:
        kept = kept.where(F.col(ts) >= rows.agg(F.max(ts)).scalar() - F.expr(f"INTERVAL {within}"))
    kept.write.mode("overwrite").parquet(f"{out}/carry/batch_id={batch_id}")
    for name in storage.names(spark, f"{out}/carry"):
        if int(name.partition("=")[2]) < batch_id - 1:
            storage.remove(spark, f"{out}/carry/{name}")


def stream_drops(
    stream: DataFrame, out: str, checkpoint: str, entity: str, ts: str, seq: str, value: str,
    last: int = 10, fall: float = 3.0, within: str | None = None, once: bool = True, **slices,
) -> StreamingQuery:
    """``alerts.drops`` on a stream whose batches follow time order; alerts are read from ``out`` by ``stream_alerts``.

    A batch runs through the batch operator together with what is carried over: the last ``last - 1`` rows of each
    entity. Hot entities are cut into slices as there (``share``, ``slice_rows``). With ``within``, rows older than that before
    a row do not count, and an entity that has been silent so long is no longer carried.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        drop_batch(batch, batch_id, out, entity, ts, seq, value, last, fall, within, **slices)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_alerts(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/alerts").drop("batch_id")
