"""Queries on streams. Each starts with empty checkpoints and runs until it has read what is there."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import log
from millrace.plans import inputs
from millrace.plans.logs import ALERT_SQL
from millrace.plans.registry import query, table
from millrace.session import shared_path
from millrace.streaming import streams

N = inputs.LOG_PARTITIONS


def _events(spark, data, **limits):
    # a pattern as the path matches a table of one file and a folder of many
    return streams.stream_files(spark, f"{data}/events.parque[t]", table(spark, data, "events").schema, **limits)


def _ids(spark, out):
    return log.decode(spark.read.schema(log.LOG_SCHEMA).parquet(out)).select(F.col("event.id").cast("long").alias("event_id"))


def _arrivals(spark, data):
    """The events in two appends."""
    e = table(spark, data, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return inputs.records(e.where(early)), inputs.records(e.where(~early))


def _label(frames):
    return reduce(DataFrame.unionByName, [f.withColumn("run", F.lit(name)) for name, f in frames.items()])


HALF = "ts < TIMESTAMP '2024-01-16'"


@query(
    "stream_resume",
    f"SELECT event_id, CASE WHEN {HALF} THEN 'first' ELSE 'backlog' END AS run FROM events",
)
def stream_resume(spark, data):
    """A consumer reads, stops, the log grows, and the restart reads the backlog only; a third run finds nothing."""
    root = shared_path(spark, "stream_resume")
    runs = {}
    arrivals = dict(zip(("first", "backlog"), _arrivals(spark, data)))
    for run in ("first", "backlog", "nothing"):
        if run in arrivals:
            log.produce(arrivals[run], f"{root}/log", N)
        before = _ids(spark, f"{root}/out") if runs else None
        streams.consume(streams.stream_log(spark, f"{root}/log"), f"{root}/out", f"{root}/checkpoint")
        after = _ids(spark, f"{root}/out")
        runs[run] = after.exceptAll(before) if before is not None else after
    return _label(runs)


@query(
    "stream_two_groups",
    f"SELECT event_id, 'whole' AS run FROM events UNION ALL SELECT event_id, 'early' FROM events WHERE {HALF}",
)
def stream_two_groups(spark, data):
    """Two consumers of one log: one stops after the first append, the other reads on."""
    root = shared_path(spark, "stream_two_groups")
    first, second = _arrivals(spark, data)
    for records, groups in ((first, ("whole", "early")), (second, ("whole",))):
        log.produce(records, f"{root}/log", N)
        for g in groups:
            streams.consume(streams.stream_log(spark, f"{root}/log"), f"{root}/{g}", f"{root}/checkpoint-{g}")
    return _label({g: _ids(spark, f"{root}/{g}") for g in ("whole", "early")})


@query("stream_type_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_type_counts(spark, data):
    root = shared_path(spark, "stream_type_counts")
    totals = streams.type_counts(_events(spark, data), "event_type")
    streams.publish_totals(totals, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return streams.latest_totals(spark, f"{root}/out")


ARRIVALS = 2
# Every seventh event arrives with the half month after its own; what the watermark (2 hours) has passed by then is late.
ARRIVED_SQL = """
WITH e AS (SELECT *, date_trunc('hour', ts) AS hour, ((day(ts) - 1) // 15 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END)::INT AS arrival FROM events),
     m AS (SELECT arrival, max(ts) AS newest FROM e GROUP BY arrival),
     r AS (SELECT e.*, hour + INTERVAL 1 HOUR <= (SELECT max(newest) FROM m WHERE m.arrival < e.arrival) - INTERVAL 2 HOUR AS late FROM e)
"""


def _late_runs(spark, data):
    """Hourly counts of the events as they arrive, late ones among them; folder of the hours, and what each run read and dropped."""
    root = shared_path(spark, "stream_hourly_sink")
    e = table(spark, data, "events")
    arrival = F.floor((F.dayofmonth("ts") - 1) / 15) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    runs = []
    for n in range(ARRIVALS + 2):  # the 31st of a month as well
        e.where(arrival == n).write.mode("append").parquet(f"{root}/in")
        hours = streams.hourly(streams.stream_files(spark, f"{root}/in", e.schema), "ts", "event_type", "2 hours")
        run = streams.append_to(hours, f"{root}/out", f"{root}/checkpoint")
        run.awaitTermination()
        runs.append((n, *streams.late_groups(run)))
    return f"{root}/out", runs


@query(
    "stream_hourly_sink",
    ARRIVED_SQL
    + """
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM r WHERE late IS NOT true
GROUP BY hour, event_type HAVING hour + INTERVAL 1 HOUR <= (SELECT max(newest) FROM m) - INTERVAL 2 HOUR
""",
)
def stream_hourly_sink(spark, data):
    out, _ = _late_runs(spark, data)
    return spark.read.parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "stream_late_rows",
    ARRIVED_SQL
    + """
SELECT arrival, count(*) AS n_rows, count(DISTINCT CASE WHEN late THEN {'h': hour, 't': event_type} END) AS late_groups FROM r GROUP BY arrival
""",
)
def stream_late_rows(spark, data):
    """What each run of the hourly sink has read, and how many groups of an hour and type it dropped as late."""
    _, runs = _late_runs(spark, data)
    return spark.createDataFrame(runs, "arrival INT, n_rows LONG, late_groups LONG").where("n_rows > 0")


@query("stream_alert", ALERT_SQL)
def stream_alert(spark, data):
    """Three arrivals in time order, a run after each: drops against the last rows of an entity, whichever batch they came in and however old they are."""
    root = shared_path(spark, "stream_alert")
    e = table(spark, data, "events")
    second, third = (F.col("ts") >= F.lit(day).cast("timestamp_ntz") for day in ("2024-01-11", "2024-01-21"))
    for arrival in (~second, second & ~third, third):
        e.where(arrival).write.mode("append").parquet(f"{root}/in")
        stream = streams.stream_files(spark, f"{root}/in", e.schema)
        streams.stream_drops(stream, f"{root}/out", f"{root}/checkpoint", "user_id", "ts", "event_id", "value").awaitTermination()
    return streams.stream_alerts(spark, f"{root}/out")


@query("stream_paced", "SELECT event_id FROM events")
def stream_paced(spark, data):
    """A replay of the log, two files a batch."""
    root = shared_path(spark, "stream_paced")
    paced = streams.stream_log(spark, inputs.log_of(spark, data), per_batch=2)
    streams.consume(paced, f"{root}/out", f"{root}/checkpoint")
    return _ids(spark, f"{root}/out")
