"""Queries on event trimming, the log and alerts."""

from pyspark.sql import functions as F

from millrace.operators import alerts, log
from millrace.operators.events import pitch_events
from millrace.operators.joins import difference
from millrace.plans import inputs
from millrace.plans.registry import query, staged, table

N = inputs.LOG_PARTITIONS
WEEK = 7 * 24 * 3600
ENDS_SQL = "SELECT (event_id % 4)::INT AS partition, count(*) AS end_offset FROM events GROUP BY 1"


def _log(spark, data, key=None):
    topic = inputs.log_of(spark, data, key)
    return log.read_log(spark, topic), log.end_offsets(spark, topic)


def _positions(frame):
    return frame.select("partition", "offset", F.col("value").cast("string").alias("value"))


@query("event_trim", inputs.TRIMMED_SQL)
def event_trim(spark, data):
    return inputs.trimmed(spark, data)


@query(
    "event_trim_pitch",
    """
WITH t AS (
  SELECT l_orderkey::VARCHAR AS repo, l_returnflag AS type, l_suppkey::VARCHAR AS actor,
         strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00Z' AS created_at,
         length('{"l_orderkey":"' || l_orderkey || '","l_partkey":"' || l_partkey || '","l_suppkey":"' || l_suppkey ||
                '","l_quantity":"' || l_quantity || '","l_returnflag":"' || l_returnflag || '"}') AS size
  FROM lineitem)
SELECT repo AS entity, type, '{"id":"' || repo || '-0","type":"' || type || '","actor":"' || actor || '","repo":"' || repo ||
       '","created_at":"' || created_at || '","public":true,"payload_bytes":' || size || '}' AS value
FROM t
""",
)
def event_trim_pitch(spark, data):
    li = table(spark, data, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    body = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
    return pitch_events(li, "l_orderkey", "l_returnflag", "l_suppkey", "day", body=body)


@query(
    "sink_log_append",
    f"""
SELECT partition::INT AS partition, value,
       row_number() OVER (PARTITION BY partition ORDER BY ts >= TIMESTAMP '2024-01-16', event_id) - 1 AS "offset"
FROM ({inputs.RECORD_SQL})
""",
)
def sink_log_append(spark, data):
    """Two appends, split in time; offsets go on where the first one ended."""

    def build(path):
        e = table(spark, data, "events")
        early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
        for part in (e.where(early), e.where(~early)):
            log.produce(inputs.records(part), path, N)

    return _positions(log.read_log(spark, staged(spark, data, "log_two_appends", build)))


@query("scan_log_bounded", f'SELECT partition::INT AS partition, "offset", value FROM ({inputs.RECORD_SQL})')
def scan_log_bounded(spark, data):
    return _positions(log.read_log(spark, inputs.log_of(spark, data), "earliest", "latest"))


@query(
    "log_assign_keyed",
    "SELECT user_id::VARCHAR AS entity, count(*) AS records, 1::BIGINT AS partitions, true AS in_range FROM events GROUP BY user_id",
)
def log_assign_keyed(spark, data):
    """What a key promises: all records of an entity are in one of the partitions. Which one is the hash's choice."""
    placed = log.assign(inputs.records(table(spark, data, "events")), N, key="entity")
    return placed.groupBy("entity").agg(
        F.count("*").alias("records"),
        F.count_distinct("partition").alias("partitions"),
        F.bool_and(F.col("partition").between(0, N - 1)).alias("in_range"),
    )


@query("log_assign_unkeyed", "SELECT event_id, (event_id % 4)::INT AS partition FROM events")
def log_assign_unkeyed(spark, data):
    placed = log.assign(inputs.records(table(spark, data, "events")), N)
    return placed.select(F.col("seq").alias("event_id"), "partition")


@query(
    "log_offsets",
    """
SELECT event_id, (event_id % 4)::INT AS partition, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS "offset"
FROM events
""",
)
def log_offsets(spark, data):
    seq = table(spark, data, "events").select("event_id")
    return log.with_offsets(log.assign(seq, N, seq="event_id"), "event_id").select("event_id", "partition", "offset")


@query("log_end_offsets", ENDS_SQL)
def log_end_offsets(spark, data):
    return _log(spark, data)[1]


# Retention of 7 days before the newest record.
KEPT_SQL = f"""
SELECT partition::INT AS partition,
       coalesce(min("offset") FILTER (WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY), max("offset") + 1) AS earliest_offset,
       max("offset") + 1 AS end_offset
FROM ({inputs.RECORD_SQL}) GROUP BY partition
"""


@query("log_earliest_offsets", KEPT_SQL)
def log_earliest_offsets(spark, data):
    rows, ends = _log(spark, data)
    return log.earliest_offsets(log.expire(rows, None, WEEK), ends)


@query(
    "log_partition_profile",
    """
WITH c AS (SELECT (event_id % 4)::INT AS partition, count(*) AS records FROM events GROUP BY 1)
SELECT partition, records, round(100.0 * records / sum(records) OVER (), 1) AS share,
       round(max(records) OVER () / min(records) OVER (), 2) AS max_min_ratio FROM c
""",
)
def log_partition_profile(spark, data):
    return log.log_profile(_log(spark, data)[0], N)


@query(
    "log_read_slice",
    f'SELECT partition::INT AS partition, "offset", value FROM ({inputs.RECORD_SQL}) WHERE partition = 1 AND "offset" >= 100 ORDER BY "offset" LIMIT 20',
)
def log_read_slice(spark, data):
    return _positions(log.read_slice(_log(spark, data)[0], 1, 100, 20))


@query("log_reread_same", "SELECT 0 AS partition, event_id AS \"offset\", 'left' AS side FROM events WHERE false")
def log_reread_same(spark, data):
    """The whole log read twice, compared record by record."""
    topic = inputs.log_of(spark, data)
    once, again = (log.read_log(spark, topic) for _ in range(2))
    return difference(once, again).select("partition", "offset", "side")


@query(
    "log_key_placement",
    "SELECT user_id::VARCHAR AS key, 1::BIGINT AS partitions FROM events GROUP BY user_id",
)
def log_key_placement(spark, data):
    placed = log.partitions_per_key(_log(spark, data, "entity")[0])
    return placed.select(F.col("key").cast("string").alias("key"), "partitions")


@query("log_keys_per_partition", "SELECT count(DISTINCT event_type) AS keys FROM events")
def log_keys_per_partition(spark, data):
    """Which partition holds a key is the hash's choice; that each key is in one of them, so that they add up, is not."""
    return log.keys_per_partition(_log(spark, data, "type")[0]).agg(F.sum("keys").alias("keys"))


@query(
    "log_repartition",
    """
SELECT p.partitions, count(DISTINCT event_type) AS distinct_keys, count(*) AS records, true AS capped
FROM events, (VALUES (4), (40)) p(partitions) GROUP BY p.partitions
""",
)
def log_repartition(spark, data):
    """More partitions do not help beyond the number of keys; how many of them are used is the hash's choice."""
    wide = log.reassign(table(spark, data, "events"), "event_type", (4, 40))
    return wide.select("partitions", "distinct_keys", "records", (F.col("used") <= F.col("distinct_keys")).alias("capped"))


@query(
    "log_count_by_partition",
    f"SELECT partition, end_offset AS records, end_offset, true AS matches FROM ({ENDS_SQL})",
)
def log_count_by_partition(spark, data):
    return log.reconcile(*_log(spark, data))


@query(
    "log_decode",
    "SELECT event_type AS type, count(*) AS n, sum(length(props))::BIGINT AS payload FROM events GROUP BY event_type",
)
def log_decode(spark, data):
    events = log.decode(_log(spark, data)[0])
    return events.groupBy("event.type").agg(F.count("*").alias("n"), F.sum("event.payload_bytes").alias("payload"))


def _committed(spark, data):
    """Group ``solo`` has read the first half of January, ``second`` 20 records of partition 0."""
    rows, _ = _log(spark, data)
    none = spark.createDataFrame([], '`group` STRING, partition INT, current BIGINT')
    half = rows.where(F.col("timestamp").cast("timestamp_ntz") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return log.commit(log.commit(none, "solo", half), "second", log.read_slice(rows, 0, 0, 20))


GROUPS_SQL = f"""
WITH l AS ({inputs.RECORD_SQL}),
     e AS (SELECT partition::INT AS partition, max("offset") + 1 AS end_offset FROM l GROUP BY 1),
     solo AS (SELECT 'solo' AS "group", partition::INT AS partition,
                     coalesce(max("offset") FILTER (WHERE ts < TIMESTAMP '2024-01-16') + 1, 0) AS current FROM l GROUP BY 2),
     second AS (SELECT 'second' AS "group", partition, CASE WHEN partition = 0 THEN least(end_offset, 20) ELSE 0 END AS current FROM e),
     fresh AS (SELECT 'fresh' AS "group", partition, 0 AS current FROM e)
"""
LAG_SQL = 'SELECT g."group", partition, current, end_offset, end_offset - current AS lag FROM {} g JOIN e USING (partition)'


def _groups(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "`group` STRING")


@query("log_lag", GROUPS_SQL + LAG_SQL.format("solo") + " UNION ALL " + LAG_SQL.format("fresh"))
def log_lag(spark, data):
    committed = _committed(spark, data).where("`group` = 'solo'")
    return log.lag(committed, _log(spark, data)[1], _groups(spark, "solo", "fresh"), N)


@query("log_groups_independent", GROUPS_SQL + LAG_SQL.format("solo") + " UNION ALL " + LAG_SQL.format("second"))
def log_groups_independent(spark, data):
    return log.lag(_committed(spark, data), _log(spark, data)[1], _groups(spark, "solo", "second"), N)


@query(
    "log_commit_reset",
    GROUPS_SQL
    + LAG_SQL.format("(SELECT 'solo' AS \"group\", partition, 0 AS current FROM e)")
    + " UNION ALL "
    + LAG_SQL.format("second"),
)
def log_commit_reset(spark, data):
    rows, ends = _log(spark, data)
    rewound = log.reset(_committed(spark, data), "solo", log.earliest_offsets(rows, ends))
    return log.lag(rewound, ends, _groups(spark, "solo", "second"), N)


@query("log_retention", KEPT_SQL)
def log_retention(spark, data):
    rows, ends = _log(spark, data)
    return log.earliest_offsets(log.expire(rows, None, WEEK), ends)


@query(
    "log_retention_bytes",
    f"""
SELECT partition::INT AS partition, count(*) AS records, sum(strlen(value))::BIGINT AS bytes FROM ({inputs.RECORD_SQL})
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1
""",
)
def log_retention_bytes(spark, data):
    return log.retention_bytes(_log(spark, data)[0], WEEK)


ALERT_SQL = """
SELECT event_id, user_id, prev_max, value FROM (
  SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS prev_max
  FROM events) WHERE prev_max - value >= 3
"""


@query("alert_drop", ALERT_SQL)
def alert_drop(spark, data):
    return alerts.drops(table(spark, data, "events"), "user_id", "ts", "event_id", "value")
