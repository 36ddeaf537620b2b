"""Queries on sources and guards."""

from pyspark.sql import functions as F

from millrace.plans import inputs
from millrace.plans.registry import query, staged, table
from millrace.sources import files
from millrace.sources.footers import parquet_footers
from millrace.sources.guards import materialise


@query("scan_csv_inferred", inputs.LINEITEM_SQL)
def scan_csv_inferred(spark, data):
    return inputs.with_ship_date(files.scan_csv(spark, inputs.lineitem_csv(spark, data), infer=True)).withColumns(
        {c: F.col(c).cast("long") for c in ("l_orderkey", "l_partkey", "l_suppkey")}
    )


@query(
    "scan_csv_strings",
    """
SELECT l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey, l_suppkey::VARCHAR AS l_suppkey,
       l_linenumber::VARCHAR AS l_linenumber, l_quantity::VARCHAR AS l_quantity,
       l_extendedprice::VARCHAR AS l_extendedprice, l_discount::VARCHAR AS l_discount, l_tax::VARCHAR AS l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000') AS l_shipdate
FROM lineitem
""",
)
def scan_csv_strings(spark, data):
    return files.scan_csv(spark, inputs.lineitem_csv(spark, data))


@query("scan_csv_schema", inputs.LINEITEM_SQL)
def scan_csv_schema(spark, data):
    return inputs.with_ship_date(
        files.scan_csv(spark, inputs.lineitem_csv(spark, data), schema=inputs.LINEITEM_DDL)
    )


@query("scan_csv_gzip", inputs.LINEITEM_SQL)
def scan_csv_gzip(spark, data):
    return inputs.with_ship_date(
        files.scan_csv(spark, inputs.lineitem_csv_gzip(spark, data), schema=inputs.LINEITEM_DDL)
    )


@query("scan_parquet", inputs.LINEITEM_SQL)
def scan_parquet(spark, data):
    return inputs.with_ship_date(table(spark, data, "lineitem"))


@query(
    "scan_text_lines",
    """
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line
""",
)
def scan_text_lines(spark, data):
    lines = files.scan_text(spark, inputs.corpus(spark, data))
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query(
    "scan_quoted_text",
    """
SELECT p_partkey, split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) AS p_name, p_type, p_size,
       p_retailprice
FROM part
""",
)
def scan_quoted_text(spark, data):
    def build(path):
        p = table(spark, data, "part")
        name = F.format_string('"%s, %s"', F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1)))
        line = F.concat_ws(",", "p_partkey", name, "p_type", "p_size", "p_retailprice")
        no_number = F.when(F.col("p_partkey") % 10 == 0, F.concat_ws(",", "p_partkey", name, "p_type", "p_size", F.lit("n/a")))
        short = F.when(F.col("p_partkey") % 15 == 0, F.concat_ws(",", "p_partkey", name))
        header = F.when(F.col("p_partkey") % 100 == 0, F.lit("p_partkey,p_name,p_type,p_size,p_retailprice"))
        lines = p.select(F.explode(F.array(line, no_number, short, header)).alias("value"))
        lines.where("value IS NOT NULL").write.text(path)

    lines = files.scan_text(spark, staged(spark, data, "part_lines", build))
    schema = "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    return files.parse_csv_lines(lines, schema, numeric=["p_partkey", "p_retailprice"])


@query(
    "scan_ndjson_events",
    """
SELECT event_id::VARCHAR AS id, CASE WHEN event_id % 11 <> 0 THEN event_type END AS type,
       CASE WHEN event_id % 13 <> 0 AND event_id % 37 <> 0 THEN 'user-' || user_id END AS login,
       CASE WHEN event_id % 17 <> 0 THEN 'org' || (user_id % 7) || '/repo' || chr(9) || user_id END AS repo,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
       CASE WHEN event_id % 23 <> 0 THEN replace(props, ' ', '') END AS payload
FROM events
""",
)
def scan_ndjson_events(spark, data):
    raw = files.scan_events(spark, inputs.raw_events(spark, data))
    return raw.select("id", "type", F.col("actor.login").alias("login"), F.col("repo.name").alias("repo"), "created_at", "payload")


@query("scan_topic_tsv", inputs.TRIMMED_SQL)
def scan_topic_tsv(spark, data):
    return files.scan_replay(spark, inputs.replay_file(spark, data))


@query(
    "scan_any_uri",
    "SELECT 'plain' AS label, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'scheme', count(*) FROM lineitem",
)
def scan_any_uri(spark, data):
    path = inputs.lineitem_csv(spark, data)
    return files.count_uris(spark, {"plain": path, "scheme": f"file://{path}" if path.startswith("/") else path})


@query("ingest_many_csv", inputs.LINEITEM_SQL)
def ingest_many_csv(spark, data):
    def build(path):
        li = table(spark, data, "lineitem")
        early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
        li.where(early).write.option("header", True).csv(f"{path}/early")
        li.where(~early).write.option("header", True).csv(f"{path}/late")

    path = staged(spark, data, "seasons", build)
    both = files.ingest_seasons(
        spark, [f"{path}/early", f"{path}/late"], inputs.LINEITEM_DDL, ["l_orderkey", "l_quantity"], min_rows=1
    )
    return inputs.with_ship_date(both)


@query(
    "inline_dim",
    """
SELECT flag, meaning, count(*) AS n
FROM lineitem JOIN (VALUES ('A', 'accepted'), ('N', 'new'), ('R', 'returned')) d(flag, meaning) ON l_returnflag = flag
GROUP BY flag, meaning
""",
)
def inline_dim(spark, data):
    dim = files.inline(spark, [("A", "accepted"), ("N", "new"), ("R", "returned")], "flag STRING, meaning STRING")
    li = table(spark, data, "lineitem")
    joined = li.join(F.broadcast(dim), li.l_returnflag == dim.flag)  # three literal rows
    return joined.groupBy("flag", "meaning").agg(F.count("*").alias("n"))


@query("sample_rows", "SELECT least(count(*), 10) AS n, least(count(*), 10) AS in_table FROM lineitem")
def sample_rows(spark, data):
    """Which rows come first is the reader's choice; how many, and that all are rows of the table, is not."""
    li = table(spark, data, "lineitem")
    sample = files.first_rows(li, 10)
    known = sample.join(li.distinct(), li.columns, "left_semi").agg(F.count("*")).scalar()
    return sample.agg(F.count("*").alias("n"), known.alias("in_table"))


LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query(
    "schema_table",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS name, '{t}' AS type, count({c}) AS filled FROM lineitem"
        for i, (c, t) in enumerate(LINEITEM_TYPES.items())
    ),
)
def schema_table(spark, data):
    return files.schema_of(table(spark, data, "lineitem"))


@query("path_size")
def path_size(spark, data):
    return files.path_size(spark, data)


@query("parquet_footers")
def footers(spark, data):
    return parquet_footers(spark, data)


@query("materialise_once", inputs.outcomes_sql())
def materialise_once(spark, data):
    path = staged(spark, data, "built_once", lambda p: None)
    source = inputs.outcomes(spark, data)
    return materialise(spark, lambda: spark.read.parquet(source), path)
