"""Queries on sinks: each writes, reads back and returns what it read."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import inputs
from millrace.plans.registry import query, table
from millrace.session import shared_path
from millrace.sources import layout


@query("sink_parquet", inputs.LINEITEM_SQL)
def sink_parquet(spark, data):
    path = shared_path(spark, "sink_parquet")
    layout.write_table(table(spark, data, "lineitem"), path)
    return inputs.with_ship_date(spark.read.parquet(path))


@query(
    "sink_codecs",
    """
SELECT f.format, count(*) AS rows, 4::BIGINT AS files, true AS smaller
FROM lineitem, (VALUES ('csv_gzip'), ('parquet_none'), ('parquet_snappy'), ('parquet_gzip'), ('parquet_zstd')) f(format) GROUP BY f.format
""",
)
def sink_codecs(spark, data):
    """Sizes depend on the writers' versions; that each format is smaller than plain CSV does not."""
    sweep = layout.codec_sweep(table(spark, data, "lineitem"), shared_path(spark, "sink_codecs"))
    return sweep.select("format", "rows", "files", (F.col("ratio") > 1).alias("smaller"))


@query(
    "sink_file_counts",
    "SELECT f.files, count(*) AS n FROM lineitem, (VALUES (4), (400)) f(files) GROUP BY f.files",
)
def sink_file_counts(spark, data):
    li = table(spark, data, "lineitem")
    path = shared_path(spark, "sink_file_counts")
    counts = []
    # the few files are joined from the many: those are alike in size, so that none of the few gets more than its share
    for n, rows, shuffle in ((400, lambda: li, True), (4, lambda: spark.read.parquet(f"{path}/400"), False)):
        layout.write_files(rows(), f"{path}/{n}", n, shuffle)
        counts.append(
            spark.read.parquet(f"{path}/{n}").agg(F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("n"))
        )
    return reduce(DataFrame.unionByName, counts)


@query("sink_flat", inputs.LINEITEM_SQL)
def sink_flat(spark, data):
    flat = spark.read.parquet(inputs.flat_fact(spark, data))
    return inputs.with_ship_date(flat.drop("game_date", "game_month"))


@query("sink_by_month", "SELECT month(l_shipdate)::INT AS game_month, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1")
def sink_by_month(spark, data):
    monthly = spark.read.parquet(inputs.monthly_fact(spark, data))
    return monthly.groupBy("game_month").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "sink_by_date",
    """
SELECT strftime(ts, '%Y-%m-%d') AS game_date, count(*) AS n,
       (SELECT count(DISTINCT ts::DATE) FROM events) AS folders
FROM events GROUP BY 1
""",
)
def sink_by_date(spark, data):
    path = shared_path(spark, "sink_by_date")
    dated = table(spark, data, "events").withColumn("game_date", F.to_date("ts"))
    layout.write_partitioned(dated, path, ["game_date"])
    back = spark.read.parquet(path)
    folders = layout.folder_count(back, ["game_date"]).scalar()
    return (
        back.groupBy("game_date")
        .agg(F.count("*").alias("n"))
        .select(F.date_format("game_date", "yyyy-MM-dd").alias("game_date"), "n", folders.alias("folders"))
    )


@query(
    "sink_text",
    "SELECT count(*) AS lines, sum(length(line))::BIGINT AS chars FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)",
)
def sink_text(spark, data):
    path = shared_path(spark, "sink_text")
    layout.write_text(table(spark, data, "documents").select("text"), path)
    return spark.read.text(path).agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


@query("sink_small_dim", inputs.outcomes_sql())
def sink_small_dim(spark, data):
    return spark.read.parquet(inputs.outcomes(spark, data))


@query("small_files_corpus", inputs.LINEITEM_SQL + """
ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate
LIMIT 5000
""")
def small_files_corpus(spark, data):
    path = shared_path(spark, "small_files_corpus")
    layout.split_small(table(spark, data, "lineitem"), 5000, 500, path)
    return inputs.with_ship_date(spark.read.schema(inputs.LINEITEM_DDL).option("header", True).csv(path))
