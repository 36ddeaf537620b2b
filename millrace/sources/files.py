"""Readers: CSV, Parquet, text, JSON events, replay files, and facts about stored files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.guards import MissingColumns, WrongHeader, require_rows

REPLAY_SCHEMA = "entity STRING, type STRING, value STRING"


def scan_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header row. The codec follows from the file suffix.

    ``infer=True`` costs one more pass over the data; production jobs declare
    ``schema``. Without either, every column is a string.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_text(spark: SparkSession, path: str, max_parts: int = 8, splits_per_task: int = 5) -> DataFrame:
    """Text lines in at most ``max_parts`` partitions.

    Large inputs get more: no task reads over ``splits_per_task`` file splits.
    """
    lines = spark.read.text(path)
    splits = lines.rdd.getNumPartitions()
    return lines.coalesce(max(max_parts, ceil(splits / splits_per_task)))


def parse_csv_lines(lines: DataFrame, schema: str, numeric: Sequence[str]) -> DataFrame:
    """Raw ``value`` lines to columns, honouring CSV quotes.

    Lines whose ``numeric`` fields are missing or are no numbers go, and with
    them repeated headers and short lines.
    """
    fields = T.StructType.fromDDL(schema).fields
    as_text = ", ".join(f"`{f.name}` STRING" for f in fields)
    row = lines.select(F.from_csv("value", F.lit(as_text)).alias("r"))
    typed = row.select(*[F.col(f"r.`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])
    return typed.dropna(subset=list(numeric))


def scan_events(spark: SparkSession, path: str) -> DataFrame:
    """One JSON event per line, plain or gzip: id, type, actor.login, repo.name, created_at, public, payload.

    Lines that are no JSON object are skipped; every other line is a row, whatever types its
    fields have and whichever columns are read. Values come as text, the payload as JSON text. ``public`` is
    NULL if the event lacks it, else whether its value is true, not zero or not empty; an explicit null is false.
    """
    event = spark.read.text(path).select(F.try_parse_json("value").alias("e"))
    objects = event.where(F.schema_of_variant("e").startswith("OBJECT"))
    field = lambda name, kind="string": F.try_variant_get("e", f"$.{name}", kind)
    public = field("public", "variant")
    kind = F.schema_of_variant(public)
    truth = (
        F.when(public.isNull(), F.lit(None).cast("boolean"))
        .when(F.is_variant_null(public), F.lit(False))
        .when(kind == "BOOLEAN", field("public", "boolean"))
        .when(kind == "STRING", F.length(field("public")) > 0)
        .otherwise(F.coalesce(field("public", "double") != 0, F.lit(True)))
    )
    return objects.select(
        field("id").alias("id"),
        field("type").alias("type"),
        F.struct(field("actor.login").alias("login")).alias("actor"),
        F.struct(field("repo.name").alias("name")).alias("repo"),
        field("created_at").alias("created_at"),
        truth.alias("public"),
        F.when(~F.is_variant_null(field("payload", "variant")), F.to_json(field("payload", "variant"))).alias("payload"),
    )


def scan_replay(spark: SparkSession, path: str) -> DataFrame:
    """Three tab-separated fields a line: entity, type, JSON value."""
    return (
        spark.read.schema(REPLAY_SCHEMA)
        .option("sep", "\t")
        .option("quote", "")
        .option("escape", "")
        .csv(path)
    )


def ingest_seasons(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | str,
    required: Sequence[str],
    min_rows: int,
) -> DataFrame:
    """Several CSV files with one header as one table, with a check of each header and a row floor.

    One job reads the headers of all files; those that lack a ``required`` column or differ from ``schema`` are named in the
    error. Columns are never taken by place.
    """
    names = T.StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames()
    odd = headers(spark, paths).where(~F.col("columns").eqNullSafe(F.array(*map(F.lit, names))))
    wrong = odd.orderBy("path").limit(20).collect()  # enough for a message
    for r in wrong:
        if lacking := set(required) - set(r["columns"]):
            raise MissingColumns(list(lacking), r["path"])
    if lacking := set(required) - set(names):
        raise MissingColumns(list(lacking))
    if wrong:
        raise WrongHeader([r["path"] for r in wrong])
    table = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(list(paths))
    return require_rows(table, min_rows)


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path and columns of every CSV file: its first line, found in one job over the files' first blocks."""
    block = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.text(list(paths)).select("value", *block).where("start = 0").withColumn("at", F.monotonically_increasing_id())
    first = lines.groupBy("file_path").agg(F.min_by("value", "at").alias("line"))
    return first.select(F.col("file_path").alias("path"), F.transform(F.split("line", ","), lambda c: F.btrim(c, F.lit('" \r'))).alias("columns"))


def count_uris(spark: SparkSession, uris: Mapping[str, str]) -> DataFrame:
    """Row count of each CSV location; only the address differs between them."""
    counts = [
        scan_csv(spark, uri).agg(F.count("*").alias("n_rows")).select(F.lit(label).alias("label"), "n_rows")
        for label, uri in uris.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def inline(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Literal rows as a table."""
    return spark.createDataFrame(list(rows), ddl)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def schema_of(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of filled values."""
    names = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                      F.col(f"`{i}`").alias("filled")) for i, f in enumerate(df.schema)]
    filled = df.agg(*[F.count(f"`{f.name}`").alias(str(i)) for i, f in enumerate(df.schema)])
    return filled.select(F.explode(F.array(*names)).alias("c")).select("c.*")


def _files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.load(path)


def path_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and stored bytes below a path. Only file lengths are read, never contents."""
    return (
        _files(spark, path)
        .agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .select(
            F.lit(path).alias("path"),
            "files",
            "bytes",
            F.round(F.col("bytes") / F.lit(1024 * 1024), 1).alias("mb"),
        )
    )


def file_names(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    return _files(spark, path, glob).select("path")
