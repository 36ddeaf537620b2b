"""Session helper for tests and benches, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.storage import remove

_local_dir: str | None = None
_on_the_way: list[list[str]] = []  # paths that ``stored`` has written within each ``stored_alone`` at work

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """A single-machine session; a cluster passes its own session to every function instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Tables written there outlive lost executors. Only a local session without
    the setting falls back to a temporary folder of this machine.
    """
    global _local_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        _local_dir = _local_dir or tempfile.mkdtemp(prefix="millrace-")
        base = _local_dir
    return f"{base.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Pins whatever the plan computed (chunk ids, row positions), so a task that is
    run again sees the same rows, and gives the planner real table sizes. Its shuffle files go once the table is
    written; nothing reads them again.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    if _on_the_way:
        _on_the_way[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(build: Callable[[], DataFrame], label: str = "stage") -> DataFrame:
    """``stored`` of what ``build`` returns; the tables stored on the way there are removed, as the result does not need them."""
    _on_the_way.append([])
    try:
        made = build()
        paths = list(_on_the_way[-1])
    finally:
        _on_the_way.pop()
    out = stored(made, label)
    for path in paths:
        remove(made.sparkSession, path)
    return out
