"""Positions, top-k and exact quantiles without a group ever sitting in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a task in the low 33 bits


def top_k(df: DataFrame, k: int, order: Sequence[Column], out: str = "pos") -> DataFrame:
    """The first ``k`` rows in ``order``, numbered from 1. Each task keeps ``k`` rows at most."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("long"))


def numbered(df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), out: str = "pos") -> DataFrame:
    """0-based position of every row inside its ``within`` group.

    ``order`` must be total. Rows are range-partitioned on group and order, so a
    hot group spreads over many tasks; the sorted rows are stored once, and a
    small table of (task, group) counts turns row numbers into positions.
    """
    keys = [*[F.col(c) for c in within], *order]
    runs_sorted = stored(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id()),
        "numbered",
    )
    rows = runs_sorted.withColumn("_chunk", F.shiftright("_id", _ROW_BITS)).withColumn(
        "_idx", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    runs = rows.groupBy("_chunk", *within).agg(F.min("_idx").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Stored, so that its size is known and a small one is broadcast before the rows are shuffled.
    shifts = stored(
        runs.select(
            F.col("_chunk").alias("_c"),
            *[F.col(c).alias(f"_g_{c}") for c in within],
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        "shifts",
    )
    match = reduce(
        and_, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in within], F.col("_chunk") == F.col("_c")
    )
    return rows.join(shifts, match).select(*df.columns, (F.col("_idx") + F.col("_shift")).alias(out))


def quantiles(df: DataFrame, key: str, value: str, fractions: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per ``key``; ``fractions`` maps output name to fraction.

    Equal values are counted first, the (key, value) pairs sorted by range and
    stored, and only the tasks that hold a wanted rank are searched. A NULL key
    is a key; NULL values do not count.
    """
    pairs = df.where(F.col(value).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(value).alias("_v")).agg(
        F.count("*").alias("_n")
    )
    chunks = stored(
        pairs.repartitionByRange("_k", "_v").withColumn("_chunk", F.spark_partition_id()), "quantiles"
    )
    per_key = Window.partitionBy("_k")
    totals = (
        chunks.groupBy("_k", "_chunk")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_total", F.sum("_in").over(per_key))
        .withColumn(
            "_base",
            F.coalesce(
                F.sum("_in").over(per_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
    )
    ranks = []
    for name, p in fractions.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        for rank, weight in ((F.floor(at), F.floor(at) + 1 - at), (F.floor(at) + 1, at - F.floor(at))):
            ranks.append(F.struct(F.lit(name).alias("name"), rank.alias("rank"), weight.alias("weight")))
    wanted = stored(  # its size is known then, see numbered
        totals.withColumn("_w", F.explode(F.array(*ranks)))
        .where(
            (F.col("_w.weight") > 0)
            & (F.col("_w.rank") >= F.col("_base"))
            & (F.col("_w.rank") < F.col("_base") + F.col("_in"))
        )
        .groupBy(F.col("_k").alias("_wk"), F.col("_chunk").alias("_wc"), "_base")
        .agg(F.collect_list("_w").alias("_ws")),  # two ranks per fraction at most
        "ranks",
    )
    inside = Window.partitionBy("_k", "_chunk").orderBy("_v")
    hits = (
        chunks.join(wanted, F.col("_k").eqNullSafe(F.col("_wk")) & (F.col("_chunk") == F.col("_wc")))
        .withColumn("_to", F.col("_base") + F.sum("_n").over(inside))
        .withColumn(
            "_w", F.explode(F.filter("_ws", lambda w: (w.rank >= F.col("_to") - F.col("_n")) & (w.rank < F.col("_to"))))
        )
    )
    part = F.col("_v") * F.col("_w.weight")
    return hits.groupBy(F.col("_k").alias(key)).agg(
        *[F.sum(F.when(F.col("_w.name") == name, part)).alias(name) for name in fractions]
    )
