"""Drop alerts: a value well below the best of the last few of its entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import numbered
from millrace.session import stored


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """The keys that hold ``share`` of all rows or more: at most ``1 / share`` keys, so small enough to broadcast.

    By default a quarter of what a shuffle partition holds on average.
    """
    share = share or 0.25 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(key).alias("_hot_key")).agg(F.count("*").alias("_rows"))
    total = df.agg(F.count("*")).scalar()
    return counts.where(F.col("_rows") >= total * share).select("_hot_key")


def drops(
    df: DataFrame, entity: str, ts: str, seq: str, value: str, last: int = 10, fall: float = 3.0,
    share: float | None = None, slice_rows: int = 1_000_000, within: str | None = None,
) -> DataFrame:
    """Rows whose value is ``fall`` or more below the highest of the ``last - 1`` rows before, per entity by (ts, seq).

    Of these rows only those no older than ``within`` (an interval such as "2 days") count, if it is given.

    The rows of an entity with ``share`` of all rows or more (see ``hot_keys``) are numbered and cut into
    slices of ``slice_rows``, which run as separate groups; each starts with a
    copy of the last rows of the slice before.
    """
    back = last - 1
    if slice_rows < back:
        raise ValueError("a slice must hold the rows a window looks back on")
    rows = df.select(seq, ts, entity, value)
    hot = stored(hot_keys(df, entity, share), "hot_keys")
    is_hot = F.col(entity).eqNullSafe(F.col("_hot_key"))
    grouped = rows.withColumns({"_slice": F.lit(0).cast("long"), "_copy": F.lit(False)})
    if not hot.isEmpty():
        listed = F.broadcast(hot)
        placed = numbered(rows.join(listed, is_hot, "left_semi"), [F.col(ts), F.col(seq)], within=[entity], out="_pos")
        slice_of = F.floor(F.col("_pos") / slice_rows)
        own = placed.withColumns({"_slice": slice_of, "_copy": F.lit(False)})
        ends = placed.where(F.col("_pos") % slice_rows >= slice_rows - back)
        copies = ends.withColumns({"_slice": slice_of + 1, "_copy": F.lit(True)})
        cold = grouped.join(listed, is_hot, "left_anti")
        grouped = cold.unionByName(own.drop("_pos")).unionByName(copies.drop("_pos"))
    before = Window.partitionBy(entity, "_slice").orderBy(ts, seq).rowsBetween(-back, -1)
    highest = F.max(value).over(before)
    if within:
        recent = F.col(ts) - F.expr(f"INTERVAL {within}")
        rows_before = F.collect_list(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value"))).over(before)  # last - 1 at most
        highest = F.array_max(F.transform(F.filter(rows_before, lambda r: r.ts >= recent), lambda r: r.value))
    return (
        grouped.withColumn("prev_max", highest)
        .where(~F.col("_copy") & (F.col("prev_max") - F.col(value) >= fall))
        .select(seq, entity, "prev_max", value)
    )
