"""Group-bys over a fact. All combine in the map task before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.facts import udf_filter
from millrace.operators.ranking import quantiles


def summary_by(df: DataFrame, key: str, value: str, avg_name: str = "avg_value") -> DataFrame:
    """Count and mean (one decimal) per key, busiest first; NULL is a key."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"), F.round(F.avg(value), 1).alias(avg_name))
        .orderBy(F.desc("n"), key)
    )


def full_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def average_of(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.avg(value).alias("avg_value"))


def filtered_count(df: DataFrame, keep: Column) -> DataFrame:
    return df.where(keep).agg(F.count("*").alias("n"))


def fast_sql(df: DataFrame, key: str, speed: str, spin: str, floor: float) -> DataFrame:
    """Count and mean spin per key among rows at or above ``floor``; as SQL text."""
    return df.sparkSession.sql(
        f"""
        SELECT {key}, count(*) AS n, avg({spin}) AS avg_spin
        FROM {{fact}}
        WHERE {speed} >= :floor
        GROUP BY {key}
        ORDER BY n DESC, {key}
        """,
        args={"floor": floor},
        fact=df,
    )


def fast_df(df: DataFrame, key: str, speed: str, spin: str, floor: float) -> DataFrame:
    """The same as DataFrame calls, on any source."""
    return _spin_by(df.where(F.col(speed) >= floor), key, spin)


def fast_udf(df: DataFrame, key: str, speed: str, spin: str, floor: float) -> DataFrame:
    """The same with the filter hidden in a Python function."""
    return _spin_by(udf_filter(df.select(key, speed, spin), speed, floor), key, spin)


def _spin_by(df: DataFrame, key: str, spin: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"), F.avg(spin).alias("avg_spin"))
        .orderBy(F.desc("n"), key)
    )


def fast_pairs(df: DataFrame, key: str, speed: str, spin: str, floor: float) -> DataFrame:
    """The same with the mean taken from (sum, count) pairs."""
    sums = [F.sum(spin).alias("_sum"), F.count(spin).alias("_filled"), F.count("*").alias("n")]
    pairs = df.where(F.col(speed) >= floor).groupBy(key).agg(*sums)
    return pairs.select(key, "n", F.try_divide("_sum", "_filled").alias("avg_spin"))


def workload(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias("avg_value"), F.count("*").alias("n"))


def in_month(month: int, folders: str | None = None) -> Column:
    """Rows of one month, all years together. In folders by date the month is asked of the date, so that folders are pruned."""
    return F.month(folders) == month if folders == "game_date" else F.col("game_month") == month


def month_count(spark: SparkSession, path: str, month: int, folders: str | None = None) -> DataFrame:
    """Rows of one month on any layout; ``folders`` names the column of its folders."""
    return filtered_count(spark.read.parquet(path), in_month(month, folders))


def entity_avg(spark: SparkSession, path: str, entity: str, value: str, ident: int) -> DataFrame:
    return average_of(spark.read.parquet(path).where(F.col(entity) == ident), value)


def frequent(df: DataFrame, key: str, n: int) -> DataFrame:
    """Keys with at least ``n`` rows, most frequent first."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= n).orderBy(F.desc("n"), key)


def freq_share(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their share of all rows. The total is a scalar subquery, not a window over all keys."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.select(key, "n", (F.col("n") / total).alias("share")).orderBy(F.desc("n"), key)


def cardinality(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Rows and distinct values per column; ``approx`` keeps a fixed-size sketch instead of the values."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(F.count("*").alias("n_rows"), *[count(F.col(c)).alias(f"distinct_{c}") for c in columns])


def day_sketches(df: DataFrame, day: str, columns: Sequence[str], precision: int = 12) -> DataFrame:
    """Rows and one mergeable distinct-count sketch a column for each day: a table to store and add to, a few KB a day."""
    return df.groupBy(day).agg(F.count("*").alias("n_rows"), *[F.hll_sketch_agg(c, precision).alias(f"sketch_{c}") for c in columns])


def united_counts(sketches: DataFrame, columns: Sequence[str], by: Sequence[Column] = ()) -> DataFrame:
    """Rows and distinct values of several days from their sketches; the rows behind them are not read again."""
    united = [F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(f"distinct_{c}") for c in columns]
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *united)


def day_values(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Rows per day and value of each column, NULL among the values: a table to store and add to that loses nothing.

    Values are kept as text, so that all columns share the table; it grows with the values of a day, not with its rows.
    """
    values = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(day, F.inline(F.array(*values))).groupBy(day, "column", "value").agg(F.count("*").alias("n_rows"))


def united_values(days: DataFrame, columns: Sequence[str], by: Sequence[Column] = ()) -> DataFrame:
    """Rows and exact distinct values of several days from their ``day_values``; a group's values spread over tasks before they are counted."""
    names = [f"_by{i}" for i in range(len(by))]
    values = days.select(*[c.alias(n) for c, n in zip(by, names)], "column", "value", "n_rows")
    once = values.groupBy(*names, "column", "value").agg(F.sum("n_rows").alias("n_rows"))
    of = lambda c, out: F.when(F.col("column") == c, F.col(out))
    counts = [F.count(of(c, "value")).alias(f"distinct_{c}") for c in columns]
    united = once.groupBy(*names).agg(F.sum(of(columns[0], "n_rows")).alias("n_rows"), *counts)
    return united.withColumnsRenamed(dict(zip(names, days.select(*by).columns)))


def table_ratio(a: DataFrame, b: DataFrame, floor: float = 3.0) -> DataFrame:
    """Rows of two tables, their ratio, and whether it is below ``floor``."""
    one = F.count("*").alias("n")
    both = (
        a.agg(one).select(F.col("n").alias("n_a"), F.lit(0).cast("long").alias("n_b"))
        .unionByName(b.agg(one).select(F.lit(0).cast("long").alias("n_a"), F.col("n").alias("n_b")))
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    )
    ratio = F.col("n_a") / F.greatest("n_b", F.lit(1))
    return both.select("n_a", "n_b", F.round(ratio, 1).alias("ratio"), (ratio < floor).alias("low"))


def two_stage(df: DataFrame, key: str, value: str, counted: str, middle: str) -> DataFrame:
    """Rows, mean, exact distinct ``counted`` values and exact median of ``middle`` per key; a hot key's values never meet in one task.

    Stage one groups by key and ``counted`` value, so a key's rows spread by the hash of that value; what is left of a key
    is one sum for each task. A median does not combine: its values are range-sorted (see ``quantiles``).
    """
    shares = df.groupBy(key, counted).agg(F.count("*").alias("_n"), F.sum(value).alias("_sum"), F.count(value).alias("_filled"))
    report = shares.groupBy(key).agg(
        F.sum("_n").alias("n"),
        F.try_divide(F.sum("_sum"), F.sum("_filled")).alias("avg_value"),
        F.count(counted).alias("distinct_values"),
    )
    medians = quantiles(df, key, middle, {"median_value": 0.5}).withColumnRenamed(key, "_key")
    return report.join(medians, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def five_number(df: DataFrame, key: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum of ``value`` per key, exact."""
    return quantiles(df, key, value, {"mn": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "mx": 1.0})


def replicate(df: DataFrame, n: int) -> DataFrame:
    """``n`` copies of every row, made in place."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy")
