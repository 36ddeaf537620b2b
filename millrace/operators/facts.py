"""Typed fact, plate-appearance fact, dimensions, row filters and dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import fixed_values as fixed
from millrace.functions.columns import at_least_udf, not_blank, row_order
from millrace.operators.joins import checked_broadcast
from millrace.sources.files import inline
from millrace.sources.guards import require_columns


def with_dates(df: DataFrame, c: str, date: str = "game_date", month: str = "game_month") -> DataFrame:
    return df.withColumn(date, F.to_date(c)).withColumn(month, F.month(F.to_date(c)))


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The first row of each key in ``order``, by default that of all other columns.

    Spark limits each task to one row per key before the shuffle, so copies of a
    hot key never meet in one task.
    """
    rest = order or [F.col(c) for c in df.columns if c not in keys] or [F.lit(1)]
    first = Window.partitionBy(*keys).orderBy(*rest)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).where(F.col(c).isNotNull()).distinct()


def classify(df: DataFrame, code: str, labels: Sequence[tuple[str, str, str]] | DataFrame, label: str, family: str) -> DataFrame:
    """Add label and family of a code; codes not listed are ``Unclassified (code)``, ``other``.

    ``labels`` are literal rows or a stored table of code, label and family, of any size.
    """
    if not isinstance(labels, DataFrame):
        labels = inline(df.sparkSession, labels, "_code STRING, _label STRING, _family STRING")
    lookup = checked_broadcast(labels.toDF("_code", label, family))
    joined = df.join(lookup, F.col(code) == F.col("_code"), "left").drop("_code")
    unknown = F.concat(F.lit("Unclassified ("), F.col(code), F.lit(")"))
    return joined.withColumns(
        {label: F.coalesce(label, unknown), family: F.coalesce(F.col(family), F.lit("other"))}
    )


def udf_filter(df: DataFrame, c: str, floor: float) -> DataFrame:
    """Rows at or above ``floor``, tested in Python; see ``at_least_udf``."""
    return df.where(at_least_udf(floor)(F.col(c)))


def teams_dim(spark: SparkSession) -> DataFrame:
    return inline(spark, fixed.TEAMS, "team STRING, league STRING, division STRING")


def pitch_type_dim(fact: DataFrame) -> DataFrame:
    codes = distinct_values(fact, "pitch_type")
    return classify(codes, "pitch_type", fixed.PITCH_TYPES, "pitch_label", "pitch_family")


def outcome_dim(fact: DataFrame, c: str = "events", outs: str = fixed.OUT_PATTERN, hits: Sequence[str] = tuple(fixed.HITS)) -> DataFrame:
    """Outcome codes with ``is_out`` and ``is_hit``; no NULL key."""
    return distinct_values(fact, c).select(
        c, F.col(c).rlike(outs).alias("is_out"), F.col(c).isin(*hits).alias("is_hit")
    )


def terminal_rows(fact: DataFrame, outcome: str, keys: Sequence[str], wanted: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """One row per key among the rows that carry an outcome, with those of the wanted columns that there are."""
    require_columns(fact, [outcome, *keys, *required])
    return dedup(keep_existing(fact.where(F.col(outcome).isNotNull()), wanted), keys)


def plate_appearances(fact: DataFrame) -> DataFrame:
    """One row per (game, at-bat) among the rows that carry an outcome."""
    return terminal_rows(fact, "events", ["game_pk", "at_bat_number"], fixed.PLATE_APPEARANCE_COLUMNS, ["batter", "home_team"])


def build_corpus(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Texts that are not blank, one per key."""
    require_columns(df, [text, *keys])
    kept = df.select(*keys, text).where(not_blank(text))
    return dedup(kept, keys, row_order(kept.select(text))).select(text)
