"""Tokens and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import bare, raw_words


def tokens(df: DataFrame, c: str) -> DataFrame:
    """One row per token: lowercase, split on white space, stripped of punctuation at both ends, not empty."""
    return df.select(F.explode(raw_words(c)).alias("raw")).select(bare("raw").alias("word")).where(F.col("word") != "")


def word_count(df: DataFrame, c: str) -> DataFrame:
    """Words and their counts; map tasks combine, so the shuffle moves one row per task and word."""
    return tokens(df, c).groupBy("word").agg(F.count("*").alias("n"))


def word_count_grouped(df: DataFrame, c: str, stable: Sequence[str], spread: int | None = None) -> DataFrame:
    """The same answer with every token moved before it is counted.

    The ``stable`` columns that name a text and the token's place in it spread a
    frequent word over ``spread`` groups, by default as many as shuffle partitions.
    """
    spread = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.hash(*stable, "place"), F.lit(spread))
    placed = df.select(*stable, F.posexplode(raw_words(c)).alias("place", "raw"))
    moved = placed.select(bare("raw").alias("word"), slot.alias("slot")).where(F.col("word") != "").repartition("word", "slot")
    per_slot = moved.groupBy("word", "slot").agg(F.count("*").alias("n"))
    return per_slot.groupBy("word").agg(F.sum("n").alias("n"))


def distinct_words(df: DataFrame, c: str, stable: Sequence[str]) -> DataFrame:
    """Number of distinct words by both routes; they must agree."""
    routes = {"combine": word_count(df, c), "grouped": word_count_grouped(df, c, stable)}
    parts = [
        counts.agg(F.count("*").alias("n_words")).select(F.lit(route).alias("route"), "n_words")
        for route, counts in routes.items()
    ]
    return parts[0].unionByName(parts[1])
