"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) to (node, root): every linked node and the smallest node it reaches.

    Each round points nodes at smaller neighbours and is written to the shared folder; the
    rounds grow with the logarithm of the longest path. Links of a node with itself
    and repeated links do no harm; null ends are left out.
    """
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(ends.distinct(), "links")
    state = _state(edges)
    while True:
        after = stored(_small_star(_large_star(edges)), "links")
        now = _state(after)
        if now == state:
            break
        edges, state = after, now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to its smallest one, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
