"""Column expressions shared by the operators. All stay in the JVM but ``at_least_udf``."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the punctuation a token loses at both ends.
TOKEN_EDGES = ".,;:!?\"'()"

# All white space that text functions strip.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def row_order(df: DataFrame, first: Sequence[str] = ()) -> list[Column]:
    """A total order: ``first``, then every other column."""
    return [F.col(c) for c in [*first, *[c for c in df.columns if c not in first]]]


def not_blank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(c) != "")


def clean(c: Column, fallback: Column | str) -> Column:
    """A key on one line without tabs; the fallback where nothing is left."""
    one_line = c.cast("string")
    for mark in "\t\n\r":
        one_line = F.replace(one_line, F.lit(mark), F.lit(" "))
    return F.coalesce(F.nullif(F.btrim(one_line, F.lit(BLANKS)), F.lit("")), F.lit(fallback))


def raw_words(c: str) -> Column:
    """Lowercase, split on white space."""
    return F.split(F.lower(c), r"(?U)\s+")


def bare(word: str) -> Column:
    """A word without the punctuation at its ends; may be empty."""
    return F.btrim(F.col(word), F.lit(TOKEN_EDGES))


def salt(stable: Sequence[str], n: int | Column) -> Column:
    """A number below ``n`` from columns that identify a row: a task that runs again draws the same one, unlike ``rand()``."""
    return F.pmod(F.xxhash64(*stable), n if isinstance(n, Column) else F.lit(n)).cast("int")


def hash_partition(c: str, n: int) -> Column:
    """The partition that ``repartition(n, c)`` would send the row to."""
    return F.pmod(F.hash(F.col(c)), F.lit(n))


def at_least_udf(floor: float):
    """``value >= floor`` as a Python function: Spark cannot look inside, so nothing is pushed to the scan."""

    @F.pandas_udf("boolean")
    def at_least(v: pd.Series) -> pd.Series:
        return v.ge(floor)

    return at_least
