"""Raw events and pitches to log records: entity, type, JSON value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed_values as fixed
from millrace.functions.columns import clean


def _records(fields: DataFrame) -> DataFrame:
    """(entity, type, value) of cleaned fields. They are cleaned in a step before, so each only once."""
    value = F.struct("id", "type", "actor", "repo", "created_at", "public", "payload_bytes")
    return fields.select(F.col("repo").alias("entity"), "type", F.to_json(value).alias("value"))


def trim_events(raw: DataFrame) -> DataFrame:
    """Nested events (see ``scan_events``) cut down to the fields consumers read, with defaults for missing ones."""
    fields = raw.select(
        clean(F.col("id"), fixed.NO_ID).alias("id"),
        clean(F.col("type"), fixed.NO_TYPE).alias("type"),
        clean(F.col("actor.login"), fixed.NO_ACTOR).alias("actor"),
        clean(F.col("repo.name"), fixed.NO_REPO).alias("repo"),
        clean(F.col("created_at"), fixed.NO_TIME).alias("created_at"),
        F.coalesce("public", F.lit(True)).alias("public"),
        F.octet_length(F.coalesce("payload", F.lit("{}"))).alias("payload_bytes"),
    )
    return _records(fields)


def pitch_events(
    pitches: DataFrame, game: str, kind: str, actor: str, date: str, ident: Sequence[str] = (), body: Sequence[str] | None = None
) -> DataFrame:
    """Pitch rows as events: the game is the entity, the pitch type the type.

    ``ident`` are the columns an id may come from, ``body`` those that count for the payload size.
    """
    repo = clean(F.col(game), fixed.NO_GAME)
    first_id = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in ident], F.lit(None).cast("string"))
    row = F.to_json(
        F.struct(*[F.col(c).cast("string").alias(c) for c in body or pitches.columns]), {"ignoreNullFields": "false"}
    )
    fields = pitches.select(
        clean(first_id, F.concat(repo, F.lit("-0"))).alias("id"),
        clean(F.col(kind), fixed.NO_PITCH_TYPE).alias("type"),
        clean(F.col(actor), fixed.NO_ACTOR).alias("actor"),
        repo.alias("repo"),
        F.concat(clean(F.col(date), fixed.NO_DATE), F.lit("T00:00:00Z")).alias("created_at"),
        F.lit(True).alias("public"),
        F.octet_length(row).alias("payload_bytes"),
    )
    return _records(fields)
