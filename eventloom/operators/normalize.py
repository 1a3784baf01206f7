"""Feed messages to landing rows, and the split of rows that break the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.timeparse import ISO_FORMAT, hour_partition, parse_event_ts
from eventloom.schemas import CORRUPT, FEED_FIELDS, LANDING, MAX_LENGTHS


def normalize(df: DataFrame, on_bad_id: str = "drop", received_at: Column | None = None) -> DataFrame:
    """Landing rows (8 columns and the hour partition) from text-typed messages.

    ``on_bad_id="drop"`` is the batch rule: rows without a numeric id go, other
    members stay as sent.  ``"hash"`` is the stream rule: such rows get a key
    hashed from the whole message, so the same message always gets the same
    key, and absent members take their defaults.  ``received_at`` (the message
    timestamp) stands in for an absent event time, and for an unreadable one in
    the partition columns only.
    """
    if on_bad_id not in ("drop", "hash"):
        raise ValueError(f"on_bad_id must be 'drop' or 'hash', not {on_bad_id!r}")
    event_id = F.col("id").try_cast("bigint")
    event_type = F.col("type")
    is_public = F.col("public").try_cast("boolean")
    created_at = F.col("created_at")
    if on_bad_id == "hash":
        event_id = F.coalesce(event_id, F.xxhash64(*FEED_FIELDS))
        event_type = F.coalesce(event_type, F.lit("UnknownEvent"))
        is_public = F.coalesce(is_public, F.lit(True))
        created_at = F.when(F.length(created_at) > 0, created_at)
        if received_at is not None:
            created_at = F.coalesce(created_at, F.date_format(received_at, ISO_FORMAT))
    partition_ts = parse_event_ts(created_at)
    if received_at is not None:
        partition_ts = F.coalesce(partition_ts, received_at)
    rows = df.select(
        event_id.alias("id"),
        event_type.alias("type"),
        "actor", "repo", "org", "payload",
        is_public.alias("public"),
        created_at.alias("created_at"),
        partition_ts.alias("_ts"),
    )
    if on_bad_id == "drop":
        rows = rows.filter(F.col("id").isNotNull())
    return rows.select(
        *LANDING.names, *[c.alias(name) for name, c in hour_partition(F.col("_ts")).items()]
    )


def bad_row_reason() -> Column:
    """Why a landing row cannot enter the raw table; NULL for a good row."""
    limits = MAX_LENGTHS["raw_events"]
    reason = (
        F.when(F.col("id").isNull(), "id missing")
        .when(F.col("type").isNull(), "type missing")
        .when(F.col("created_at").isNull(), "created_at missing")
    )
    for name, limit in limits.items():
        reason = reason.when(F.length(name) > limit, f"{name} longer than {limit}")
    return reason


def quarantine_split(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with a ``reason``).

    The warehouse constraints are per row, so one bad row costs itself and not
    the whole load.
    """
    flagged = landing.withColumn("reason", bad_row_reason())
    good = flagged.filter(F.col("reason").isNull()).drop("reason")
    return good, flagged.filter(F.col("reason").isNotNull())


def split_corrupt(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable messages, unreadable message text)."""
    return (
        feed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
        feed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("message")),
    )

