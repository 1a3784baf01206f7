"""One row per key: the newest event, or the first row under a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recency(when: Column | None = None, **payload: Column) -> Column:
    """``max()`` of this entry carries the newest event's payload.

    Newest first; an event without a time outranks all others, and the event id
    settles equal times.  ``when`` limits the candidates.
    """
    entry = F.struct(
        F.col("event_at").isNull().alias("untimed"),
        F.col("event_at").alias("event_at"),
        F.col("event_id").alias("event_id"),
        *[column.alias(name) for name, column in payload.items()],
    )
    return entry if when is None else F.when(when, entry)


def latest_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The newest event's ``columns`` and ``event_at`` for each key.

    An aggregate and not a window: each map task folds its rows to one entry
    per key before the shuffle, so a key holding most of the table sends one
    entry per task.  NULL keys form one group.
    """
    newest = F.max(recency(**{c: F.col(c) for c in columns})).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *keys, *[f"_newest.{c}" for c in columns], "_newest.event_at"
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The whole first row of each key under ``order``.

    ``row_number() = 1`` is planned with a per-task limit before the shuffle,
    so repeated deliveries of one key do not travel.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
