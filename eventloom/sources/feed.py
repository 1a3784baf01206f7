"""Hourly feed files and the landing table they become."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.calendar import hour_grid
from eventloom.schemas import (
    CORRUPT, FEED, FEED_FIELDS, FEED_WITH_CORRUPT, HOUR_PARTITIONS, LANDING,
)
from eventloom.sources.paths import exists, list_files

# Read partition values as numbers: ``month=8`` and ``month=08`` are one month.
LANDING_ON_DISK = T.StructType(
    LANDING.fields + [T.StructField(name, T.IntegerType()) for name in HOUR_PARTITIONS]
)


def feed_files(spark: SparkSession, feed_dir: str, start, end, hour: int | None = None) -> list[str]:
    """Paths of the feed files that exist for the requested hours."""
    wanted = [row.file_name for row in hour_grid(spark, start, end, hour).collect()]
    present = list_files(spark, f"{feed_dir}/*.json.gz")
    return [present[name] for name in wanted if name in present]


def json_object(text: Column, schema: T.StructType) -> Column:
    """The members of ``text`` if it is exactly one JSON object, else NULL.

    Parsed as the only element of an array, because Spark's parser stops after
    the first value and would accept whatever follows it.
    """
    return _only(text, _values(text, schema))


def _values(text: Column, schema: T.StructType) -> Column:
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    return F.from_json(wrapped, T.ArrayType(schema), {"allowSingleQuotes": "false"})


def _only(text: Column, values: Column) -> Column:
    return F.when(text.rlike(r"^\s*\{") & (F.size(values) == 1), values[0])


def decode(messages: DataFrame, value: Column) -> DataFrame:
    """Messages carried as bytes or text, parsed into :data:`FEED_WITH_CORRUPT`.

    Bytes that are not UTF-8 and text that is not one JSON object end up in
    ``_corrupt``.  Other columns of ``messages`` are kept.
    """
    text = F.try_validate_utf8(value.cast("string"))
    parsed = messages.withColumn("_values", _values(text, FEED))
    # One row each way: a filter on ``_corrupt`` stays above the explode, while it would
    # take copies of the parser below a projection and parse every message again.
    parsed = parsed.withColumn("_message", F.explode(F.array(_only(text, F.col("_values")))))
    return parsed.select(
        *[F.col(f"_message.{name}") for name in FEED_FIELDS],
        F.when(
            F.col("_message").isNull(), F.coalesce(text, F.base64(value.cast("binary")))
        ).alias(CORRUPT),
        *[c for c in messages.columns if c != "value"],
    )


def read_feed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Messages of the given JSON-lines files, unreadable lines in ``_corrupt``.

    Only the named files are read, never a whole folder.  A gzip file is one
    task; the writer rebalances afterwards.  Blank lines are no messages.
    """
    if not paths:
        return spark.createDataFrame([], FEED_WITH_CORRUPT)
    lines = spark.read.text(list(paths)).filter(F.length(F.trim("value")) > 0)
    return decode(lines, F.col("value"))


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    if not exists(spark, f"{root}/year=*"):
        return spark.createDataFrame([], LANDING_ON_DISK)
    return (
        spark.read.schema(LANDING_ON_DISK)
        .option("basePath", root).option("pathGlobFilter", "*.parquet")
        .parquet(root)
    )


def hour_key() -> Column:
    """The four partition values as one comparable number."""
    return (
        F.col("year") * 1000000 + F.col("month") * 10000 + F.col("day") * 100 + F.col("hour")
    )


def read_landing_hour(
    spark: SparkSession, root: str, year: int, month: int, day: int, hour: int
) -> DataFrame:
    """One landed hour, by partition pruning; no rows when nothing landed."""
    return read_landing(spark, root).filter(
        (F.col("year") == year) & (F.col("month") == month)
        & (F.col("day") == day) & (F.col("hour") == hour)
    )


def land_batch(landing: DataFrame, root: str, hours: tuple[int, int] | None = None) -> None:
    """Append landing rows below ``root``, partitioned by event hour.

    ``hours`` is the span of :func:`hour_key` values being ingested.  Rows of
    those hours that an earlier attempt already landed are left out, so a
    replay adds nothing.  Nothing is overwritten: a file may hold events of a
    neighbouring hour, and the stream lands in the same folders.
    """
    spark = landing.sparkSession
    rows = landing
    if hours and exists(spark, f"{root}/year=*"):
        landed = read_landing(spark, root).filter(hour_key().between(*hours)).select("id")
        rows = rows.join(landed, "id", "left_anti")
    # Adaptive execution splits an hour that holds most rows and merges small ones.
    rows.hint("rebalance", *HOUR_PARTITIONS).write.mode("append").partitionBy(
        *HOUR_PARTITIONS
    ).parquet(root)
