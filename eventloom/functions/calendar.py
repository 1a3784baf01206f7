"""Generated time axes: the hour grid of a feed and the date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default span of the date dimension (fixed values).
DATE_DIM_START = date(2024, 1, 1)
DATE_DIM_END = date(2027, 12, 31)


def _span(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    return spark.range(1).select(
        F.lit(str(start)).cast("date").alias("first_day"),
        F.lit(str(end)).cast("date").alias("last_day"),
    )


def span_of(df: DataFrame, day: Column) -> DataFrame:
    """First and last day found in ``df``, as the input of the generators."""
    return df.agg(F.min(day).cast("date").alias("first_day"), F.max(day).cast("date").alias("last_day"))


def hours_in(span: DataFrame, hour: int | None = None) -> DataFrame:
    """Every (date, hour) of the span, both days inclusive, with its file name."""
    grid = span.select(
        F.explode(F.expr(
            "sequence(cast(first_day as timestamp),"
            " cast(last_day as timestamp) + interval 23 hours, interval 1 hour)"
        )).alias("ts")
    ).select(
        F.to_date("ts").alias("feed_date"),
        F.hour("ts").alias("feed_hour"),
        # Feed files carry the hour without a leading zero.
        F.date_format("ts", "yyyy-MM-dd-H'.json.gz'").alias("file_name"),
    )
    return grid if hour is None else grid.filter(F.col("feed_hour") == hour)


def hour_grid(spark: SparkSession, start: date | str, end: date | str, hour: int | None = None) -> DataFrame:
    return hours_in(_span(spark, start, end), hour)


def days_in(span: DataFrame) -> DataFrame:
    """The date dimension over a span, one row per day, both ends inclusive."""
    days = span.select(
        F.explode(F.expr("sequence(first_day, last_day, interval 1 day)")).alias("date_day")
    )
    day_of_week = F.dayofweek("date_day") - 1  # Sunday = 0
    return days.select(
        F.col("date_day").alias("date_id"),
        "date_day",
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day"),
        day_of_week.alias("day_of_week"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        F.quarter("date_day").alias("quarter"),
        day_of_week.isin(0, 6).alias("is_weekend"),
    )


def dim_date(
    spark: SparkSession, start: date | str = DATE_DIM_START, end: date | str = DATE_DIM_END
) -> DataFrame:
    return days_in(_span(spark, start, end))
