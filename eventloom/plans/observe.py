"""Run metrics and the queries a dashboard asks of them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import PIPELINE_METRICS

# Dashboard thresholds (fixed values).
LAG_WARNING, LAG_CRITICAL = 3600, 7200
SUCCESS_WARNING, SUCCESS_GOOD = 90.0, 100.0


def rows_ingested(raw: DataFrame, day: date, hour: int | None = None) -> DataFrame:
    """Raw rows whose event time text falls on the day, or in one hour of it.

    A prefix test on the text, which reaches the scan.
    """
    prefix = day.isoformat()
    hit = F.col("created_at").startswith(prefix)
    if hour is not None:
        hit = F.col("created_at").startswith(f"{prefix}T{hour:02d}") | F.col(
            "created_at"
        ).startswith(f"{prefix} {hour:02d}")
    return raw.filter(hit).agg(F.count("*").alias("rows_ingested"))


def freshness(events: DataFrame, as_of: datetime, column: str = "event_at") -> DataFrame:
    """Seconds from the newest event to ``as_of``; 0 when there is no event."""
    lag = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.max(column))
    return events.agg(F.coalesce(lag, F.lit(0)).cast("int").alias("freshness_lag_seconds"))


def run_record(
    spark: SparkSession, run_id: str, logical_hour: datetime, rows: int, lag_seconds: int,
    passed: int, failed: int, duration_seconds: int, status: str, run_ts: datetime,
) -> DataFrame:
    row = (run_id, logical_hour, rows, lag_seconds, passed, failed, duration_seconds, status, run_ts)
    return spark.createDataFrame([row], PIPELINE_METRICS)


def total_rows(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.sum("rows_ingested").alias("value"))


def _latest(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("dag_run_timestamp"), F.desc("run_id")).limit(1)


def success_percent():
    passed, failed = F.col("dbt_tests_passed"), F.col("dbt_tests_failed")
    return passed.cast("double") / (passed + failed + F.lit(1e-5)) * 100


def latest_lag(metrics: DataFrame) -> DataFrame:
    return _latest(metrics).select(F.col("freshness_lag_seconds").alias("value"))


def latest_success(metrics: DataFrame) -> DataFrame:
    return _latest(metrics).select(success_percent().alias("value"))


def lag_series(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.col("dag_run_timestamp").alias("time"), F.col("freshness_lag_seconds").alias("freshness_lag")
    ).orderBy("time")


def volume_series(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.col("dag_run_timestamp").alias("time"), F.col("rows_ingested").alias("events_processed")
    ).orderBy("time")


def run_log(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.col("dag_run_timestamp").alias("run_time"), "run_id",
        F.col("rows_ingested").alias("rows"),
        F.col("freshness_lag_seconds").alias("freshness_lag_s"),
        F.col("duration_seconds").alias("duration_s"), "status",
    ).orderBy(F.desc("run_time"))


def run_status(metrics: DataFrame) -> DataFrame:
    """Threshold colour of each run's lag and test success.

    The epsilon in the percentage keeps a perfect run just under 100, so it is
    rounded before it is compared.
    """
    lag, success = F.col("freshness_lag_seconds"), F.round(success_percent(), 2)
    return metrics.select(
        "run_id", "dag_run_timestamp",
        F.when(lag >= LAG_CRITICAL, "red").when(lag >= LAG_WARNING, "yellow").otherwise("green")
        .alias("lag_status"),
        F.when(success >= SUCCESS_GOOD, "green")
        .when(success >= SUCCESS_WARNING, "yellow").otherwise("red")
        .alias("success_status"),
    )
