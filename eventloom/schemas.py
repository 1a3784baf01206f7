"""Table contracts.  Names and types are fixed values shared with consumers."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Feed messages.  Every member is declared as text, so a nested object arrives
# as JSON text and a quoted number is not lost to a typed parse.
FEED_FIELDS = ["id", "type", "actor", "repo", "org", "payload", "public", "created_at"]
FEED = T.StructType([T.StructField(name, T.StringType()) for name in FEED_FIELDS])
FEED_WITH_CORRUPT = T.StructType(FEED.fields + [T.StructField(CORRUPT, T.StringType())])

HOUR_PARTITIONS = ["year", "month", "day", "hour"]


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "date": T.DateType(),
}


def _table(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    # Spark's own DDL parser needs a running session, which imports must not.
    pairs = [entry.split() for entry in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n not in required) for n, t in pairs])


LANDING = _table(
    "id bigint, type string, actor string, repo string, org string, payload string,"
    " public boolean, created_at string"
)
RAW_EVENTS = _table(
    "id bigint, type string, actor string, repo string, org string, payload string,"
    " public boolean, created_at string, loaded_at timestamp",
    required=("id", "type", "created_at"),
)
PIPELINE_METRICS = _table(
    "run_id string, dag_run_timestamp timestamp, rows_ingested bigint,"
    " freshness_lag_seconds int, dbt_tests_passed int, dbt_tests_failed int,"
    " duration_seconds int, status string, run_timestamp timestamp",
    required=("run_id", "dag_run_timestamp", "rows_ingested", "status"),
)
DETECTED_ANOMALIES = _table(
    "repo_id bigint, repo_name string, ds date, y double, yhat_lower double,"
    " yhat_upper double, anomaly_score double, run_timestamp timestamp",
    required=("repo_id", "repo_name", "ds", "y", "yhat_lower", "yhat_upper", "anomaly_score"),
)
DIM_REPO = _table(
    "repo_id bigint, repo_name string, primary_language string, description string,"
    " star_count_bucket string, valid_from timestamp, valid_to timestamp, is_current boolean"
)

# Text length limits of the warehouse columns (fixed values).
MAX_LENGTHS = {
    "raw_events": {"type": 50, "created_at": 30},
    "pipeline_metrics": {"run_id": 100, "status": 20},
    "detected_anomalies": {"repo_name": 255},
}
