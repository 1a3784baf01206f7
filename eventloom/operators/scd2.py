"""Type-2 history by comparing columns: closed versions and one open row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import stage_table
from eventloom.sources.paths import exists, version_path
from eventloom.sources.state import StateTable, bucketed
from eventloom.sources.tables import KEEP_VERSIONS

REPO_KEY = "repo_id"
REPO_CHECKS = ["repo_name", "primary_language", "description", "star_count_bucket"]


def _paired(
    current: DataFrame, incoming: DataFrame, key: str, checks: Sequence[str], how: str
) -> DataFrame:
    """Open rows beside incoming ones, with markers of which side is there.

    ``_same`` tells whether both are and agree in every check (NULL equals NULL).
    """
    have = current.select(
        F.lit(True).alias("_have"), *[F.col(c).alias(f"_old_{c}") for c in [key, *checks]],
        F.col("valid_from").alias("_old_from"),
    )
    come = incoming.select(F.lit(True).alias("_come"), key, *checks)
    both = have.join(come, F.col(f"_old_{key}").eqNullSafe(F.col(key)), how)
    # Presence comes from the markers: a row may be NULL in every check column.
    agree = reduce(
        lambda a, b: a & b, [F.col(f"_old_{c}").eqNullSafe(F.col(c)) for c in checks]
    )
    return both.withColumn("_same", F.col("_have").isNotNull() & F.col("_come").isNotNull() & agree)


def _versions(both: DataFrame, key: str, checks: Sequence[str], as_of: datetime) -> DataFrame:
    """The rows that each pair leaves behind."""
    run = F.lit(as_of).cast("timestamp")
    known, seen = F.col("_have").isNotNull(), F.col("_come").isNotNull()
    changed = known & seen & ~F.col("_same")
    restated = changed & (F.col("_old_from") >= run)

    def version(prefix: str, valid_from, valid_to):
        return F.struct(
            *[F.col(f"{prefix}{c}").alias(c) for c in [key, *checks]],
            valid_from.alias("valid_from"), valid_to.cast("timestamp").alias("valid_to"),
        )

    kept = F.when(known & ~restated, version("_old_", F.col("_old_from"), F.when(changed, run)))
    opened = F.when(
        seen & (~known | changed),
        version("", F.when(restated, F.col("_old_from")).otherwise(run), F.lit(None)),
    )
    return (
        both.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v")).select("v.*")
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def scd2_changes(
    current: DataFrame, incoming: DataFrame, key: str, checks: Sequence[str], as_of: datetime
) -> DataFrame:
    """Open rows after the run, plus the versions this run closes.

    ``current`` holds the open rows.  A key only in ``incoming`` opens; a key
    whose check columns differ (NULL equals NULL) closes and reopens; a key
    missing from ``incoming`` stays open.  A change seen at the very time the
    row opened corrects the row instead of leaving an empty interval.
    """
    return _versions(_paired(current, incoming, key, checks, "full_outer"), key, checks, as_of)


def scd2_merge(
    history: DataFrame, incoming: DataFrame, key: str, checks: Sequence[str], as_of: datetime
) -> DataFrame:
    """The whole history after merging ``incoming`` as of ``as_of``."""
    is_open = F.col("valid_to").isNull()
    changes = scd2_changes(history.filter(is_open), incoming, key, checks, as_of)
    closed = history.filter(~is_open).withColumn("is_current", F.lit(False))
    return closed.select(*changes.columns).unionByName(changes)


def history_schema(incoming: T.StructType, key: str, checks: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(c, incoming[c].dataType) for c in [key, *checks]]
        + [T.StructField(c, T.TimestampType()) for c in ("valid_from", "valid_to")]
    )


def _open_rows(root: str, schema: T.StructType, keep: int = KEEP_VERSIONS) -> StateTable:
    return bucketed(root, schema, schema.names[0], keep=keep)


def read_history(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All versions of a snapshot table.

    The open rows lie in buckets of keys below ``root``, of which a run rewrites those
    with a change; what run ``n`` closed lies in ``<root>_closed/v=<n>`` and counts once
    the run is committed.
    """
    table = _open_rows(root, schema)
    version = table.version(spark)
    is_open = table.read(spark).withColumn("is_current", F.lit(True))
    if not version or not exists(spark, f"{root}_closed/v=*"):
        return is_open
    on_disk = T.StructType([*schema.fields, T.StructField("v", T.IntegerType())])
    closed = spark.read.schema(on_disk).parquet(f"{root}_closed").filter(F.col("v") <= version).drop("v")
    return is_open.unionByName(closed.withColumn("is_current", F.lit(False)))


def snapshot_table(
    root: str, incoming: DataFrame, as_of: datetime,
    key: str = REPO_KEY, checks: Sequence[str] = REPO_CHECKS, keep: int = KEEP_VERSIONS,
) -> int:
    """Run one snapshot into the table at ``root``; returns its newest version.

    Open rows are read in the buckets of ``incoming`` and written in the buckets with a
    new or changed key only; versions closed by earlier runs are neither read nor
    rewritten.  Without a change nothing is written.  The run is visible once its folder
    is committed; a failed run is overwritten by the next attempt.  Buckets of runs
    before the newest ``keep`` go when a later run has rewritten them.
    """
    spark = incoming.sparkSession
    schema = history_schema(incoming.schema, key, checks)
    table = _open_rows(root, schema, keep)
    version = table.version(spark) + 1
    come = stage_table(incoming.select(key, *checks), "incoming")
    current = table.read(spark, table.values_in(come))
    changed = stage_table(_paired(current, come, key, checks, "right_outer").filter(~F.col("_same")), "changed")
    touched = table.values_in(changed)
    if not touched:
        return version - 1
    rows = _versions(changed, key, checks, as_of)
    rows.filter(~F.col("is_current")).drop("is_current").write.mode("overwrite").parquet(
        version_path(f"{root}_closed", version)
    )
    again = changed.select(F.col(key).alias("_again"))
    kept = table.read(spark, touched).join(again, F.col(key).eqNullSafe(F.col("_again")), "left_anti")
    return table.write(kept.unionByName(rows.filter("is_current").drop("is_current")), version)
