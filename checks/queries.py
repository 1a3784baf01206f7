"""Every operator as a query over the test tables.

Each takes (spark, sf_dir), works on whole tables and returns a DataFrame.
Steps that write do so below the session's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.feed import LOADED_AT, feed, landing, raw_events, staged
from eventloom.functions.calendar import days_in, hours_in, span_of
from eventloom.operators.anomaly import anomalies, series
from eventloom.operators.latest import latest_per_key
from eventloom.operators.load import RawTable, delivery_order, insert_if_absent, load_batch, near_keys
from eventloom.operators.normalize import normalize, split_corrupt
from eventloom.operators.ranking import global_rank, top_k_with_ties
from eventloom.operators.scd2 import (
    REPO_CHECKS, REPO_KEY, history_schema, read_history, scd2_merge, snapshot_table,
)
from eventloom.plans import marts, observe, quality, rollups, staging
from eventloom.plans.incremental import ACTOR_DAYS, ACTOR_TOTALS, REPO_DAYS, REPO_TOTALS, Models
from eventloom.plans.pipeline import Lake, ingest_hours, load_landed, run_hour
from eventloom.plans.staging import EVENT_VIEWS, stage, stg_raw_events
from eventloom.schemas import DETECTED_ANOMALIES, FEED_FIELDS, MAX_LENGTHS, PIPELINE_METRICS
from eventloom.session import pin, scratch_path, stage_table
from eventloom.sources.feed import land_batch, read_feed, read_landing, read_landing_hour
from eventloom.sources.paths import glob_paths, list_files, move
from eventloom.sources.tables import read_table, split_by_contract
from eventloom.operators.load import RAW_ON_DISK
from eventloom.streaming import streams

AS_OF = datetime(2024, 2, 1)
SNAPSHOTS = [datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2024, 1, 31)]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; times leave as plain UTC wall-clock values."""
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(pin(spark), sf_dir)
            return df.select(*[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                for f in df.schema.fields
            ])

        QUERIES[name] = run
        return run

    return register


def simple(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """A query that is one model over the staged events."""
    query(name)(lambda spark, sf_dir: fn(staged(spark, sf_dir)))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed event table, written once for queries that read it repeatedly."""
    return stage_table(staging.typed_events(staged(spark, sf_dir)), "typed")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Ingest ---------------------------------------------------------------------

LANDED = ["id", "type", "actor", "repo", "org", "payload", "public", "created_at", "year", "month", "day", "hour"]


@query("normalize_batch")
def _(spark, sf_dir):
    return landing(spark, sf_dir).select(*LANDED)


def feed_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The feed as one line of JSON per event; ``keep`` adds members as columns."""
    members = []
    for name in FEED_FIELDS:
        value = F.col(name)
        if name in ("id", "type", "created_at"):
            value = F.concat(F.lit('"'), value, F.lit('"'))
        members.append(F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null"))))
    line = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return feed(spark, sf_dir).select(line.alias("value"), *keep)


def _write_lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "feed")
    feed_lines(spark, sf_dir).write.option("compression", "gzip").text(path)
    return path


@query("json_scan")
def _(spark, sf_dir):
    folder = _write_lines(spark, sf_dir)
    files = list_files(spark, f"{folder}/*.txt.gz").values()
    good, _ = split_corrupt(read_feed(spark, sorted(files)))
    return normalize(good).select(*LANDED)


@query("json_quarantine")
def _(spark, sf_dir):
    """Readable ids and unreadable lines of a feed with broken lines and bare arrays."""
    key = F.get_json_object("value", "$.id")
    lines = feed_lines(spark, sf_dir).withColumn("k", key.cast("bigint")).select(
        F.when(F.col("k") % 83 == 0, F.concat(F.lit("not json "), "k"))
        .when(F.col("k") % 79 == 0, F.concat(F.lit("[1, "), "k", F.lit("]")))
        .otherwise(F.col("value")).alias("value")
    )
    path = scratch_path(spark, "broken-feed")
    lines.write.option("compression", "gzip").text(path)
    files = list_files(spark, f"{path}/*.txt.gz").values()
    good, bad = split_corrupt(read_feed(spark, sorted(files)))
    return good.select(F.lit("read").alias("kind"), F.col("id").alias("value")).unionByName(
        bad.select(F.lit("quarantined").alias("kind"), F.col("message").alias("value"))
    )


@query("normalize_stream")
def _(spark, sf_dir):
    """Messages without a numeric id, type, flag or time take hashes and defaults."""
    e = F.col("id").cast("bigint")
    messages = feed(spark, sf_dir).withColumns({
        "id": F.when(e % 71 == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id")),
        "type": F.when(e % 73 != 0, F.col("type")),
        "public": F.when(e % 59 != 0, F.col("public")),
        "created_at": F.when(e % 61 == 0, F.lit("bad")).when(e % 67 != 0, F.col("created_at")),
    })
    rows = normalize(messages, "hash", F.lit(AS_OF).cast("timestamp"))
    # Ids of the feed are small; a 64-bit hash is not.
    hashed = (F.col("id") < 0) | (F.col("id") > 1 << 40)
    return rows.select(
        hashed.alias("hashed"), F.when(~hashed, F.col("id")).alias("id"), "type", "public", "created_at",
        "year", "month", "day", "hour",
    )


@query("message_ids")
def _(spark, sf_dir):
    """Equal messages get equal ids and different ones different, numeric ids or not."""
    e = F.col("id").cast("bigint")
    messages = feed(spark, sf_dir).withColumn("id", F.when(e % 71 == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    rows = normalize(messages.unionByName(messages), "hash", F.lit(AS_OF).cast("timestamp"))
    per_id = rows.groupBy("id").agg(F.count("*").alias("n"))
    return per_id.agg(
        (F.sum("n") / 2).cast("bigint").alias("messages"), F.count("*").alias("ids"),
        F.count_if(F.col("n") == 2).alias("same_again"),
    )


def _landed(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "landing")
    land_batch(landing(spark, sf_dir), root)
    return root


@query("land_batch")
def _(spark, sf_dir):
    return read_landing(spark, _landed(spark, sf_dir)).groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query("partition_scan")
def _(spark, sf_dir):
    hour = read_landing_hour(spark, _landed(spark, sf_dir), 2024, 1, 5, 7)
    return hour.select("id", "type", "payload", "public", "created_at", "day", "hour")


@query("insert_if_absent")
def _(spark, sf_dir):
    rows = landing(spark, sf_dir).drop("year", "month", "day", "hour")
    loaded = rows.filter(F.substring("created_at", 1, 10) < "2024-01-16")
    batch = rows.unionByName(rows.filter(F.col("type") == "WatchEvent"))
    fresh = insert_if_absent(batch, near_keys(loaded, batch, "id"), "id", delivery_order())
    return fresh.select("id", "type", "payload", "created_at")


@query("hour_grid")
def _(spark, sf_dir):
    return hours_in(span_of(_table(spark, sf_dir, "events"), F.col("ts")))


@query("dim_date")
def _(spark, sf_dir):
    return days_in(span_of(_table(spark, sf_dir, "orders"), F.col("o_orderdate")))


# Staging --------------------------------------------------------------------

@query("stg_raw_events")
def _(spark, sf_dir):
    return staged(spark, sf_dir)


VIEW_KEYS = {
    "watch": "stg_watch", "push": "stg_push", "create": "stg_create", "fork": "stg_fork",
    "issues": "stg_issues", "issue_comment": "stg_issue_comment", "pull_request": "stg_pr",
    "pull_request_review": "stg_pr_review", "release": "stg_release", "gollum": "stg_gollum",
    "public": "stg_public",
}
for _view in EVENT_VIEWS:
    simple(VIEW_KEYS[_view], lambda events, view=_view: stage(events, view))

simple("latest_repo", staging.stg_repos)
simple("latest_actor", staging.stg_actors)


# Rollups --------------------------------------------------------------------

simple("repo_watch_stats", lambda events: rollups.repo_watch_stats(events, AS_OF))
simple("repo_push_stats", rollups.repo_push_stats)
simple("repo_issue_stats", rollups.repo_issue_stats)
simple("repo_pr_stats", rollups.repo_pr_stats)
simple("repo_languages", rollups.repo_languages)
simple("repo_descriptions", rollups.repo_descriptions)
simple("actor_rollup", rollups.actor_rollup)
simple("repo_profile", lambda events: rollups.repo_profile(events, AS_OF))


# Marts ----------------------------------------------------------------------

simple("fact_events", marts.fact_events)
simple("fct_repo_stars", lambda events: marts.fct_repo_stars(stage(events, "watch")))
simple("daily_repo", marts.daily_repo)
simple("actor_activity", marts.daily_actor)
simple("dim_actor", marts.dim_actor)
simple("trending_repos", lambda events: marts.trending_repos(marts.daily_repo(events)))
simple("active_contributors", lambda events: marts.active_contributors(marts.daily_actor(events)))


def _first_history(events: DataFrame, as_of: datetime) -> DataFrame:
    """The history after one snapshot: every profile open since ``as_of``."""
    profile = rollups.repo_profile(events, as_of)
    empty = events.sparkSession.createDataFrame(
        [], history_schema(profile.schema, REPO_KEY, REPO_CHECKS)
    )
    return scd2_merge(empty, profile, REPO_KEY, REPO_CHECKS, as_of)


@query("language_popularity")
def _(spark, sf_dir):
    events = _typed(spark, sf_dir)
    return marts.language_popularity(
        marts.daily_repo(events), marts.dim_repo(_first_history(events, AS_OF))
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version history after three snapshots, each of the events before it."""
    events = _typed(spark, sf_dir)
    root = scratch_path(spark, "snapshot")
    schema = None
    for as_of in SNAPSHOTS:
        profile = rollups.repo_profile(events.filter(F.col("event_at") < F.lit(as_of)), as_of)
        schema = history_schema(profile.schema, REPO_KEY, REPO_CHECKS)
        snapshot_table(root, profile, as_of)
    return read_history(spark, root, schema)


@query("scd2")
def _(spark, sf_dir):
    return _history(spark, sf_dir)


@query("dim_repo")
def _(spark, sf_dir):
    return marts.dim_repo(_history(spark, sf_dir))


@query("incremental_daily")
def _(spark, sf_dir):
    """Days 1 to 20, then days 19 to 30 with two days delivered again."""
    rows = landing(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    models = Models(RawTable(spark, f"{root}/raw"), f"{root}/states")
    day = F.substring("created_at", 1, 10)
    for part in (rows.filter(day <= "2024-01-20"), rows.filter(day >= "2024-01-19")):
        load_batch(part, f"{root}/raw", f"{root}/bad", datetime.fromisoformat(LOADED_AT))
        models.refresh([REPO_DAYS, REPO_TOTALS])
    return marts.daily_repo_view(models.read(REPO_DAYS), models.read(REPO_TOTALS))


def _in_loads(spark: SparkSession, sf_dir: str, name: str) -> Models:
    """Models after three loads of interleaved events, the second of them delivered again."""
    root = scratch_path(spark, name)
    models = Models(RawTable(spark, f"{root}/raw"), f"{root}/states")
    rows, third = landing(spark, sf_dir), F.crc32(F.col("id").cast("string")) % 3
    for part in (rows.filter(third == 0), rows.filter(third == 1), rows.filter(third > 0)):
        load_batch(part, models.raw.root, f"{root}/bad", datetime.fromisoformat(LOADED_AT))
        models.refresh()
    return models


@query("incremental_profile")
def _(spark, sf_dir):
    """The profile from totals that saw each load's inserted rows only."""
    return rollups.profile_from_totals(_in_loads(spark, sf_dir, "profile").repo_totals(), AS_OF)


@query("incremental_actors")
def _(spark, sf_dir):
    return rollups.actor_activities(_in_loads(spark, sf_dir, "actors").read(ACTOR_TOTALS))


@query("repo_pushers_bitmap")
def _(spark, sf_dir):
    """Distinct pushers per repository and day, and over all days by uniting the days."""
    bitmaps = stage_table(rollups.repo_day_pushers(staged(spark, sf_dir)), "bitmaps")
    days = bitmaps.groupBy("repo_id", "event_date").agg(F.sum(F.bitmap_count("bits")).alias("pushers"))
    ever = rollups.count_pushers(rollups.merge_pushers(bitmaps)).select(
        F.col("repo_id").alias("_repo"), F.col("unique_pushers").alias("pushers_ever")
    )
    return days.join(ever, F.col("repo_id").eqNullSafe(F.col("_repo"))).drop("_repo")


def _some_days(view: DataFrame) -> DataFrame:
    return view.filter(F.col("event_date").between("2024-01-10", "2024-01-12"))


@query("daily_repo_pruned")
def _(spark, sf_dir):
    """Three days of the daily facts; the filter prunes the days that are read."""
    models = _in_loads(spark, sf_dir, "pruned")
    return _some_days(marts.daily_repo_view(models.read(REPO_DAYS), models.read(REPO_TOTALS)))


@query("daily_actor_pruned")
def _(spark, sf_dir):
    models = _in_loads(spark, sf_dir, "pruned-actors")
    return _some_days(marts.daily_actor_view(models.read(ACTOR_DAYS), models.read(ACTOR_TOTALS)))


@query("key_lookup")
def _(spark, sf_dir):
    """Which ids of a batch are loaded, from the index of ids."""
    root, rows = scratch_path(spark, "keys"), landing(spark, sf_dir)
    raw = RawTable(spark, f"{root}/raw")
    for rest in (1, 2):
        load_batch(rows.filter(F.col("id") % 3 == rest), raw.root, f"{root}/bad", datetime.fromisoformat(LOADED_AT))
        if rest == 1:
            raw.compact_keys()
    probe = rows.filter(F.col("id") % 5 == 0).select("id")
    return raw.held_keys(probe).join(probe, "id", "left_semi")


@query("late_load")
def _(spark, sf_dir):
    """Days in reverse order, each part with a repeat of the one before: every event once."""
    root, rows = scratch_path(spark, "late"), landing(spark, sf_dir)
    raw, day = RawTable(spark, f"{root}/raw"), F.substring("created_at", 1, 10)
    for low in ("2024-01-21", "2024-01-11", "2024-01-01"):
        load_batch(rows.filter(day >= low), raw.root, f"{root}/bad", datetime.fromisoformat(LOADED_AT))
    return raw.read().select("id", "type", "created_at", "event_date")


# Generic operators on the order tables ---------------------------------------

@query("orders_latest")
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").withColumns({
        "event_at": F.col("o_orderdate"), "event_id": F.col("o_orderkey"),
    })
    latest = latest_per_key(orders, ["o_custkey"], ["o_orderkey", "o_totalprice"])
    return latest.withColumnRenamed("event_at", "o_orderdate")


@query("customer_rank")
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    totals = orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.count_distinct(F.year("o_orderdate")).alias("years")
    )
    return global_rank(
        stage_table(totals, "customer-totals"), {"orders": "rank_orders", "years": "rank_years"}
    )


@query("part_top_k")
def _(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    totals = lines.groupBy("l_partkey").agg(F.count("*").alias("line_count"))
    return top_k_with_ties(stage_table(totals, "part-totals"), "line_count", 100, "rank_lines")


# Quality --------------------------------------------------------------------

def _check_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = stage_table(raw_events(spark, sf_dir), "raw")
    events = stg_raw_events(raw)
    typed = stage_table(staging.typed_events(events), "typed")
    tables = {
        "raw_events": raw,
        "stg_raw_events": events,
        "dim_actor": marts.dim_actor(typed),
        "dim_repo": marts.dim_repo(_first_history(typed, AS_OF)),
        "dim_date": days_in(span_of(typed, F.col("event_date"))),
        "fact_events": marts.fact_events(typed),
        "fct_daily_repo_metrics": marts.daily_repo(typed),
        "int_repo_watch_stats": rollups.repo_watch_stats(typed, AS_OF),
    }
    for view in quality.STAGED_UNIQUE:
        tables[f"stg_{view}_events"] = stage(events, view)
    return tables


@query("dq_not_null")
def _(spark, sf_dir):
    return quality.not_null_checks(_check_tables(spark, sf_dir))


@query("dq_unique")
def _(spark, sf_dir):
    tables = _check_tables(spark, sf_dir)
    extra = [
        quality.unique(_table(spark, sf_dir, "lineitem"), "l_orderkey", {"lineitem": None}),
        quality.unique(_table(spark, sf_dir, "orders"), "o_orderkey", {"orders": None}),
    ]
    results = quality.unique_checks(tables)
    for part in extra:
        results = results.unionByName(quality.with_status(part))
    return results


@query("dq_relationships")
def _(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer")
    extra = [
        quality.relationships(
            "lineitem", _table(spark, sf_dir, "lineitem"), "l_partkey",
            _table(spark, sf_dir, "part"), "p_partkey",
        ),
        # Customers in debt are left out of the parent, so orphans occur.
        quality.relationships(
            "orders", _table(spark, sf_dir, "orders"), "o_custkey",
            customers.filter(F.col("c_acctbal") >= 0), "c_custkey",
        ),
    ]
    results = quality.relationship_checks(_check_tables(spark, sf_dir))
    for part in extra:
        results = results.unionByName(quality.with_status(part))
    return results


@query("dq_assertions")
def _(spark, sf_dir):
    return quality.assertion_checks(_check_tables(spark, sf_dir))


def _dirtied(df: DataFrame, columns: list[str], number: str) -> DataFrame:
    """``df`` with every fifth row twice and each column empty at a step of its own."""
    rows = df.withColumn("_n", F.expr(number))
    rows = rows.unionByName(rows.filter(F.col("_n") % 5 == 0))
    return rows.withColumns({
        c: F.when(F.col("_n") % (7 + 2 * i) != 0, F.col(c)) for i, c in enumerate(columns)
    })


@query("dq_dirty")
def _(spark, sf_dir):
    """All declared tests on tables with repeats, gaps, missing parents and bad values."""
    tables = _check_tables(spark, sf_dir)
    numbers = {
        "raw_events": "id", "dim_actor": "actor_id", "dim_repo": "repo_id",
        "dim_date": "dayofmonth(date_id)", "fct_daily_repo_metrics": "repo_id",
    }
    dirty = {
        t: _dirtied(tables[t], columns, numbers.get(t, "event_id")) for t, columns in quality.NOT_NULL.items()
    }
    dirty["dim_repo"] = dirty["dim_repo"].withColumn(
        "valid_to", F.when(F.col("_n") % 4 == 0, F.col("valid_from") - F.expr("interval 1 day"))
    )
    stars = F.col("star_count")
    dirty["int_repo_watch_stats"] = tables["int_repo_watch_stats"].withColumn(
        "star_count", F.when(F.col("repo_id") % 3 == 0, -stars - 1).otherwise(stars)
    )
    return quality.run_checks(dirty)


# Observability ----------------------------------------------------------------

@query("rows_ingested")
def _(spark, sf_dir):
    return observe.rows_ingested(raw_events(spark, sf_dir), datetime(2024, 1, 15).date())


@query("rows_ingested_hour")
def _(spark, sf_dir):
    return observe.rows_ingested(raw_events(spark, sf_dir), datetime(2024, 1, 15).date(), hour=9)


@query("freshness")
def _(spark, sf_dir):
    return observe.freshness(staged(spark, sf_dir), AS_OF)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per event day."""
    day = F.dayofmonth("event_at")
    per_day = staged(spark, sf_dir).groupBy(
        F.date_trunc("day", "event_at").alias("dag_run_timestamp"), day.alias("d")
    ).agg(F.count("*").alias("rows_ingested"))
    return per_day.select(
        F.date_format("dag_run_timestamp", "'run_'yyyyMMdd").alias("run_id"),
        "dag_run_timestamp", "rows_ingested",
        ((F.col("d") * 600) % 9000).cast("int").alias("freshness_lag_seconds"),
        (43 - F.col("d") % 4).cast("int").alias("dbt_tests_passed"),
        (F.col("d") % 4).cast("int").alias("dbt_tests_failed"),
        (F.col("d") * 7).cast("int").alias("duration_seconds"),
        F.lit("SUCCESS").alias("status"),
    )


@query("obs_latest")
def _(spark, sf_dir):
    metrics = stage_table(_metrics(spark, sf_dir), "metrics")
    panels = {
        "total_rows": observe.total_rows(metrics).select(F.col("value").cast("double")),
        "latest_lag": observe.latest_lag(metrics).select(F.col("value").cast("double")),
        "latest_success": observe.latest_success(metrics).select(F.round("value", 6).alias("value")),
    }
    result = None
    for name, panel in panels.items():
        row = panel.select(F.lit(name).alias("panel"), "value")
        result = row if result is None else result.unionByName(row)
    return result


@query("obs_series")
def _(spark, sf_dir):
    metrics = stage_table(_metrics(spark, sf_dir), "metrics")
    return observe.lag_series(metrics).join(observe.volume_series(metrics), "time").orderBy("time")


@query("obs_log")
def _(spark, sf_dir):
    return observe.run_log(_metrics(spark, sf_dir))


@query("obs_status")
def _(spark, sf_dir):
    return observe.run_status(_metrics(spark, sf_dir))


# Anomalies --------------------------------------------------------------------

def _anomaly(name: str, method: str) -> None:
    simple(name, lambda events: anomalies(series(marts.daily_repo(events)), method, AS_OF))


_anomaly("anomaly_trend", "trend")
_anomaly("anomaly_zscore", "zscore")
_anomaly("anomaly_auto", "auto")
_anomaly("anomaly_piecewise", "piecewise")


def straight_line(days: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Least-squares line and residual deviation: a model whose bounds SQL can state."""
    x = days - days.mean()
    spread = (x * x).sum()
    fitted = y.mean() + (x * y).sum() / (spread or 1.0) * x
    return fitted, float(np.sqrt(((y - fitted) ** 2).mean()))


@query("anomaly_hook")
def _(spark, sf_dir):
    """The per-series model hook with a model of the caller."""
    daily = marts.daily_repo(staged(spark, sf_dir))
    return anomalies(series(daily), "piecewise", AS_OF, fit=straight_line)


@query("anomaly_states")
def _(spark, sf_dir):
    """Both rules with bounds from the sums that follow the loads."""
    models = _in_loads(spark, sf_dir, "anomaly-states")
    points = series(marts.daily_repo_view(models.read(REPO_DAYS), models.read(REPO_TOTALS)))
    sums = models.series().read(spark)
    found = None
    for rule in ("trend", "zscore"):
        rows = anomalies(points, rule, AS_OF, state=sums).select(F.lit(rule).alias("rule"), "*")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("anomaly_short")
def _(spark, sf_dir):
    """Dispatch by length: odd repositories have two days at most, even ones their whole series."""
    points = series(marts.daily_repo(staged(spark, sf_dir)))
    return anomalies(points.filter((F.col("repo_id") % 2 == 0) | (F.col("ds") <= "2024-01-02")), "auto", AS_OF)


@query("stg_variant")
def _(spark, sf_dir):
    """Typed views over the payload as VARIANT, which parse no text."""
    events = _typed(spark, sf_dir)
    none = F.lit(None).cast("timestamp")
    parts = [
        stage(events, "push").select(F.lit("push").alias("view"), "event_id", F.col("push_id").alias("number"),
                                     F.col("branch_ref").alias("words"), none.alias("closed_at")),
        stage(events, "issues").select(F.lit("issues"), "event_id", F.col("issue_number").cast("bigint"),
                                       F.concat_ws(" ", "issue_state", "action"), "issue_closed_at"),
        stage(events, "pull_request").select(F.lit("pull_request"), "event_id", F.col("pr_number").cast("bigint"),
                                             F.concat_ws(" ", "pr_state", "action"), "pr_closed_at"),
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("event_ranks")
def _(spark, sf_dir):
    """Rank of every event by its second: as many distinct values as rows, close together."""
    events = staged(spark, sf_dir).select("event_id", F.unix_timestamp("event_at").alias("at"))
    return global_rank(stage_table(events, "seconds"), {"at": "newest_rank"}).drop("at")


@query("contract_tables")
def _(spark, sf_dir):
    """What the contracts of the anomaly and run tables keep and refuse."""
    daily = marts.daily_repo(staged(spark, sf_dir))
    rows = daily.select(
        "repo_id", F.when(F.col("repo_id") % 5 == 0, None).when(F.col("repo_id") % 7 == 0, F.repeat(F.lit("n"), 256))
        .otherwise(F.col("repo_name")).alias("repo_name"), F.col("event_date").alias("ds"),
        *[F.lit(1.0).alias(c) for c in ("y", "yhat_lower", "yhat_upper", "anomaly_score")],
    )
    metrics, day = _metrics(spark, sf_dir), F.dayofmonth("dag_run_timestamp")
    runs = metrics.withColumn(
        "run_id", F.when(day % 5 == 0, None).when(day % 3 == 0, F.repeat(F.lit("r"), 101)).otherwise(F.col("run_id"))
    ).withColumn(
        "rows_ingested", F.when(day % 7 == 0, F.lit("many")).otherwise(F.col("rows_ingested").cast("string"))
    )
    found = None
    for kind, frame, schema, name in (
        ("anomalies", rows, DETECTED_ANOMALIES, "detected_anomalies"), ("metrics", runs, PIPELINE_METRICS, "pipeline_metrics"),
    ):
        good, bad = split_by_contract(frame, schema, MAX_LENGTHS[name])
        for part in (good.select(F.lit("kept").alias("reason")), bad.select("reason")):
            counted = part.select(F.lit(kind).alias("kind"), "reason")
            found = counted if found is None else found.unionByName(counted)
    return found.groupBy("kind", "reason").agg(F.count("*").alias("n"))


# The whole chain ------------------------------------------------------------------

FEED_DAY = datetime(2024, 2, 2)


def _hourly_feed(spark: SparkSession, sf_dir: str) -> list[str]:
    """All events as 24 files, one per hour as the feed has them, some without a readable time."""
    folder = scratch_path(spark, "hourly-feed")
    e = F.col("id").cast("bigint")
    undated = F.regexp_replace("value", '"created_at":"[^"]*"}$', '"created_at":"bad"}')
    lines = feed_lines(spark, sf_dir, "id").select(
        F.when(e % 61 == 0, undated).otherwise(F.col("value")).alias("value"), F.pmod(F.hash(e), F.lit(24)).alias("h")
    )
    lines.repartitionById(24, "h").write.partitionBy("h").option("compression", "gzip").text(folder)
    return glob_paths(spark, f"{folder}/h=*/*.txt.gz")


@query("pipeline_hour")
def _(spark, sf_dir):
    """Feed files of a day: most landed at once, then one hour, then one whose first run
    was lost after its load.  All events are at least a day late.  Each event with its
    repository's count on its day and rank over all days."""
    root, feed_dir = scratch_path(spark, "lake"), scratch_path(spark, "feed-files")
    lake, files = Lake(spark, root), _hourly_feed(spark, sf_dir)

    def appear(*hours: int) -> None:
        for path in files:
            hour = int(path.rsplit("/", 2)[-2].split("=")[1])
            if hour in hours:
                move(spark, path, f"{feed_dir}/{FEED_DAY:%Y-%m-%d}-{hour}.json.gz")

    def at(hour: int) -> datetime:
        return FEED_DAY + timedelta(hours=hour)

    appear(*range(22))
    ingest_hours(lake, feed_dir, FEED_DAY.date(), FEED_DAY.date())
    appear(22)
    run_hour(spark, root, feed_dir, at(22), at(24), "h22", gate=False)
    appear(23)
    ingest_hours(lake, feed_dir, FEED_DAY.date(), FEED_DAY.date(), 23)
    load_landed(lake, at(24))
    run_hour(spark, root, feed_dir, at(23), at(25), "h23", gate=False)
    facts = lake.day_table("fact_events").select("event_id", "event_type", "actor_id", "repo_id", "event_at", "date_id")
    days = lake.daily_repo().select(
        F.col("repo_id").alias("_repo"), F.col("event_date").alias("_day"), F.col("total_events").alias("repo_day_events")
    )
    ranks = lake.mart("mart_trending_repos").select(F.col("repo_id").alias("_ranked"), "rank_total")
    return (
        facts.join(days, (F.col("repo_id") == F.col("_repo")) & (F.col("date_id") == F.col("_day")), "left")
        .join(ranks, F.col("repo_id") == F.col("_ranked"), "left")
        .select("event_id", "event_type", "actor_id", "repo_id", "event_at", "repo_day_events", "rank_total")
    )


# Streams ------------------------------------------------------------------------

@query("replay")
def _(spark, sf_dir):
    """The feed files replayed as keyed messages into a folder."""
    lines = spark.readStream.format("text").load(_write_lines(spark, sf_dir))
    out = scratch_path(spark, "replayed")
    streams.replay_messages(lines).writeStream.format("parquet").option(
        "checkpointLocation", f"{out}-progress"
    ).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema("key string, value string").parquet(out)


@query("stream_land")
def _(spark, sf_dir):
    messages = streams.read_message_files(spark, _write_lines(spark, sf_dir), AS_OF)
    root = scratch_path(spark, "stream-landing")
    streams.land_stream(messages, root, f"{root}-progress", interval=None).awaitTermination()
    return read_landing(spark, root).groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query("stream_load")
def _(spark, sf_dir):
    """Landed files, each delivered twice, loaded by the keyed stream."""
    root = scratch_path(spark, "stream-load")
    rows = landing(spark, sf_dir)
    for _ in range(2):
        land_batch(rows, f"{root}/landing")
    streams.load_stream(
        spark, f"{root}/landing", f"{root}/raw", f"{root}/bad", f"{root}/progress",
        datetime.fromisoformat(LOADED_AT), max_files=1000000,
    ).awaitTermination()
    return read_table(spark, f"{root}/raw", RAW_ON_DISK).select(
        "id", "type", "actor", "repo", "payload", "public", "created_at", "event_date", "loaded_at"
    )


@query("stream_dedupe")
def _(spark, sf_dir):
    """Newest days first, then all days twice: most of what follows is days late or a repeat."""
    raw = raw_events(spark, sf_dir)
    path, out = scratch_path(spark, "raw-stream"), scratch_path(spark, "deduped")
    for part in (raw.filter(F.substring("created_at", 1, 10) >= "2024-01-16"), raw, raw):
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(raw.schema).parquet(path)
        rows = stream.withColumn("event_at", staging.parse_event_ts(F.col("created_at"))).select("id", "type", "event_at")
        streams.dedupe_into(rows, out, f"{out}-progress").awaitTermination()
    return read_table(spark, out, rows.schema)


@query("stream_daily")
def _(spark, sf_dir):
    """Two deliveries whose events span all days, so that the second is late for every day."""
    rows = landing(spark, sf_dir)
    root = scratch_path(spark, "stream-daily")
    odd = F.crc32(F.col("id").cast("string")) % 2 == 1
    for part in (rows.filter(odd), rows.filter(~odd | odd.isNull())):
        land_batch(part, f"{root}/landing")
        streams.daily_repo_stream(
            spark, f"{root}/landing", root, f"{root}/progress", datetime.fromisoformat(LOADED_AT), max_files=1000000,
        ).awaitTermination()
    return streams.daily_repo_streamed(spark, root).select(
        "repo_id", "event_date", "total_events", "star_count", "push_count", "pr_count", "issue_count"
    )
