"""One logical hour of the pipeline, from feed files to the run record."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.calendar import dim_date
from eventloom.operators.anomaly import anomalies, series
from eventloom.operators.load import LoadReport, RawTable, load_batch, on_dates
from eventloom.operators.normalize import normalize, split_corrupt
from eventloom.operators.scd2 import (
    REPO_CHECKS, REPO_KEY, history_schema, read_history, snapshot_table,
)
from eventloom.plans import marts, observe, quality, rollups, staging
from eventloom.plans.incremental import (
    ACTOR_DAYS, ACTOR_TOTALS, EVENT_TABLES, REPO_DAYS, REPO_TOTALS, Models, of_touched, touched_keys,
    with_touched_replaced,
)
from eventloom.schemas import CORRUPT, DETECTED_ANOMALIES, DIM_REPO, MAX_LENGTHS, PIPELINE_METRICS
from eventloom.session import pin, write_together
from eventloom.sources.feed import (
    feed_files, hour_key, land_batch, read_feed, read_landing,
)
from eventloom.sources.paths import exists, latest_version, mark_version
from eventloom.sources.tables import (
    append_absent, append_table, read_latest, read_table, replace_table, split_by_contract,
)
from eventloom.streaming.runlog import BatchLog
from eventloom.streaming.streams import load_stream


@dataclass(frozen=True)
class Lake:
    """Where everything lives below one root, and how to read it back."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def landing(self) -> DataFrame:
        """Everything landed, by batches and by the stream (each has its own folder)."""
        return read_landing(self.spark, self.path("landing")).unionByName(
            read_landing(self.spark, self.path("landing_stream"))
        )

    @property
    def raw_table(self) -> RawTable:
        return RawTable(self.spark, self.path("raw/events"))

    @property
    def models(self) -> Models:
        """Event tables, days and totals, kept up from the inserted rows."""
        return Models(self.raw_table, self.path("states"))

    def raw(self) -> DataFrame:
        return self.raw_table.read()

    def events(self) -> DataFrame:
        """Staged raw events with their partition column."""
        return staging.stg_raw_events(self.raw(), "event_date")

    def mart(self, name: str) -> DataFrame:
        return read_latest(self.spark, self.path(f"marts/{name}"))

    def day_table(self, name: str) -> DataFrame:
        """A table kept by event date: one of the event tables, or measures per entity and day."""
        if name in EVENT_TABLES:
            return self.models.events(name)
        return self.models.read({state.name: state for state in (REPO_DAYS, ACTOR_DAYS)}[name])

    def repo_totals(self, only: list | None = None) -> DataFrame:
        return self.models.repo_totals(only)

    def actor_totals(self) -> DataFrame:
        return self.models.read(ACTOR_TOTALS)

    def history(self) -> DataFrame:
        schema = history_schema(DIM_REPO, REPO_KEY, REPO_CHECKS)
        return read_history(self.spark, self.path("snapshots/dim_repo"), schema)

    def dim_repo(self) -> DataFrame:
        return marts.dim_repo(self.history())

    def daily_repo(self) -> DataFrame:
        """Daily facts; a filter on ``event_date`` prunes the days read."""
        return marts.daily_repo_view(self.day_table("repo_days"), self.models.read(REPO_TOTALS))

    def daily_actor(self) -> DataFrame:
        return marts.daily_actor_view(self.day_table("actor_days"), self.actor_totals())

    def waiting(self) -> list[date | None]:
        """Event dates of the loads whose models, tests and anomalies are not all done."""
        return self.raw_table.dates(self.settled())

    def settled(self) -> int:
        return latest_version(self.spark, self.path("settled"))

    def detected_anomalies(self) -> DataFrame:
        return read_latest(self.spark, self.path("analytics/detected_anomalies"), DETECTED_ANOMALIES)

    def metrics(self) -> DataFrame:
        return read_table(self.spark, self.path("observability/pipeline_metrics"), PIPELINE_METRICS)

    def register_views(self, as_of: datetime) -> None:
        """Every model as a temporary view, for SQL users.

        ``as_of`` is the time shown where a model falls back to the current time.
        """
        repos = self.repo_totals()
        views = {
            "int_repo_watch_stats": rollups.watch_stats(repos, as_of),
            "int_repo_push_stats": rollups.push_stats(repos),
            "int_repo_issue_stats": rollups.issue_stats(repos),
            "int_repo_pr_stats": rollups.pr_stats(repos),
            "int_repo_languages": rollups.languages(repos),
            "int_repo_descriptions": rollups.descriptions(repos),
            "int_actor_activities": rollups.actor_activities(self.actor_totals()),
            "raw_events": self.raw(),
            "stg_raw_events": self.events().drop("event_date"),
            "stg_repos": staging.stg_repos(self.events()),
            "stg_actors": staging.stg_actors(self.events()),
            "fact_events": self.day_table("fact_events").drop("event_date"),
            "fct_repo_stars": self.day_table("fct_repo_stars").drop("event_date"),
            "fct_daily_repo_metrics": self.daily_repo(),
            "fct_actor_activity": self.daily_actor(),
            "dim_repo": self.dim_repo(),
            "detected_anomalies": self.detected_anomalies(),
            "pipeline_metrics": self.metrics(),
        }
        for view in staging.EVENT_VIEWS:
            views[f"stg_{view}_events"] = staging.stage(self.models.typed(), view)
        for name in MARTS:
            views[name] = self.mart(name)
        for name, frame in views.items():
            frame.createOrReplaceTempView(name)


MARTS = [
    "int_daily_repo_metrics_joined", "dim_actor", "dim_date", "mart_trending_repos",
    "mart_active_contributors", "mart_language_popularity",
]


def ingest_hours(lake: Lake, feed_dir: str, start: date, end: date, hour: int | None = None) -> None:
    """Land the feed files of a span of days (or of one hour on each of them)."""
    files = feed_files(lake.spark, feed_dir, start, end, hour)
    if not files:
        return
    unreadable = Observation()
    feed = read_feed(lake.spark, files)
    good, _ = split_corrupt(
        feed.observe(unreadable, F.count_if(F.col(CORRUPT).isNotNull()).alias("n"))
    )
    span = (_key(start, hour or 0), _key(end, 23 if hour is None else hour))
    land_batch(normalize(good), lake.path("landing"), span)
    if _observed(unreadable) != 0:
        _, bad = split_corrupt(feed)
        append_absent(bad, lake.path("quarantine/messages"), ["message"])


def _observed(observation: Observation) -> int | None:
    """The observed count, or None when the plan that carried it was dropped.

    Adaptive execution replaces a write by an empty one once it has seen that
    no row is left (a replayed hour), and the metrics go with it.
    """
    try:
        return observation.get["n"]
    except Py4JJavaError:
        return None


def _key(day: date, hour: int) -> int:
    return day.year * 1000000 + day.month * 10000 + day.day * 100 + hour


def load_hours(lake: Lake, first: datetime, last: datetime, run_ts: datetime) -> LoadReport:
    """Load the landed hours from ``first`` to ``last``, both included."""
    span = (_key(first.date(), first.hour), _key(last.date(), last.hour))
    batch = lake.landing().filter(hour_key().between(*span))
    return load_batch(batch, lake.path("raw/events"), lake.path("quarantine/rows"), run_ts)


def load_landed(lake: Lake, run_ts: datetime, log: BatchLog | None = None) -> list[date | None]:
    """Load every landed file that no load has taken yet, whatever hours it holds.

    Returns the event dates that wait for their models: those of this load and of
    earlier ones whose run did not end.
    """
    for folder in ("landing", "landing_stream"):
        if exists(lake.spark, f"{lake.path(folder)}/year=*"):
            load_stream(
                lake.spark, lake.path(folder), lake.path("raw/events"), lake.path("quarantine/rows"),
                lake.path(f"checkpoints/load_{folder}"), run_ts, log=log,
            ).awaitTermination()
    return lake.waiting()


def settle(lake: Lake, load_id: int) -> None:
    """Nothing waits any more up to ``load_id``: models, tests and anomalies are done."""
    if load_id > lake.settled():
        mark_version(lake.spark, lake.path("settled"), load_id)


def build_models(lake: Lake, as_of: datetime) -> None:
    """Bring every model up to date with the loads so far.

    Inserted events are read once and merged into the days and entities they touch;
    repositories of untouched buckets keep their version history as it is.  The marts
    rank all entities, so they are built from all totals.
    """
    spark, models, last = lake.spark, lake.models, lake.raw_table.last()
    built = latest_version(spark, lake.path("built"))
    if latest_version(spark, lake.path("marts/mart_language_popularity")) and built >= last:
        return
    models.refresh()
    repos, actors = lake.repo_totals(), lake.actor_totals()
    replace_table(rollups.profile_from_totals(repos, as_of), lake.path("marts/int_daily_repo_metrics_joined"))
    touched = lake.repo_totals(models.touched(REPO_TOTALS, built))
    snapshot_table(lake.path("snapshots/dim_repo"), rollups.profile_from_totals(touched, as_of), as_of)
    marts_now = {
        "dim_actor": lambda: marts.dim_actor_rows(actors),
        "dim_date": lambda: dim_date(spark),
        "mart_trending_repos": lambda: marts.trending_from_totals(repos),
        "mart_active_contributors": lambda: marts.contributors_from_totals(actors),
        "mart_language_popularity": lambda: marts.languages_from_totals(repos, lake.dim_repo()),
    }
    write_together(spark, [
        lambda name=name, rows=rows: replace_table(rows(), lake.path(f"marts/{name}"))
        for name, rows in marts_now.items()
    ])
    if last:
        mark_version(spark, lake.path("built"), last)


def detect_anomalies(
    lake: Lake, dates: list[date | None], method: str, run_ts: datetime
) -> None:
    """Replace the anomaly table, scoring again only the series that changed."""
    days = lake.day_table("repo_days")
    touched = touched_keys(days, "repo_id", dates)
    names = lake.models.read(REPO_TOTALS)
    changed = marts.daily_repo_view(of_touched(days, "repo_id", touched), names)
    sums = lake.models.series().read(lake.spark)
    found = with_touched_replaced(
        lake.detected_anomalies(), anomalies(series(changed), method, run_ts, state=sums), "repo_id", touched
    )
    good, bad = split_by_contract(
        found.withColumn("run_timestamp", F.lit(run_ts).cast("timestamp")),
        DETECTED_ANOMALIES, MAX_LENGTHS["detected_anomalies"],
    )
    replace_table(good, lake.path("analytics/detected_anomalies"))
    set_aside(lake, bad, "anomalies", ["repo_id", "ds"])


def set_aside(lake: Lake, bad: DataFrame, name: str, identity: list[str]) -> None:
    """Keep rows that a table refused, once each."""
    if not bad.isEmpty():
        append_absent(bad, lake.path(f"quarantine/{name}"), identity)


def record_run(lake: Lake, rows: DataFrame, table: str = "pipeline_metrics") -> None:
    """Append run rows that keep the contract; others are set aside."""
    good, bad = split_by_contract(rows, PIPELINE_METRICS, MAX_LENGTHS["pipeline_metrics"])
    append_table(good, lake.path(f"observability/{table}"))
    set_aside(lake, bad, table, ["run_id", "run_timestamp"])


def check_tables(lake: Lake, dates: list[date | None] | None = None) -> dict[str, DataFrame]:
    """The tables the declared tests run on; event-sized ones limited to ``dates``."""
    scope = F.lit(True) if dates is None else on_dates(dates)
    events, typed = lake.events().filter(scope), lake.models.typed().filter(scope)
    tables = {
        "raw_events": lake.raw().filter(scope),
        "stg_raw_events": events,
        "dim_actor": lake.mart("dim_actor"),
        "dim_repo": lake.dim_repo(),
        "dim_date": lake.mart("dim_date"),
        "fact_events": lake.day_table("fact_events").filter(scope),
        "fct_daily_repo_metrics": lake.daily_repo().filter(scope),
        "int_repo_watch_stats": lake.mart("int_daily_repo_metrics_joined"),
    }
    for view in quality.STAGED_UNIQUE:
        tables[f"stg_{view}_events"] = staging.stage(typed, view)
    return tables


def run_hour(
    spark: SparkSession, root: str, feed_dir: str, logical_hour: datetime, run_ts: datetime,
    run_id: str, method: str = "auto",
    gate: bool = True, check_everything: bool = False,
) -> DataFrame:
    """Run one logical hour and return its run record.

    Rerunning an hour changes nothing but the run log.  The load takes all that
    has landed and is not loaded yet, however old or undated its events are.
    Tests cover the event days this run touched, and the ids it brought against the
    whole raw table, or everything with ``check_everything``; with ``gate`` a failing
    test stops the run before the anomalies, after recording it.  A run that breaks off
    is recorded too, with the rows its load had read, and so is every micro-batch.
    """
    started = time.monotonic()
    lake, log = Lake(pin(spark), root), BatchLog(spark)

    def record(status: str, passed: int = 0, failed: int = 0, rows: int | None = None) -> DataFrame:
        if rows is None:
            rows = lake.day_table("repo_days").filter(F.col("event_date") == F.lit(logical_hour.date())).agg(
                F.coalesce(F.sum("total_events"), F.lit(0)).alias("n")
            ).first().n
        lag = observe.freshness(lake.models.read(REPO_TOTALS), run_ts, "last_event_at").first().freshness_lag_seconds
        row = observe.run_record(
            spark, run_id, logical_hour, rows, lag, passed, failed, int(time.monotonic() - started), status, run_ts,
        )
        record_run(lake, row)
        return row

    try:
        ingest_hours(lake, feed_dir, logical_hour.date(), logical_hour.date(), logical_hour.hour)
        with log:
            dates = load_landed(lake, run_ts, log)
        last, settled = lake.raw_table.last(), lake.settled()
        build_models(lake, run_ts)

        scope = None if check_everything else dates
        ids = {} if check_everything else {"raw_events": lake.raw_table.keys_of(settled)}
        results = quality.run_checks(check_tables(lake, scope), ids).collect()
        failures = [r for r in results if r.failures]
        passed = len(results) - len(failures)
        if failures and gate:
            record("FAILED", passed, len(failures))
            raise quality.QualityError(failures)
        detect_anomalies(lake, dates, method, run_ts)
        settle(lake, last)
    except quality.QualityError:
        raise
    except Exception:
        record("FAILED", rows=log.input_rows())
        raise
    finally:
        batches = log.rows(run_id, logical_hour, run_ts)
        if not batches.isEmpty():
            record_run(lake, batches, "stream_metrics")
    return record("SUCCESS", passed, len(failures))
