"""Whole hours from feed files to the run record."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom.operators.anomaly import anomalies, series
from eventloom.plans import marts, pipeline, rollups, staging
from eventloom.plans.pipeline import Lake, run_hour
from eventloom.plans.quality import QualityError
from eventloom.plans.staging import stg_raw_events
from tests.conftest import message, write_feed

TYPES = ["WatchEvent", "PushEvent", "IssuesEvent", "PullRequestEvent", "CreateEvent", "ForkEvent"]


def hour_messages(hour: datetime, n: int = 30):
    base = int(hour.timestamp())
    for i in range(n):
        payload = {
            "PushEvent": {"push_id": base + i, "size": 2},
            "IssuesEvent": {"action": "opened", "issue": {"id": i}},
            "PullRequestEvent": {"action": "opened", "pull_request": {"id": i}},
            "CreateEvent": {"description": f"d{hour.hour}"},
        }.get(TYPES[i % 6], {})
        at = (hour + timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ")
        yield message(base + i, TYPES[i % 6], at, actor=i % 4, repo=i % 5, payload=payload)


def brief(df):
    return sorted(map(str, df.collect()))


def run(spark, lake, feed, hour, run_id, **more):
    return run_hour(
        spark, str(lake), str(feed), hour, hour + timedelta(hours=1, minutes=5), run_id, **more
    ).first()


def test_hours_in_sequence(spark, tmp_path):
    lake_root, feed = tmp_path / "lake", tmp_path / "feed"
    hours = [datetime(2024, 1, 5, 23), datetime(2024, 1, 6, 0), datetime(2024, 1, 6, 1)]
    for h in hours:
        extra = ["broken line"] if h.hour == 23 else []
        if h.hour == 0:
            # A straggler of the hour before, delivered in this hour's file.
            extra = [message(1, "WatchEvent", "2024-01-05T23:59:59Z", actor=1, repo=9)]
        write_feed(feed / f"{h:%Y-%m-%d}-{h.hour}.json.gz", [*hour_messages(h), *extra])
    records = [run(spark, lake_root, feed, h, f"run-{i}") for i, h in enumerate(hours)]
    assert [r.rows_ingested for r in records] == [30, 30, 60]
    assert {(r.dbt_tests_passed, r.dbt_tests_failed, r.status) for r in records} == {(43, 0, "SUCCESS")}
    # Newest event of the last run is 01:29, the run is at 02:05.
    assert records[-1].freshness_lag_seconds == 36 * 60

    lake = Lake(spark, str(lake_root))
    assert lake.raw().count() == 91
    assert lake.day_table("fact_events").count() == 91
    events = stg_raw_events(lake.raw())
    assert brief(lake.daily_repo()) == brief(marts.daily_repo(events))
    assert brief(lake.daily_actor()) == brief(marts.daily_actor(events))
    assert brief(lake.mart("dim_actor")) == brief(marts.dim_actor(events))
    full = rollups.repo_profile(events, datetime(2024, 1, 6, 2, 5))
    assert brief(lake.mart("int_daily_repo_metrics_joined").select(*full.columns)) == brief(full)
    daily = marts.daily_repo(events)
    assert brief(lake.mart("mart_trending_repos")) == brief(marts.trending_repos(daily))
    assert brief(lake.mart("mart_language_popularity")) == brief(
        marts.language_popularity(daily, lake.dim_repo())
    )
    assert brief(lake.mart("mart_active_contributors")) == brief(
        marts.active_contributors(marts.daily_actor(events))
    )
    found = anomalies(series(daily), "auto", datetime(2024, 1, 6, 2, 5))
    assert brief(lake.detected_anomalies().select(*found.columns)) == brief(found)
    current = lake.dim_repo().filter("is_current")
    assert current.count() == full.count() == 6
    assert lake.dim_repo().filter(~F.col("is_current")).count() > 0
    assert spark.read.parquet(str(lake_root / "quarantine/messages")).count() == 1

    # Running the last hour again changes nothing but the run log.
    before = {name: brief(frame()) for name, frame in {
        "raw": lake.raw, "history": lake.history, "daily": lake.daily_repo,
    }.items()}
    again = run(spark, lake_root, feed, hours[-1], "run-again")
    assert again.rows_ingested == 60
    assert before == {
        "raw": brief(lake.raw()), "history": brief(lake.history()), "daily": brief(lake.daily_repo()),
    }
    assert lake.metrics().count() == 4

    as_of = datetime(2024, 2, 1)
    lake.register_views(as_of)
    for view, direct in {
        "int_repo_watch_stats": rollups.repo_watch_stats(events, as_of),
        "int_repo_push_stats": rollups.repo_push_stats(events),
        "int_repo_issue_stats": rollups.repo_issue_stats(events),
        "int_repo_pr_stats": rollups.repo_pr_stats(events),
        "int_repo_languages": rollups.repo_languages(events),
        "int_repo_descriptions": rollups.repo_descriptions(events),
        "int_actor_activities": rollups.actor_rollup(events),
        "stg_repos": staging.stg_repos(events),
    }.items():
        assert brief(spark.table(view).select(*direct.columns)) == brief(direct)
    top = spark.sql("select repo_id from mart_trending_repos where rank_total = 1").collect()
    assert {r.repo_id for r in top} == {0, 1, 2, 3, 4}
    assert spark.sql("select count(*) from stg_push_events").first()[0] == 15
    assert spark.sql("select sum(rows_ingested) from pipeline_metrics").first()[0] == 180


def test_failing_test_stops_the_run_after_recording_it(spark, tmp_path):
    hour = datetime(2024, 1, 5, 7)
    rows = list(hour_messages(hour, 6))
    rows[0]["actor"] = None
    write_feed(tmp_path / "feed/2024-01-05-7.json.gz", rows)
    with pytest.raises(QualityError, match="fact_events.actor_id"):
        run(spark, tmp_path / "lake", tmp_path / "feed", hour, "r1")
    lake = Lake(spark, str(tmp_path / "lake"))
    record = lake.metrics().first()
    assert (record.status, record.dbt_tests_failed) == ("FAILED", 1)
    assert lake.detected_anomalies().count() == 0
    recorded = run(spark, tmp_path / "lake", tmp_path / "feed", hour, "r2", gate=False, check_everything=True)
    assert (recorded.status, recorded.dbt_tests_passed, recorded.dbt_tests_failed) == ("SUCCESS", 42, 1)


def test_rerun_finishes_what_a_crash_left_undone(spark, tmp_path, monkeypatch):
    hour = datetime(2024, 1, 5, 7)
    write_feed(tmp_path / "feed/2024-01-05-7.json.gz", hour_messages(hour, 12))

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "build_models", crash)
        with pytest.raises(RuntimeError):
            run(spark, tmp_path / "lake", tmp_path / "feed", hour, "r1")
    lake = Lake(spark, str(tmp_path / "lake"))
    assert (lake.raw().count(), lake.day_table("repo_days").count()) == (12, 0)
    assert run(spark, tmp_path / "lake", tmp_path / "feed", hour, "r1").rows_ingested == 12
    assert lake.raw().count() == 12


def test_hour_without_a_feed_file(spark, tmp_path):
    record = run(spark, tmp_path / "lake", tmp_path / "feed", datetime(2024, 1, 5, 7), "r1")
    assert (record.rows_ingested, record.status) == (0, "SUCCESS")


def test_stragglers_and_undated_events_of_a_feed_file_are_loaded(spark, tmp_path):
    """Six events of one file: this hour's, older ones, a later one and one without a time."""
    times = ["2024-01-05T07:10:00Z", "2024-01-05T06:10:00Z", "2024-01-05T02:10:00Z", "2024-01-05T08:00:00Z", "bad",
             "2024-01-04T07:10:00Z"]
    write_feed(tmp_path / "feed" / "2024-01-05-7.json.gz", [message(str(i + 1), at=t) for i, t in enumerate(times)])
    root = str(tmp_path / "lake")
    run_hour(spark, root, str(tmp_path / "feed"), datetime(2024, 1, 5, 7), datetime(2024, 1, 5, 9), "r1", gate=False)
    lake = Lake(spark, root)
    loaded = {r.id for r in lake.raw().select("id").collect()}
    aside = tmp_path / "lake" / "quarantine" / "rows"
    if aside.exists():
        loaded |= {r.id for r in spark.read.parquet(str(aside)).select("id").collect()}
    assert loaded == {1, 2, 3, 4, 5, 6}


def test_a_failing_batch_leaves_a_failed_row_with_its_input(spark, tmp_path, monkeypatch):
    from eventloom.operators import load

    hour = datetime(2024, 1, 5, 7)
    write_feed(tmp_path / "feed/2024-01-05-7.json.gz", hour_messages(hour, 12))

    def crash(*_):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(load, "insert_if_absent", crash)
        with pytest.raises(Exception, match="after reading 12 rows"):
            run(spark, tmp_path / "lake", tmp_path / "feed", hour, "r1")
    lake = Lake(spark, str(tmp_path / "lake"))
    assert [(r.status, r.rows_ingested) for r in lake.metrics().collect()] == [("FAILED", 12)]
    assert run(spark, tmp_path / "lake", tmp_path / "feed", hour, "r2").status == "SUCCESS"
    batches = spark.read.parquet(lake.path("observability/stream_metrics")).orderBy("run_id").collect()
    assert [(r.run_id.split("/")[0], r.status, r.rows_ingested) for r in batches] == [
        ("r1", "FAILED", 12), ("r2", "SUCCESS", 12)
    ]
    assert lake.waiting() == [] and lake.raw().count() == 12


def test_rows_that_break_a_contract_are_set_aside(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = [("ok", 1), ("x" * 101, 1), (None, 1), ("no count", None)]
    made = spark.createDataFrame(rows, "run_id string, rows_ingested bigint").withColumns({
        "dag_run_timestamp": F.lit("2024-01-01 00:00:00"), "status": F.lit("SUCCESS"),
        "run_timestamp": F.lit("2024-01-01 00:00:00"), "extra": F.lit(1),
    })
    for _ in range(2):
        pipeline.record_run(lake, made)
    assert [r.run_id for r in lake.metrics().collect()] == ["ok", "ok"]
    aside = spark.read.parquet(lake.path("quarantine/pipeline_metrics"))
    assert sorted(r.reason for r in aside.collect()) == [
        "rows_ingested missing", "run_id longer than 100", "run_id missing"
    ]
