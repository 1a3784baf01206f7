"""Staging, rollups, marts, quality, observability."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from eventloom.plans import marts, observe, quality, rollups, staging
from eventloom.plans.staging import stage
from eventloom.schemas import PIPELINE_METRICS
from eventloom.session import stage_table
from tests.conftest import event

AS_OF = datetime(2024, 2, 1)


def test_typed_views_accept_quoted_values_and_bad_json(staged):
    rows = [
        event(1, "PushEvent", payload={"push_id": "12", "size": "3", "ref": None}),
        event(2, "PushEvent", payload={"push_id": 13, "size": None, "ref": "main"}),
    ]
    bad = list(event(3, "PushEvent"))
    bad[5] = "{not json"
    out = {r.event_id: r for r in stage(staged([*rows, tuple(bad)]), "push").collect()}
    assert (out[1].push_id, out[1].commit_size, out[1].branch_ref) == (12, 3, None)
    assert (out[2].push_id, out[2].commit_size, out[2].branch_ref) == (13, None, "main")
    assert out[3].push_id is None and out[3].repo_id == 1


def test_view_filter_reaches_the_scan(spark, raw, tmp_path):
    raw([event(1), event(2, "PushEvent")]).write.parquet(str(tmp_path / "raw"))
    events = staging.stg_raw_events(spark.read.parquet(str(tmp_path / "raw")))
    plan = stage(events, "push")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(type,PushEvent)" in plan
    assert "org:string" not in plan.split("ReadSchema")[1]


def test_pr_states(staged):
    def pr(i, action, merged, merged_at=None):
        return event(i, "PullRequestEvent", payload={"action": action, "pull_request": {
            "id": i, "merged": merged, "created_at": "2024-01-01T00:00:00Z", "merged_at": merged_at}})

    rows = [
        pr(1, "opened", None), pr(2, "closed", True, "2024-01-01 06:00:00"), pr(3, "closed", False),
        pr(4, "closed", None), pr(5, "closed", True, None), event(6, repo=2),
    ]
    out = {r.repo_id: r for r in rollups.repo_pr_stats(staged(rows)).collect()}
    assert (out[1].prs_opened_count, out[1].prs_merged_count, out[1].prs_closed_count) == (1, 2, 1)
    assert out[1].average_merge_hours == 6.0
    assert (out[2].prs_merged_count, out[2].average_merge_hours) == (0, 0.0)


def test_star_buckets(spark):
    counts = [10, 11, 100, 101, 1000, 1001]
    df = spark.createDataFrame([(7, c) for c in counts], "repo_id bigint, n bigint")
    got = [r.b for r in df.select(rollups.star_bucket(F.col("n"), 0).alias("b")).collect()]
    assert got == ["0-10", "11-100", "11-100", "101-1000", "101-1000", "1000+"]
    shifted = df.select(rollups.star_bucket(F.col("n")).alias("b")).collect()
    assert shifted[0].b == "11-100"


def test_language_follows_the_latest_event_not_the_latest_language(staged):
    rows = [
        event(1, repo=6, at="2024-01-01T00:00:00Z", payload={"language": "Zig"}),
        event(2, repo=6, at="2024-01-02T00:00:00Z"),
        event(3, repo=7, at="2024-01-01T00:00:00Z", payload={"language": "Zig"}),
    ]
    out = {r.repo_id: r.primary_language for r in rollups.repo_languages(staged(rows)).collect()}
    assert out == {6: "JavaScript", 7: "Zig"}


def test_descriptions(staged):
    rows = [
        event(1, "CreateEvent", repo=1, at="2024-01-01T00:00:00Z", payload={"description": "old"}),
        event(2, "CreateEvent", repo=1, at="2024-01-02T00:00:00Z", payload={"description": None}),
        event(3, repo=2, name="org/two"),
    ]
    out = {r.repo_id: r.description for r in rollups.repo_descriptions(staged(rows)).collect()}
    assert out == {1: "old", 2: "Description default for repository org/two"}


def messy_events():
    rows = []
    types = ["WatchEvent", "PushEvent", "IssuesEvent", "PullRequestEvent", "CreateEvent", "ForkEvent"]
    for i in range(240):
        kind = types[i % 6]
        payload = {
            "PushEvent": {"push_id": i, "size": i % 4 or None},
            "IssuesEvent": {"action": ["opened", "closed"][i % 2 ^ (i // 6) % 2], "issue": {
                "id": i, "created_at": "2024-01-01T00:00:00Z", "closed_at": "2024-01-02T00:00:00Z"}},
            "PullRequestEvent": {"action": "closed", "pull_request": {
                "id": i, "merged": i % 4 == 3, "created_at": "2024-01-01T00:00:00Z",
                "merged_at": "2024-01-01T07:00:00Z"}},
            "CreateEvent": {"description": f"d{i}" if i % 4 else None},
        }.get(kind, {})
        if i % 5 == 0:
            payload["language"] = f"L{i % 3}"
        rows.append(event(
            i, kind, actor=None if i % 31 == 0 else i % 9, repo=None if i % 29 == 0 else i % 7,
            at=None if i % 83 == 0 else f"2024-01-{1 + i % 11:02d}T{i % 24:02d}:00:00Z",
            payload=payload, name=f"org/r{i % 7}-{i // 120}",
        ))
    # Objects without an id: a NULL key that is not a missing object.
    rows.append((1000, "WatchEvent", "{}", '{"name": "nameless"}', None, "{}", True, "2024-01-03T00:00:00Z"))
    return rows


def as_set(df):
    return sorted(map(str, df.collect()))


def test_profile_equals_the_six_joins(staged):
    """The single pass against the relational form it replaces."""
    events = staged(messy_events())
    joined = staging.stg_repos(events).select("repo_id", "repo_name")
    for part in (
        rollups.repo_languages(events).drop("updated_at"),
        rollups.repo_descriptions(events).drop("updated_at"),
        rollups.repo_watch_stats(events, AS_OF).drop("last_starred_at"),
        rollups.repo_push_stats(events).drop("last_pushed_at"),
        rollups.repo_issue_stats(events),
        rollups.repo_pr_stats(events),
    ):
        joined = joined.join(part, "repo_id", "left")
    defaults = {"primary_language": "Unknown", "description": "", "star_count_bucket": "0-10"}
    joined = joined.fillna(defaults).fillna(0, [
        c for c in joined.columns if c.endswith(("count", "hours", "pushers")) or c == "commit_count"
    ])
    profile = rollups.repo_profile(events, AS_OF).drop("processed_at")
    assert as_set(profile.select(*joined.columns)) == as_set(joined)


def test_profile_from_totals_equals_profile_from_events(staged):
    events = staged(messy_events())
    direct = rollups.repo_profile(events, AS_OF)
    totals = rollups.repo_totals(rollups.repo_days(events), rollups.repo_day_pushers(events))
    merged = rollups.profile_from_totals(totals, AS_OF)
    assert as_set(merged.select(*direct.columns)) == as_set(direct)


def test_marts_from_totals_equal_marts_from_daily_facts(staged):
    events = staged(messy_events())
    repos = stage_table(
        rollups.repo_totals(rollups.repo_days(events), rollups.repo_day_pushers(events))
    )
    actors = stage_table(rollups.merge_actor_state(rollups.actor_days(events), rollups.DAILY_ACTOR))
    daily = marts.daily_repo(events)
    dim = rollups.repo_profile(events, AS_OF).withColumn("is_current", F.lit(True))
    pairs = [
        (marts.trending_from_totals(repos), marts.trending_repos(daily)),
        (marts.contributors_from_totals(actors, 4), marts.active_contributors(marts.daily_actor(events), 4)),
        (marts.languages_from_totals(repos, dim), marts.language_popularity(daily, dim)),
    ]
    for from_totals, from_daily in pairs:
        assert as_set(from_totals) == as_set(from_daily)


def test_actor_dimension_from_days_equals_from_events(staged):
    events = staged(messy_events())
    merged = rollups.merge_actor_state(rollups.actor_days(events), rollups.DAILY_ACTOR)
    assert as_set(marts.dim_actor_rows(merged)) == as_set(marts.dim_actor(events))


def test_daily_counts_add_up_to_the_facts(staged):
    events = staged(messy_events())
    total = marts.daily_repo(events).agg(F.sum("total_events")).first()[0]
    assert total == marts.fact_events(events).count() == 241


def test_daily_name_is_the_latest_over_all_days(staged):
    rows = [
        event(1, name="old", at="2024-01-01T00:00:00Z"), event(2, name="new", at="2024-01-02T00:00:00Z"),
        event(3, repo=None, at="2024-01-01T00:00:00Z"),
    ]
    out = {(r.repo_id, r.event_date): r.repo_name for r in marts.daily_repo(staged(rows)).collect()}
    assert out == {
        (1, date(2024, 1, 1)): "new", (1, date(2024, 1, 2)): "new", (None, date(2024, 1, 1)): None,
    }


def test_language_popularity_keeps_unmatched_facts(spark, staged):
    daily = marts.daily_repo(staged([event(1, repo=1), event(2, repo=2), event(3, repo=None)]))
    dim = spark.createDataFrame(
        [(1, "Go", True), (2, "C", False)], "repo_id bigint, primary_language string, is_current boolean"
    )
    out = {r.primary_language: (r.total_events, r.active_repos, r.popularity_rank)
           for r in marts.language_popularity(daily, dim).collect()}
    assert out == {None: (2, 0, 1), "Go": (1, 1, 2)}


def test_checks_count_and_name_every_declared_test():
    assert sum(map(len, quality.NOT_NULL.values())) == 28
    assert 1 + len(quality.STAGED_UNIQUE) + len(quality.UNIQUE) == 11
    assert (len(quality.RELATIONSHIPS), len(quality.ASSERTIONS)) == (2, 2)


def test_relationships_ignore_null_and_count_rows(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    assert quality.relationships("c", child, "fk", parent, "id").first().failures == 2


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, None), (None, "a")], "k bigint, t string")
    rows = quality.unique(df, "k", {"all": None, "only_b": F.col("t") == "b"}).collect()
    assert {r.table: r.failures for r in rows} == {"all": 1, "only_b": 0}
    nulls = quality.not_null("t", df, ["k", "t"]).collect()
    assert {r.column: r.failures for r in nulls} == {"k": 2, "t": 1}


def test_assertions_find_bad_rows(spark):
    versions = spark.createDataFrame(
        [(1, AS_OF, None), (2, AS_OF, datetime(2024, 1, 1)), (3, AS_OF, AS_OF)],
        "repo_id bigint, valid_from timestamp, valid_to timestamp",
    )
    assert [r.repo_id for r in quality.bad_intervals(versions).collect()] == [2]
    stars = spark.createDataFrame([(1, -1), (2, 0)], "repo_id bigint, star_count bigint")
    assert [r.repo_id for r in quality.negative_stars(stars).collect()] == [1]


def test_rows_ingested_by_day_and_hour(raw):
    rows = raw([
        event(1, at="2024-01-05T07:00:00Z"), event(2, at="2024-01-05 07:30:00"),
        event(3, at="2024-01-05T08:00:00Z"), event(4, at="2024-01-06T07:00:00Z"),
    ])
    day = date(2024, 1, 5)
    assert observe.rows_ingested(rows, day).first().rows_ingested == 3
    assert observe.rows_ingested(rows, day, hour=7).first().rows_ingested == 2


def test_freshness_parses_before_comparing(staged):
    # As text the space form sorts before the T form of an earlier time.
    events = staged([event(1, at="2024-01-05T07:00:00Z"), event(2, at="2024-01-05 09:00:00")])
    assert observe.freshness(events, datetime(2024, 1, 5, 10)).first()[0] == 3600
    assert observe.freshness(events.limit(0), AS_OF).first()[0] == 0


@pytest.fixture
def metrics(spark):
    rows = [
        ("r1", datetime(2024, 1, 1), 10, 3599, 43, 0, 5, "SUCCESS", AS_OF),
        ("r2", datetime(2024, 1, 2), 20, 3600, 40, 3, 5, "FAILED", AS_OF),
        ("r3", datetime(2024, 1, 3), 30, 7200, 30, 13, 5, "FAILED", AS_OF),
    ]
    return spark.createDataFrame(rows, PIPELINE_METRICS)


def test_dashboard_queries(metrics):
    assert observe.total_rows(metrics).first().value == 60
    assert observe.latest_lag(metrics).first().value == 7200
    assert observe.latest_success(metrics).first().value == pytest.approx(30 / 43.00001 * 100)
    assert [r.freshness_lag for r in observe.lag_series(metrics).collect()] == [3599, 3600, 7200]
    assert [r.events_processed for r in observe.volume_series(metrics).collect()] == [10, 20, 30]
    assert [r.run_id for r in observe.run_log(metrics).collect()] == ["r3", "r2", "r1"]


def test_threshold_status(metrics):
    rows = observe.run_status(metrics).orderBy("run_id").collect()
    assert [r.lag_status for r in rows] == ["green", "yellow", "red"]
    assert [r.success_status for r in rows] == ["green", "yellow", "red"]


@pytest.mark.parametrize("view", list(staging.EVENT_VIEWS))
def test_views_over_variant_equal_views_over_text(staged, view):
    odd = [
        event(2000, "IssuesEvent", payload={"action": "opened", "issue": {"id": "7", "number": 1.5, "state": ["a", {"b": 1}]}}),
        event(2001, "PullRequestEvent", payload={"pull_request": {"id": 8, "merged": "true", "closed_at": "2024-01-01 00:00:00"}}),
        event(2002, "ReleaseEvent", payload={"release": {"id": 2**63 - 1, "tag_name": "v\"1é"}}),
        event(2003, "ForkEvent", payload={"forkee": "text"}), event(2004, "PushEvent", payload=[1]),
        (2005, "PushEvent", None, None, None, '{"push_id": 1, "push_id": 2, "size": null}', True, "2024-01-01T00:00:00Z"),
        (2006, "PushEvent", None, None, None, "{broken", True, "2024-01-01T00:00:00Z"),
        (2007, "PushEvent", None, None, None, None, True, "2024-01-01T00:00:00Z"),
        *[event(2010 + i, t) for i, t in enumerate(("GollumEvent", "PublicEvent", "PullRequestReviewEvent", "IssueCommentEvent"))],
    ]
    events = staged(messy_events() + odd)
    typed = stage_table(staging.typed_events(events))
    by_variant = stage(typed, view)
    assert brief(by_variant) == brief(stage(events, view)) != []
    assert "from_json" not in by_variant._jdf.queryExecution().executedPlan().toString().lower()


def brief(df):
    return sorted(map(str, df.collect()))
