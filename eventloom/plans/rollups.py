"""Per-repository and per-actor rollups.

All repository rollups share a grain and a source, so they are written as one
list of mergeable measures (counts, sums, maxima).  ``repo_state`` aggregates
any of them straight from events; the same measures kept per day
(``grain=("repo_id", "event_date")``) merge to the same totals, which is what
lets a run recompute only the days a load touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.jsonfields import (
    has_actor, has_repo, with_actor, with_payload, with_repo,
)
from eventloom.functions.timeparse import hours_between, parse_event_ts
from eventloom.operators.latest import recency

# Demo offset of the star bucket, bucket bounds and fallback languages (fixed values).
STAR_OFFSET = 1200
STAR_BUCKETS = [(10, "0-10"), (100, "11-100"), (1000, "101-1000")]
STAR_BUCKET_TOP = "1000+"
FALLBACK_LANGUAGES = ["Python", "JavaScript", "Go", "Java"]
FALLBACK_LANGUAGE_ELSE = "Rust"
FALLBACK_DESCRIPTION = "Description default for repository "

def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _repo_rows(events: DataFrame) -> DataFrame:
    rows = with_payload(with_repo(with_actor(events)))
    return rows.withColumns({"event_date": F.to_date("event_at"), "has_repo": has_repo(rows)})


def _issue_hours() -> Column:
    return F.when(
        _is("IssuesEvent") & (F.col("details.action") == "closed"),
        hours_between(
            parse_event_ts(F.col("details.issue.created_at")), parse_event_ts(F.col("details.issue.closed_at"))
        ),
    )


def _pr(action: str, merged: bool | None = None) -> Column:
    hit = _is("PullRequestEvent") & (F.col("details.action") == action)
    if merged is None:
        return hit
    return hit & (F.col("details.pull_request.merged").try_cast("boolean") == F.lit(merged))


def _merge_hours() -> Column:
    return F.when(
        _pr("closed", merged=True),
        hours_between(
            parse_event_ts(F.col("details.pull_request.created_at")),
            parse_event_ts(F.col("details.pull_request.merged_at")),
        ),
    )


# name -> (value per event, how values combine)
REPO_MEASURES = {
    "total_events": (lambda: F.lit(1), "count"),
    "star_count": (lambda: _is("WatchEvent"), "count_if"),
    "push_count": (lambda: _is("PushEvent"), "count_if"),
    "pr_count": (lambda: _is("PullRequestEvent"), "count_if"),
    "issue_count": (lambda: _is("IssuesEvent"), "count_if"),
    "last_event_at": (lambda: F.col("event_at"), "max"),
    "last_starred_at": (lambda: F.when(_is("WatchEvent"), F.col("event_at")), "max"),
    "last_pushed_at": (lambda: F.when(_is("PushEvent"), F.col("event_at")), "max"),
    "commit_count": (
        lambda: F.when(_is("PushEvent"), F.coalesce(F.col("details.size").try_cast("int"), F.lit(0))),
        "sum",
    ),
    "opened_issues_count": (
        lambda: _is("IssuesEvent") & (F.col("details.action") == "opened"), "count_if"
    ),
    "closed_issues_count": (
        lambda: _is("IssuesEvent") & (F.col("details.action") == "closed"), "count_if"
    ),
    "issue_hours": (_issue_hours, "sum"),
    "issue_hours_n": (_issue_hours, "count"),
    "prs_opened_count": (lambda: _pr("opened"), "count_if"),
    "prs_merged_count": (lambda: _pr("closed", merged=True), "count_if"),
    "prs_closed_count": (lambda: _pr("closed", merged=False), "count_if"),
    "merge_hours": (_merge_hours, "sum"),
    "merge_hours_n": (_merge_hours, "count"),
    "latest": (
        lambda: recency(repo_name=F.col("repo_name"), language=F.col("details.language")), "max"
    ),
    "latest_named": (
        lambda: recency(F.col("has_repo"), repo_name=F.col("repo_name")), "max"
    ),
    "latest_create": (
        lambda: recency(
            _is("CreateEvent") & F.col("details.description").isNotNull(),
            description=F.col("details.description"),
        ),
        "max",
    ),
}

ACTOR_MEASURES = {
    "total_events": (lambda: F.lit(1), "count"),
    "push_count": (lambda: _is("PushEvent"), "count_if"),
    "watch_count": (lambda: _is("WatchEvent"), "count_if"),
    "pr_count": (lambda: _is("PullRequestEvent"), "count_if"),
    "issue_count": (lambda: _is("IssuesEvent"), "count_if"),
    "last_active_at": (lambda: F.col("event_at"), "max"),
    "latest_named": (
        lambda: recency(
            actor_login=F.col("actor_login"), actor_avatar_url=F.col("actor_avatar_url")
        ),
        "max",
    ),
}

DAILY_REPO = ["total_events", "star_count", "push_count", "pr_count", "issue_count", "latest_named"]
DAILY_ACTOR = [
    "total_events", "push_count", "watch_count", "pr_count", "issue_count",
    "last_active_at", "latest_named",
]
WATCH = ["star_count", "last_starred_at"]
PUSH = ["push_count", "commit_count", "last_pushed_at"]
ISSUE = ["opened_issues_count", "closed_issues_count", "issue_hours", "issue_hours_n"]
PULL_REQUEST = [
    "prs_opened_count", "prs_merged_count", "prs_closed_count", "merge_hours", "merge_hours_n"
]
PROFILE = [*WATCH, *PUSH, *ISSUE, *PULL_REQUEST, "latest", "latest_create"]


def _aggregate(measures: dict, names: Sequence[str]) -> list[Column]:
    return [getattr(F, how)(value()).alias(n) for n in names for value, how in [measures[n]]]


def _merge(measures: dict, names: Sequence[str]) -> list[Column]:
    return [
        (F.max(n) if measures[n][1] == "max" else F.sum(n)).alias(n) for n in names
    ]


def repo_state(
    events: DataFrame, names: Sequence[str], grain: Sequence[str] = ("repo_id",), *extra: Column
) -> DataFrame:
    """The named repository measures at ``grain``, from events, in one pass."""
    return _repo_rows(events).groupBy(*grain).agg(*_aggregate(REPO_MEASURES, names), *extra)


def merge_repo_state(
    parts: DataFrame, names: Sequence[str], keys: Sequence[str] = ("repo_id",)
) -> DataFrame:
    """One row of measures per ``keys`` from rows kept at a finer grain, or several of one."""
    return parts.groupBy(*keys).agg(*_merge(REPO_MEASURES, names))


def actor_state(
    events: DataFrame, names: Sequence[str], grain: Sequence[str] = ("actor_id",)
) -> DataFrame:
    rows = with_actor(events.filter(has_actor(events)))
    rows = rows.withColumn("event_date", F.to_date("event_at"))
    return rows.groupBy(*grain).agg(*_aggregate(ACTOR_MEASURES, names))


def merge_actor_state(
    parts: DataFrame, names: Sequence[str], keys: Sequence[str] = ("actor_id",)
) -> DataFrame:
    return parts.groupBy(*keys).agg(*_merge(ACTOR_MEASURES, names))


def _distinct_pushers() -> Column:
    return F.count_distinct(F.when(_is("PushEvent"), F.col("actor_id"))).alias("unique_pushers")


def _or_zero_for_no_key(value: Column, default: object = 0) -> Column:
    """Rollups reach the repository list by an equality join, which a NULL key
    never passes; its row carries the defaults."""
    return F.when(F.col("repo_id").isNotNull(), value).otherwise(F.lit(default))


def _average(total: str, n: str) -> Column:
    mean = F.when(F.col(n) > 0, F.col(total) / F.col(n))
    return F.coalesce(_or_zero_for_no_key(mean, 0.0), F.lit(0.0))


def star_bucket(stars: Column, offset: int = STAR_OFFSET) -> Column:
    """Bucket of the star count plus ``repo_id % offset`` (0 switches it off)."""
    shifted = stars + F.col("repo_id") % offset if offset else stars
    bucket = F
    for bound, label in STAR_BUCKETS:
        bucket = bucket.when(shifted <= bound, label)
    return bucket.otherwise(STAR_BUCKET_TOP)


def fallback_language() -> Column:
    choice = F
    for remainder, language in enumerate(FALLBACK_LANGUAGES):
        choice = choice.when(F.col("repo_id") % 5 == remainder, language)
    return choice.otherwise(FALLBACK_LANGUAGE_ELSE)


def watch_stats(state: DataFrame, as_of: datetime, offset: int = STAR_OFFSET) -> DataFrame:
    stars = _or_zero_for_no_key(F.col("star_count"))
    return state.select(
        "repo_id",
        stars.alias("star_count"),
        F.coalesce(
            _or_zero_for_no_key(F.col("last_starred_at"), None), F.lit(as_of).cast("timestamp")
        ).alias("last_starred_at"),
        star_bucket(stars, offset).alias("star_count_bucket"),
    )


def push_stats(state: DataFrame) -> DataFrame:
    return state.select(
        "repo_id",
        _or_zero_for_no_key(F.col("push_count")).alias("push_count"),
        F.coalesce(_or_zero_for_no_key(F.col("commit_count")), F.lit(0)).alias("commit_count"),
        _or_zero_for_no_key(F.col("unique_pushers")).alias("unique_pushers"),
        _or_zero_for_no_key(F.col("last_pushed_at"), None).alias("last_pushed_at"),
    )


def issue_stats(state: DataFrame) -> DataFrame:
    return state.select(
        "repo_id",
        _or_zero_for_no_key(F.col("opened_issues_count")).alias("opened_issues_count"),
        _or_zero_for_no_key(F.col("closed_issues_count")).alias("closed_issues_count"),
        _average("issue_hours", "issue_hours_n").alias("average_resolution_hours"),
    )


def pr_stats(state: DataFrame) -> DataFrame:
    return state.select(
        "repo_id",
        _or_zero_for_no_key(F.col("prs_opened_count")).alias("prs_opened_count"),
        _or_zero_for_no_key(F.col("prs_merged_count")).alias("prs_merged_count"),
        _or_zero_for_no_key(F.col("prs_closed_count")).alias("prs_closed_count"),
        _average("merge_hours", "merge_hours_n").alias("average_merge_hours"),
    )


def languages(state: DataFrame) -> DataFrame:
    """Language of the latest event, else a fallback chosen by repository id."""
    return state.select(
        "repo_id",
        F.coalesce("latest.language", fallback_language()).alias("primary_language"),
        F.col("latest.event_at").alias("updated_at"),
    )


def descriptions(state: DataFrame) -> DataFrame:
    """Latest description given on a create event, else one made of the name."""
    given = _or_zero_for_no_key(F.col("latest_create"), None)
    default = F.concat(F.lit(FALLBACK_DESCRIPTION), F.col("latest.repo_name"))
    return state.select(
        "repo_id",
        F.coalesce(given["description"], default).alias("description"),
        F.coalesce(given["event_at"], F.col("latest.event_at")).alias("updated_at"),
    )


def repo_watch_stats(events: DataFrame, as_of: datetime, offset: int = STAR_OFFSET) -> DataFrame:
    return watch_stats(repo_state(events, WATCH), as_of, offset)


def repo_push_stats(events: DataFrame) -> DataFrame:
    return push_stats(repo_state(events, PUSH, ("repo_id",), _distinct_pushers()))


def repo_issue_stats(events: DataFrame) -> DataFrame:
    return issue_stats(repo_state(events, ISSUE))


def repo_pr_stats(events: DataFrame) -> DataFrame:
    return pr_stats(repo_state(events, PULL_REQUEST))


def repo_languages(events: DataFrame) -> DataFrame:
    return languages(repo_state(events, ["latest"]))


def repo_descriptions(events: DataFrame) -> DataFrame:
    return descriptions(repo_state(events, ["latest", "latest_create"]))


def actor_activities(state: DataFrame) -> DataFrame:
    return state.select(
        "actor_id",
        "total_events",
        F.col("push_count").alias("push_events_count"),
        F.col("watch_count").alias("watch_events_count"),
        F.col("pr_count").alias("pull_request_events_count"),
        F.col("issue_count").alias("issues_events_count"),
        "last_active_at",
    )


def actor_rollup(events: DataFrame) -> DataFrame:
    names = [n for n in DAILY_ACTOR if n != "latest_named"]
    return actor_activities(actor_state(events, names))


def profile_rows(
    state: DataFrame, as_of: datetime, offset: int = STAR_OFFSET, newest: str = "latest"
) -> DataFrame:
    """The wide repository row from one row of measures per repository.

    ``state`` already holds the group set the separate rollups would be joined
    on, so the six joins of the relational form are column expressions here.
    """
    keyed = F.col("repo_id").isNotNull()
    bucket = star_bucket(F.col("star_count"), offset)
    language = F.coalesce("latest.language", fallback_language())
    description = F.coalesce(
        "latest_create.description", F.concat(F.lit(FALLBACK_DESCRIPTION), F.col("latest.repo_name"))
    )
    wide = state.select(
        "repo_id",
        F.col(f"{newest}.repo_name").alias("repo_name"),
        F.when(keyed, language).otherwise("Unknown").alias("primary_language"),
        F.when(keyed, F.coalesce(description, F.lit(""))).otherwise("").alias("description"),
        _or_zero_for_no_key(F.col("star_count")).alias("star_count"),
        F.when(keyed, bucket).otherwise(STAR_BUCKETS[0][1]).alias("star_count_bucket"),
        _or_zero_for_no_key(F.col("push_count")).alias("push_count"),
        F.coalesce(_or_zero_for_no_key(F.col("commit_count")), F.lit(0)).alias("commit_count"),
        _or_zero_for_no_key(F.col("unique_pushers")).alias("unique_pushers"),
        _or_zero_for_no_key(F.col("opened_issues_count")).alias("opened_issues_count"),
        _or_zero_for_no_key(F.col("closed_issues_count")).alias("closed_issues_count"),
        _average("issue_hours", "issue_hours_n").alias("average_resolution_hours"),
        _or_zero_for_no_key(F.col("prs_opened_count")).alias("prs_opened_count"),
        _or_zero_for_no_key(F.col("prs_merged_count")).alias("prs_merged_count"),
        _or_zero_for_no_key(F.col("prs_closed_count")).alias("prs_closed_count"),
        _average("merge_hours", "merge_hours_n").alias("average_merge_hours"),
    )
    return wide.withColumn("processed_at", F.lit(as_of).cast("timestamp"))


def repo_profile(events: DataFrame, as_of: datetime, offset: int = STAR_OFFSET) -> DataFrame:
    """One wide row per repository, from events in a single pass."""
    named = events.filter(has_repo(events))
    return profile_rows(repo_state(named, PROFILE, ("repo_id",), _distinct_pushers()), as_of, offset)


# Measures kept per repository and day: everything the profile and the daily facts need.
REPO_DAY = list(dict.fromkeys([*DAILY_REPO, "last_event_at", *PROFILE]))


def repo_days(events: DataFrame, names: Sequence[str] = REPO_DAY) -> DataFrame:
    return repo_state(events, names, ("repo_id", "event_date"))


def actor_days(events: DataFrame, names: Sequence[str] = DAILY_ACTOR) -> DataFrame:
    return actor_state(events, names, ("actor_id", "event_date"))


def repo_pushers(events: DataFrame, *grain: str) -> DataFrame:
    """Who pushed to a repository, as exact bitmaps: a bit per actor id.

    ``slot`` is the run of 32,768 ids a bitmap stands for, so a repository has at most
    one row per run, however many pushes; bitmaps of parts (days, loads) unite bit by bit,
    which keeps distinct counts mergeable.  A bitmap is 4 kB in memory and, being mostly
    zeros for a repository of few actors, some tens of bytes in a compressed file.
    """
    pushes = with_repo(with_actor(events.filter(_is("PushEvent")))).filter(F.col("actor_id").isNotNull())
    pushes = pushes.withColumn("event_date", F.to_date("event_at"))
    return pushes.groupBy("repo_id", *grain, F.bitmap_bucket_number("actor_id").alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("actor_id")).alias("bits")
    )


def repo_day_pushers(events: DataFrame) -> DataFrame:
    """The bitmaps per repository and day."""
    return repo_pushers(events, "event_date")


def merge_pushers(parts: DataFrame) -> DataFrame:
    """The bitmaps of each repository, united over days or loads."""
    return parts.groupBy("repo_id", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_pushers(bitmaps: DataFrame) -> DataFrame:
    """``repo_id, unique_pushers`` from united bitmaps."""
    return bitmaps.groupBy("repo_id").agg(F.sum(F.bitmap_count("bits")).alias("unique_pushers"))


def with_pushers(totals: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Totals with the number of distinct pushers, 0 where nobody pushed."""
    counted = count_pushers(bitmaps).withColumnRenamed("repo_id", "_repo")
    return (
        totals.join(counted, F.col("repo_id").eqNullSafe(F.col("_repo")), "left")
        .withColumn("unique_pushers", F.coalesce("unique_pushers", F.lit(0))).drop("_repo")
    )


def repo_totals(days: DataFrame, pushers: DataFrame) -> DataFrame:
    """Every repository measure over all days; one row per repository."""
    return with_pushers(merge_repo_state(days, REPO_DAY), merge_pushers(pushers))


def profile_from_totals(totals: DataFrame, as_of: datetime, offset: int = STAR_OFFSET) -> DataFrame:
    """The same rows as :func:`repo_profile`, from the totals per repository."""
    # Events without any repository share the NULL key; they make no profile.
    known = totals.filter(F.col("latest_named").isNotNull())
    return profile_rows(known, as_of, offset, newest="latest_named")


def newest_over(key: str) -> Column:
    """Newest name entry of a key over its days.  A key has one row per day, so
    the window holds no more rows than the history has days."""
    return F.max("latest_named").over(Window.partitionBy(key))
