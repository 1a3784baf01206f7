"""Facts, dimensions and ranked marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.jsonfields import with_actor, with_repo
from eventloom.operators.ranking import global_rank, top_k_with_ties
from eventloom.plans.rollups import (
    DAILY_ACTOR,
    DAILY_REPO,
    actor_days,
    actor_state,
    newest_over,
    repo_days,
)
from eventloom.session import stage_table

CONTRIBUTOR_RANKS = 100


def fact_events(events: DataFrame, *keep: str) -> DataFrame:
    return with_repo(with_actor(events)).select(
        "event_id", "event_type", "actor_id", "repo_id",
        F.to_date("event_at").alias("date_id"),
        "event_at", "is_public", "loaded_at", *keep,
    )


def fct_repo_stars(watch_events: DataFrame, *keep: str) -> DataFrame:
    return watch_events.select(
        "event_id", "repo_id", "actor_id", F.col("event_at").alias("starred_at"), *keep
    )


def daily_repo_from_days(days: DataFrame) -> DataFrame:
    """Daily facts with the repository's latest name over the whole history.

    The name travels inside the daily measures, so attaching it needs neither a
    second scan of the events nor a join.
    """
    named = days.withColumn("_newest", newest_over("repo_id"))
    return named.select(
        "repo_id",
        F.when(F.col("repo_id").isNotNull(), F.col("_newest.repo_name")).alias("repo_name"),
        "event_date", "total_events", "star_count", "push_count", "pr_count", "issue_count",
    )


def daily_repo_view(days: DataFrame, totals: DataFrame) -> DataFrame:
    """The same facts with the name taken from the totals per repository.

    No window over all days: a filter on ``event_date`` reaches the scan of ``days``
    and prunes its partitions; ``totals`` has one row per repository.
    """
    names = totals.select(F.col("repo_id").alias("_repo"), F.col("latest_named.repo_name").alias("repo_name"))
    return days.join(names, F.col("repo_id") == F.col("_repo"), "left").select(
        "repo_id", "repo_name", "event_date", "total_events", "star_count", "push_count", "pr_count", "issue_count",
    )


def daily_actor_view(days: DataFrame, totals: DataFrame) -> DataFrame:
    """The daily facts per actor, named and pruned as in :func:`daily_repo_view`."""
    names = totals.select(F.col("actor_id").alias("_actor"), F.col("latest_named.actor_login").alias("actor_login"))
    return days.join(names, F.col("actor_id") == F.col("_actor"), "left").select(
        "actor_id", "actor_login", "event_date", "total_events", "push_count", "watch_count", "pr_count", "issue_count",
    )


def daily_repo(events: DataFrame) -> DataFrame:
    return daily_repo_from_days(repo_days(events, DAILY_REPO))


def daily_actor_from_days(days: DataFrame) -> DataFrame:
    named = days.withColumn("_newest", newest_over("actor_id"))
    return named.select(
        "actor_id",
        F.when(F.col("actor_id").isNotNull(), F.col("_newest.actor_login")).alias("actor_login"),
        "event_date", "total_events", "push_count", "watch_count", "pr_count", "issue_count",
    )


def daily_actor(events: DataFrame) -> DataFrame:
    return daily_actor_from_days(actor_days(events))


def dim_actor_rows(state: DataFrame) -> DataFrame:
    def counted(name: str):
        return F.when(F.col("actor_id").isNotNull(), F.col(name)).otherwise(F.lit(0))

    return state.select(
        "actor_id",
        "latest_named.actor_login",
        "latest_named.actor_avatar_url",
        counted("total_events").alias("total_events_created"),
        counted("push_count").alias("push_events_created"),
        counted("watch_count").alias("watch_events_created"),
        counted("pr_count").alias("pr_events_created"),
        counted("issue_count").alias("issues_events_created"),
        F.col("latest_named.event_at").alias("last_event_at"),
    )


def dim_actor(events: DataFrame) -> DataFrame:
    """Type-1 actor dimension: latest attributes and totals, in one pass."""
    return dim_actor_rows(actor_state(events, DAILY_ACTOR))


def dim_repo(history: DataFrame) -> DataFrame:
    """Type-2 repository dimension over the version history."""
    return history.select(
        "repo_id", "repo_name", "primary_language", "description", "star_count_bucket",
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )


REPO_SUMS = {
    "total_events": "total_events", "star_count": "star_growth",
    "push_count": "push_growth", "pr_count": "pr_growth",
}
ACTOR_SUMS = ["total_events", "push_count", "watch_count", "pr_count", "issue_count"]
LANGUAGE_SUMS = ["total_events", "star_count", "push_count", "pr_count"]


def rank_repos(totals: DataFrame) -> DataFrame:
    """Repositories ranked by events and by stars; ``totals`` must be a table."""
    return global_rank(totals, {"total_events": "rank_total", "star_growth": "rank_stars"})


def trending_repos(daily: DataFrame) -> DataFrame:
    totals = daily.groupBy("repo_id", "repo_name").agg(
        *[F.sum(c).alias(name) for c, name in REPO_SUMS.items()]
    )
    return rank_repos(stage_table(totals, "repo-totals"))


def trending_from_totals(totals: DataFrame) -> DataFrame:
    """Trending repositories from the table of totals per repository."""
    keyed = F.col("repo_id").isNotNull()
    return rank_repos(totals.select(
        "repo_id", F.when(keyed, F.col("latest_named.repo_name")).alias("repo_name"),
        *[F.col(c).alias(name) for c, name in REPO_SUMS.items()],
    ))


def active_contributors(daily: DataFrame, k: int = CONTRIBUTOR_RANKS) -> DataFrame:
    totals = daily.groupBy("actor_id", "actor_login").agg(*[F.sum(c).alias(c) for c in ACTOR_SUMS])
    return top_k_with_ties(stage_table(totals, "actor-totals"), "total_events", k, "rank_activity")


def contributors_from_totals(totals: DataFrame, k: int = CONTRIBUTOR_RANKS) -> DataFrame:
    """Most active contributors from the table of totals per actor."""
    keyed = F.col("actor_id").isNotNull()
    return top_k_with_ties(
        totals.select(
            "actor_id", F.when(keyed, F.col("latest_named.actor_login")).alias("actor_login"), *ACTOR_SUMS
        ),
        "total_events", k, "rank_activity",
    )


def language_popularity(daily: DataFrame, repos: DataFrame) -> DataFrame:
    """Activity per language of the repository's current version.

    Daily facts fold to one row per repository before the join, so neither the
    join nor the per-language sums see a busy repository's days.
    """
    per_repo = daily.groupBy("repo_id").agg(*[F.sum(c).alias(c) for c in LANGUAGE_SUMS])
    return languages_from_totals(per_repo, repos)


def languages_from_totals(totals: DataFrame, repos: DataFrame) -> DataFrame:
    current = repos.filter("is_current").select(
        F.col("repo_id").alias("_repo"), "primary_language"
    )
    per_language = (
        totals.select("repo_id", *LANGUAGE_SUMS)
        .join(current, F.col("repo_id") == F.col("_repo"), "left")
        .groupBy("primary_language")
        .agg(*[F.sum(c).alias(c) for c in LANGUAGE_SUMS],
             F.count_distinct("_repo").alias("active_repos"))
    )
    # A row per language: few enough for one ordinary window.
    popular = Window.orderBy(F.col("total_events").desc_nulls_first())
    return per_language.withColumn("popularity_rank", F.rank().over(popular).cast("bigint"))
