"""Staging models: the renamed raw table and one typed view per event type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.jsonfields import (
    has_actor, has_repo, members, variant_text, with_actor, with_payload, with_repo,
)
from eventloom.functions.timeparse import parse_event_ts
from eventloom.operators.latest import latest_per_key


def stg_raw_events(raw: DataFrame, *keep: str) -> DataFrame:
    """Raw table renamed, with the event time parsed; ``keep`` adds columns as is."""
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor").alias("raw_actor"),
        F.col("repo").alias("raw_repo"),
        F.col("org").alias("raw_org"),
        F.col("payload").alias("raw_payload"),
        F.col("public").alias("is_public"),
        parse_event_ts(F.col("created_at")).alias("event_at"),
        "loaded_at",
        *keep,
    )


@dataclass(frozen=True)
class EventView:
    """One typed view: which event types, which payload members, which columns."""

    types: tuple[str, ...]
    payload: str | None = None
    columns: tuple[tuple[str, str, str], ...] = ()  # (output, payload path, type)


# Event types and payload members of each typed view (fixed values).
EVENT_VIEWS = {
    "watch": EventView(("WatchEvent",), "action string", (("action", "action", "string"),)),
    "push": EventView(
        ("PushEvent",),
        "push_id string, size string, distinct_size string, ref string",
        (
            ("push_id", "push_id", "bigint"),
            ("commit_size", "size", "int"),
            ("distinct_commit_size", "distinct_size", "int"),
            ("branch_ref", "ref", "string"),
        ),
    ),
    "create": EventView(
        ("CreateEvent",),
        "ref_type string, ref string, master_branch string, description string",
        (
            ("ref_type", "ref_type", "string"),
            ("ref_name", "ref", "string"),
            ("master_branch", "master_branch", "string"),
            ("description", "description", "string"),
        ),
    ),
    "fork": EventView(
        ("ForkEvent",),
        "forkee struct<id: string, full_name: string>",
        (("forkee_id", "forkee.id", "bigint"), ("forkee_name", "forkee.full_name", "string")),
    ),
    "issues": EventView(
        ("IssuesEvent",),
        "action string, issue struct<id: string, number: string, state: string,"
        " created_at: string, closed_at: string>",
        (
            ("action", "action", "string"),
            ("issue_id", "issue.id", "bigint"),
            ("issue_number", "issue.number", "int"),
            ("issue_state", "issue.state", "string"),
            ("issue_created_at", "issue.created_at", "timestamp"),
            ("issue_closed_at", "issue.closed_at", "timestamp"),
        ),
    ),
    "issue_comment": EventView(
        ("IssueCommentEvent",),
        "action string, issue struct<id: string>, comment struct<id: string>",
        (
            ("action", "action", "string"),
            ("issue_id", "issue.id", "bigint"),
            ("comment_id", "comment.id", "bigint"),
        ),
    ),
    "pull_request": EventView(
        ("PullRequestEvent",),
        "action string, pull_request struct<id: string, number: string, state: string,"
        " merged: string, created_at: string, closed_at: string, merged_at: string>",
        (
            ("action", "action", "string"),
            ("pr_id", "pull_request.id", "bigint"),
            ("pr_number", "pull_request.number", "int"),
            ("pr_state", "pull_request.state", "string"),
            ("is_merged", "pull_request.merged", "boolean"),
            ("pr_created_at", "pull_request.created_at", "timestamp"),
            ("pr_closed_at", "pull_request.closed_at", "timestamp"),
            ("pr_merged_at", "pull_request.merged_at", "timestamp"),
        ),
    ),
    "pull_request_review": EventView(
        ("PullRequestReviewCommentEvent", "PullRequestReviewEvent"),
        "action string, pull_request struct<id: string>",
        (("action", "action", "string"), ("pr_id", "pull_request.id", "bigint")),
    ),
    "release": EventView(
        ("ReleaseEvent",),
        "action string, release struct<id: string, tag_name: string>",
        (
            ("action", "action", "string"),
            ("release_id", "release.id", "bigint"),
            ("tag_name", "release.tag_name", "string"),
        ),
    ),
    "gollum": EventView(("GollumEvent",)),
    "public": EventView(("PublicEvent",)),
}


def _typed(path: str, type_name: str, parsed: bool) -> Column:
    text = variant_text(F.col("payload"), path) if parsed else F.col(f"_payload.{path}")
    if type_name == "string":
        return text
    if type_name == "timestamp":
        return parse_event_ts(text)
    return text.try_cast(type_name)


def stage(events: DataFrame, view: str) -> DataFrame:
    """The typed view ``view`` over staged raw events.

    The filter on ``event_type`` comes first, so it reaches the scan and the
    payload of other types is never parsed.  Over :func:`typed_events` no text is
    parsed at all: members come from the payload's VARIANT.
    """
    spec = EVENT_VIEWS[view]
    parsed = "payload" in events.columns
    rows = with_repo(with_actor(events.filter(F.col("event_type").isin(*spec.types))))
    if spec.payload and not parsed:
        rows = rows.withColumn("_payload", members(F.col("raw_payload"), spec.payload))
    return rows.select(
        "event_id", "event_type", "actor_id", "repo_id",
        *[_typed(path, type_name, parsed).alias(name) for name, path, type_name in spec.columns],
        "event_at",
    )


def stg_repos(events: DataFrame) -> DataFrame:
    """Latest name per repository."""
    named = with_repo(events.filter(has_repo(events)))
    return latest_per_key(named, ["repo_id"], ["repo_name"]).withColumnRenamed(
        "event_at", "last_event_at"
    )


def stg_actors(events: DataFrame) -> DataFrame:
    """Latest login and avatar per actor."""
    named = with_actor(events.filter(has_actor(events)))
    return latest_per_key(
        named, ["actor_id"], ["actor_login", "actor_avatar_url"]
    ).withColumnRenamed("event_at", "last_event_at")


def typed_events(events: DataFrame, *keep: str) -> DataFrame:
    """Staged events with every JSON member the models read as a column.

    Parsing JSON is most of the cost of a model.  Written once, this table lets
    all of them share one parse; ``payload`` keeps the whole object as VARIANT for
    the members that only a typed view reads.
    """
    typed = events.withColumns({"has_actor": has_actor(events), "has_repo": has_repo(events)})
    return with_payload(with_repo(with_actor(typed))).select(
        "event_id", "event_type", "has_actor", "actor_id", "actor_login", "actor_avatar_url",
        "has_repo", "repo_id", "repo_name", "is_public", "event_at", "loaded_at", "details",
        F.try_parse_json("raw_payload").alias("payload"),
        F.to_date("event_at").alias("event_date"), *keep,
    )
