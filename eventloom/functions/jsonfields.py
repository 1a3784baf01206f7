"""Typed access to members of JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Members read from the actor and repo objects (fixed values).
ACTOR_MEMBERS = "id string, login string, avatar_url string"
REPO_MEMBERS = "id string, name string"


def members(text: Column, ddl: str) -> Column:
    """One parse of ``text`` for all the members a model reads.

    Leaves are declared as text and cast afterwards: a typed leaf would turn a
    quoted number or boolean into NULL.
    """
    return F.from_json(text, ddl)


def variant_text(value: Column, path: str) -> Column:
    """The member at ``path`` as text, as :func:`members` gives it; NULL if absent.

    Objects and arrays come as JSON text, other values as their plain text.
    """
    member = F.try_variant_get(value, f"$.{path}", "variant")
    nested = F.schema_of_variant(member).rlike("^(OBJECT|ARRAY)")
    return F.when(nested, F.to_json(member)).otherwise(member.try_cast("string"))


def with_actor(events: DataFrame) -> DataFrame:
    """Add ``actor_id, actor_login, actor_avatar_url`` unless already typed."""
    if "actor_id" in events.columns:
        return events
    return (
        events.withColumn("_actor", members(F.col("raw_actor"), ACTOR_MEMBERS))
        .withColumns({
            "actor_id": F.col("_actor.id").try_cast("bigint"),
            "actor_login": F.col("_actor.login"),
            "actor_avatar_url": F.col("_actor.avatar_url"),
        })
        .drop("_actor")
    )


def with_repo(events: DataFrame) -> DataFrame:
    """Add ``repo_id, repo_name`` unless already typed."""
    if "repo_id" in events.columns:
        return events
    return (
        events.withColumn("_repo", members(F.col("raw_repo"), REPO_MEMBERS))
        .withColumns({
            "repo_id": F.col("_repo.id").try_cast("bigint"),
            "repo_name": F.col("_repo.name"),
        })
        .drop("_repo")
    )


# Payload members the rollups read (fixed values).
ROLLUP_MEMBERS = (
    "action string, size string, language string, description string,"
    " issue struct<created_at: string, closed_at: string>,"
    " pull_request struct<merged: string, created_at: string, merged_at: string>"
)


def with_payload(events: DataFrame) -> DataFrame:
    """Add the payload members of the rollups as ``details`` unless already typed."""
    if "details" in events.columns:
        return events
    return events.withColumn("details", members(F.col("raw_payload"), ROLLUP_MEMBERS))


def has_actor(events: DataFrame) -> Column:
    return F.col("has_actor") if "has_actor" in events.columns else F.col("raw_actor").isNotNull()


def has_repo(events: DataFrame) -> Column:
    return F.col("has_repo") if "has_repo" in events.columns else F.col("raw_repo").isNotNull()
