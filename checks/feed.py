"""The ``events`` test table expressed as a raw activity feed.

Every value is a function of one row, so the mapping scales with the table and
can be restated in SQL on the flat columns (``checks.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import FEED_FIELDS
from eventloom.operators.normalize import normalize
from eventloom.plans.staging import stg_raw_events

LANGUAGES = ["Python", "Go", "C", "TypeScript"]


def _member(name: str, value: Column, quoted: bool = False) -> Column:
    """``"name":value`` as JSON text, with a JSON null for NULL."""
    text = value.cast("string")
    if quoted:
        text = F.concat(F.lit('"'), text, F.lit('"'))
    return F.concat(F.lit(f'"{name}":'), F.coalesce(text, F.lit("null")))


def _object(*parts: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _nested(name: str, *parts: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), _object(*parts))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed messages with every member as text, as a JSON scan would give."""
    e = F.col("event_id")
    t = F.date_trunc("second", F.col("ts").cast("timestamp"))

    def stamp(ts: Column) -> Column:
        return F.when(e % 2 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
        )

    k = F.col("k")
    event_type = F.concat(
        F.when(F.col("event_type") == "click", "Watch")
        .when(F.col("event_type") == "view", "Push")
        .when(
            F.col("event_type") == "signup",
            F.when(e % 5 == 0, "Fork").when(e % 5 == 1, "Create").when(e % 5 == 2, "Release")
            .when(e % 5 == 3, "Gollum").otherwise("Public"),
        )
        .when(F.col("event_type") == "error", F.when(e % 3 == 2, "IssueComment").otherwise("Issues"))
        .otherwise(
            F.when(e % 8 == 3, "PullRequestReview").when(e % 8 == 7, "PullRequestReviewComment")
            .otherwise("PullRequest")
        ),
        F.lit("Event"),
    )
    language = F.when(
        e % 3 == 0,
        _member("language", F.element_at(F.array(*map(F.lit, LANGUAGES)), (e % 4 + 1).cast("int")), True),
    )
    issue_action = F.when(e % 2 == 0, "opened").otherwise("closed")
    pr_action = F.when(e % 3 == 0, "opened").otherwise("closed")
    hours = F.expr("make_interval(0, 0, 0, 0, cast(event_id % 48 as int))")
    pr_hours = F.expr("make_interval(0, 0, 0, 0, cast(event_id % 72 as int))")
    payloads = {
        "WatchEvent": [_member("action", F.lit("started"), True)],
        "PushEvent": [
            _member("push_id", e),
            _member("size", F.when(e % 7 != 0, e % 20)),
            _member("distinct_size", e % 5),
            _member("ref", F.lit("refs/heads/main"), True),
        ],
        "CreateEvent": [
            _member("ref_type", F.lit("branch"), True),
            _member("ref", F.concat(F.lit("b"), e), True),
            _member("master_branch", F.lit("main"), True),
            _member("description", F.when(e % 4 != 0, F.concat(F.lit("desc "), e % 13)), True),
        ],
        "ForkEvent": [
            _nested("forkee", _member("id", e + 1000000),
                    _member("full_name", F.concat(F.lit("fork/"), e), True))
        ],
        "ReleaseEvent": [
            _member("action", F.lit("published"), True),
            _nested("release", _member("id", e),
                    _member("tag_name", F.concat(F.lit("v"), e % 30), True)),
        ],
        "IssuesEvent": [
            _member("action", issue_action, True),
            _nested(
                "issue", _member("id", e), _member("number", e % 1000),
                _member("state", F.when(e % 2 == 0, "open").otherwise("closed"), True),
                _member("created_at", stamp(t - hours), True),
                _member("closed_at", F.when(e % 2 == 1, stamp(t)), True),
            ),
        ],
        "IssueCommentEvent": [
            _member("action", F.lit("created"), True),
            _nested("issue", _member("id", e)),
            _nested("comment", _member("id", e)),
        ],
        "PullRequestEvent": [
            _member("action", pr_action, True),
            _nested(
                "pull_request", _member("id", e), _member("number", e % 1000),
                _member("state", F.when(e % 3 == 0, "open").otherwise("closed"), True),
                _member("merged", F.when(e % 3 == 1, True).when(e % 3 == 2, False)),
                _member("created_at", stamp(t - pr_hours), True),
                _member("closed_at", F.when(e % 3 != 0, stamp(t)), True),
                _member("merged_at", F.when(e % 3 == 1, stamp(t)), True),
            ),
        ],
    }
    review = [_member("action", F.lit("created"), True), _nested("pull_request", _member("id", e))]
    payloads["PullRequestReviewEvent"] = review
    payloads["PullRequestReviewCommentEvent"] = review
    payload = None
    for name, parts in payloads.items():
        text = _object(language, *parts)
        hit = F.col("type") == name
        payload = F.when(hit, text) if payload is None else payload.when(hit, text)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumns({
        "k": F.from_json("props", "k bigint")["k"], "type": event_type,
    })
    return events.select(
        e.cast("string").alias("id"),
        "type",
        F.when(
            e % 97 != 0,
            _object(
                _member("id", F.col("user_id")),
                _member("login", F.concat(F.lit("user_"), F.col("user_id")), True),
                _member("avatar_url", F.concat(F.lit("https://example.com/u/"), F.col("user_id")), True),
            ),
        ).alias("actor"),
        F.when(
            e % 89 != 0,
            _object(_member("id", k), _member("name", F.concat(F.lit("org/repo_"), k), True)),
        ).alias("repo"),
        F.lit(None).cast("string").alias("org"),
        payload.otherwise(_object(language)).alias("payload"),
        (e % 10 != 0).cast("string").alias("public"),
        stamp(t).alias("created_at"),
    ).select(*FEED_FIELDS)


LOADED_AT = "2024-02-01 00:00:00"


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(feed(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landing(spark, sf_dir).drop("year", "month", "day", "hour")
    return rows.withColumn("loaded_at", F.lit(LOADED_AT).cast("timestamp"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_raw_events(raw_events(spark, sf_dir))
