from __future__ import annotations

import gzip
import json
from datetime import datetime

import pytest

from eventloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(scratch), "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


RAW = "id bigint, type string, actor string, repo string, org string, payload string, public boolean, created_at string"


def event(id, type="WatchEvent", actor=1, repo=1, at="2024-01-01T00:00:00Z", payload=None, name=None, login=None):
    """One raw-table row."""
    return (
        id, type,
        None if actor is None else json.dumps({"id": actor, "login": login or f"user_{actor}", "avatar_url": f"a/{actor}"}),
        None if repo is None else json.dumps({"id": repo, "name": name or f"org/repo_{repo}"}),
        None, json.dumps(payload or {}), True, at,
    )


@pytest.fixture
def raw(spark):
    def make(rows):
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, RAW).withColumn(
            "loaded_at", F.lit(datetime(2024, 2, 1)).cast("timestamp")
        )

    return make


@pytest.fixture
def staged(raw):
    from eventloom.plans.staging import stg_raw_events

    return lambda rows: stg_raw_events(raw(rows))


def write_feed(path, lines) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")


def message(id, type="WatchEvent", at="2024-01-05T07:00:00Z", actor=1, repo=1, payload=None, **more):
    """One feed message."""
    return {
        "id": id, "type": type,
        "actor": {"id": actor, "login": f"user_{actor}", "avatar_url": f"a/{actor}"},
        "repo": {"id": repo, "name": f"org/repo_{repo}"},
        "payload": payload if payload is not None else {"action": "started"},
        "public": True, "created_at": at, **more,
    }


FEED_MIXED = [
    message("1"),
    message("2", at="2024-01-05 07:10:00"),
    "",
    "not json",
    "[1,2]",
    message("x"),
    {k: v for k, v in message("4").items() if k != "id"},
    {k: v for k, v in message("5").items() if k != "created_at"},
    message("6", at="bad"),
    message("7", at="2024-01-05T07:20:00.250Z"),
    message("8", public="false"),
    message("9", payload="text"),
    message(10),
]
