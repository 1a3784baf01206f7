from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventloom.functions.timeparse import parse_event_ts
from eventloom.operators.load import RAW_ON_DISK
from eventloom.plans import marts
from eventloom.plans.staging import stg_raw_events
from eventloom.sources.feed import read_landing
from eventloom.sources.tables import read_table
from eventloom.streaming import streams
from tests.conftest import FEED_MIXED, RAW, event, message

ARRIVED = datetime(2024, 3, 1, 9)


def write_lines(folder, name, messages):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n")


def land(spark, inbox, root):
    messages = streams.read_message_files(spark, str(inbox), ARRIVED)
    streams.land_stream(messages, str(root), f"{root}-progress", interval=None).awaitTermination()


def test_replay_keeps_objects_verbatim(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [*FEED_MIXED, '  {"id": 77,  "x": 1}  ', '{"id": ""}', "3"])
    lines = spark.readStream.format("text").load(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    streams.replay_messages(lines).writeStream.format("parquet").option(
        "checkpointLocation", f"{out}-progress"
    ).trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.parquet(out).collect()
    keys = [r.key for r in rows]
    assert len(rows) == len(FEED_MIXED) - 3 + 2
    assert keys.count(None) == 2 and {"1", "x", "10", "77"} <= set(keys)
    assert '{"id": 77,  "x": 1}' in {r.value for r in rows}


def test_stream_lands_late_events_and_restarts_without_repeats(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "landing"
    write_lines(inbox, "a.json", [message(1), message(2, at="2024-01-05 08:00:00")])
    land(spark, inbox, root)
    land(spark, inbox, root)
    assert read_landing(spark, str(root)).count() == 2
    # Thirty hours late, and a repeated delivery: both land in their own hour.
    write_lines(inbox, "b.json", [message(3, at="2024-01-04T02:00:00Z"), message(1)])
    land(spark, inbox, root)
    rows = read_landing(spark, str(root)).collect()
    assert sorted((r.id, r.day, r.hour) for r in rows) == [(1, 5, 7), (1, 5, 7), (2, 5, 8), (3, 4, 2)]
    assert (root / "year=2024/month=01/day=04/hour=02").is_dir()


def test_stream_matches_batch_decoding_and_quarantines(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "landing"
    write_lines(inbox, "a.json", FEED_MIXED)
    land(spark, inbox, root)
    assert read_landing(spark, str(root)).count() == 10
    messages = streams.read_message_files(spark, str(inbox), ARRIVED)
    bad = str(tmp_path / "bad")
    streams.quarantine_stream(messages, bad, f"{bad}-progress", interval=None).awaitTermination()
    assert sorted(r.message for r in spark.read.parquet(bad).collect()) == ["", "[1,2]", "not json"]


def test_load_stream_is_exactly_once_by_key(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "landing"

    def load():
        streams.load_stream(
            spark, str(root), str(tmp_path / "raw"), str(tmp_path / "bad"), str(tmp_path / "progress"),
            ARRIVED,
        ).awaitTermination()
        return sorted(r.id for r in read_table(spark, str(tmp_path / "raw"), RAW_ON_DISK).collect())

    write_lines(inbox, "a.json", [message(i) for i in range(5)])
    land(spark, inbox, root)
    assert load() == [0, 1, 2, 3, 4]
    write_lines(inbox, "b.json", [message(i, at="2024-01-03T00:00:00Z") for i in (9, 10, 11)] + [message(3)])
    land(spark, inbox, root)
    assert load() == [0, 1, 2, 3, 4, 9, 10, 11]
    assert load() == [0, 1, 2, 3, 4, 9, 10, 11]


def stream_rows(spark, tmp_path, batches):
    folder = str(tmp_path / "raw")
    for rows in batches:
        spark.createDataFrame(rows, RAW).withColumn(
            "loaded_at", F.lit(ARRIVED).cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), folder


@pytest.mark.parametrize("lanes", [1, 16])
def test_stream_dedupe(spark, tmp_path, lanes):
    stream, _ = stream_rows(spark, tmp_path, [[event(1), event(1), event(2)], [event(2), event(3, at=None)]])
    out = str(tmp_path / "out")
    event_at = parse_event_ts(F.col("created_at"))
    streams.dedupe_stream(stream, event_at, lanes=lanes).select("id").writeStream.format(
        "parquet"
    ).option("checkpointLocation", f"{out}-progress").trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


LATE = [
    [event(1, at="2024-01-05T07:00:00Z"), event(2, at="2024-01-05T09:00:00Z")],
    [event(3, at="2024-01-05T12:00:00Z")],
    [event(4, at="2024-01-04T02:00:00Z"), event(1, at="2024-01-05T07:00:00Z"), event(4, at="2024-01-04T02:00:00Z")],
    [event(5, at=None), event(3, at="2024-01-05T12:00:00Z"), event(6, at="2023-01-01T00:00:00Z")],
]


@pytest.mark.parametrize("lanes", [1, 16])
def test_stream_dedupe_keeps_late_ids(spark, tmp_path, lanes):
    stream, _ = stream_rows(spark, tmp_path, LATE)
    out = str(tmp_path / "out")
    deduped = streams.dedupe_stream(stream, parse_event_ts(F.col("created_at")), lanes=lanes)
    deduped.select("id").writeStream.format("parquet").option("checkpointLocation", f"{out}-progress").trigger(
        availableNow=True
    ).start(out).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5, 6]


def test_dedupe_into_a_table_keeps_late_ids(spark, tmp_path):
    out = str(tmp_path / "out")
    for batches in (LATE[:3], LATE[3:], [[event(None), event(2)]]):
        stream, _ = stream_rows(spark, tmp_path, batches)
        streams.dedupe_into(stream, out, f"{out}-progress").awaitTermination()
    assert sorted(r.id for r in read_table(spark, out, stream.schema).collect()) == [1, 2, 3, 4, 5, 6]


def test_stream_daily_equals_batch_out_of_order(spark, tmp_path):
    inbox, landing, root = tmp_path / "in", tmp_path / "landing", str(tmp_path / "daily")

    def run():
        land(spark, inbox, landing)
        streams.daily_repo_stream(spark, str(landing), root, f"{root}-progress", ARRIVED).awaitTermination()
        return streams.daily_repo_streamed(spark, root).drop("repo_name")

    write_lines(inbox, "a.json", [message(10 + i, at=f"2024-01-03T{i:02d}:00:00Z") for i in range(4)])
    assert run().count() == 1
    # Two days late, a repeated id, and no readable time.
    write_lines(inbox, "b.json", [message(20, at="2024-01-01T05:00:00Z"), message(10), message(30, at="bad")])
    streamed = run()
    raw = read_table(spark, f"{root}/raw", RAW_ON_DISK)
    assert sorted(r.id for r in raw.collect()) == [10, 11, 12, 13, 20, 30]
    batch = marts.daily_repo(stg_raw_events(raw)).drop("repo_name")
    assert sorted(map(str, streamed.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
