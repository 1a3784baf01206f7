"""Feed scan, normalization, landing, quarantine."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from eventloom.functions.calendar import dim_date, hour_grid
from eventloom.functions.timeparse import parse_event_ts
from eventloom.operators.normalize import normalize, quarantine_split, split_corrupt
from eventloom.sources.feed import (
    decode, feed_files, land_batch, read_feed, read_landing, read_landing_hour,
)
from eventloom.schemas import LANDING, RAW_EVENTS
from eventloom.sources.tables import contract_breaks, enforce_schema
from tests.conftest import FEED_MIXED, message, write_feed


def test_event_time_formats(spark):
    texts = {
        "2024-01-05T07:00:00Z": datetime(2024, 1, 5, 7),
        "2024-01-05 07:00:00": datetime(2024, 1, 5, 7),
        "2024-01-05T07:00:00.999Z": datetime(2024, 1, 5, 7),
        "2024-13-45T07:00:00Z": None,
        "2024": None,
        "07:00:00": None,
        "bad": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.v for r in df.select("t", parse_event_ts(F.col("t")).alias("v")).collect()}
    assert got == texts


def test_hour_grid_is_inclusive_and_unpadded(spark):
    rows = hour_grid(spark, "2024-01-30", "2024-02-01").collect()
    assert len(rows) == 72
    assert rows[4].file_name == "2024-01-30-4.json.gz"
    assert [r.feed_date for r in hour_grid(spark, "2024-01-30", "2024-02-01", hour=23).collect()] == [
        date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)
    ]


def test_dim_date_default_span(spark):
    rows = dim_date(spark).orderBy("date_id").collect()
    assert len(rows) == 1461
    assert (rows[0].date_id, rows[-1].date_id) == (date(2024, 1, 1), date(2027, 12, 31))
    sunday = next(r for r in rows if r.date_id == date(2024, 1, 7))
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend, sunday.quarter) == (0, "Sunday", True, 1)


def test_feed_scan_and_batch_normalize(spark, tmp_path):
    write_feed(tmp_path / "2024-01-05-7.json.gz", FEED_MIXED)
    write_feed(tmp_path / "2024-01-05-8.json.gz", [message("99")])
    files = feed_files(spark, str(tmp_path), "2024-01-05", "2024-01-05", hour=7)
    assert [f.rsplit("/", 1)[-1] for f in files] == ["2024-01-05-7.json.gz"]
    good, bad = split_corrupt(read_feed(spark, files))
    rows = {r.id: r for r in normalize(good).collect()}
    assert sorted(rows) == [1, 2, 5, 6, 7, 8, 9, 10]
    assert json.loads(rows[1].actor) == {"id": 1, "login": "user_1", "avatar_url": "a/1"}
    assert (rows[1].year, rows[1].month, rows[1].day, rows[1].hour) == ("2024", "01", "05", "07")
    assert rows[8].public is False and rows[9].payload == "text" and rows[1].org is None
    assert rows[5].created_at is None and rows[6].hour is None and rows[6].created_at == "bad"
    assert "not json" in {r.message for r in bad.collect()}


def test_missing_feed_files_are_skipped(spark, tmp_path):
    assert feed_files(spark, str(tmp_path), "2024-01-05", "2024-01-06") == []
    assert read_feed(spark, []).count() == 0


def test_stream_normalize_keeps_bad_ids_under_a_stable_key(spark, tmp_path):
    write_feed(tmp_path / "f.json.gz", FEED_MIXED + [{"id": "11"}])
    good, _ = split_corrupt(read_feed(spark, [str(tmp_path / "f.json.gz")]))
    arrived = F.lit(datetime(2024, 3, 1, 9)).cast("timestamp")
    first = {r.id: r for r in normalize(good, "hash", arrived).collect()}
    again = {r.id for r in normalize(good, "hash", arrived).collect()}
    assert set(first) == again and len(first) == 11
    bare = first[11]
    assert (bare.type, bare.public, bare.created_at, bare.hour) == (
        "UnknownEvent", True, "2024-03-01T09:00:00Z", "09"
    )
    # An unreadable time keeps its text; only the partition falls back.
    assert (first[6].created_at, first[6].month) == ("bad", "03")


def test_decode_quarantines_what_is_not_an_object(spark):
    values = [
        b'{"id": "1", "type": "WatchEvent"}', b"[1,2]", b"nope", b"\xff\xfe", b'"text"', b"3", b"null",
        b'{"id": "2"} more', b'{"id": "2"}{"id": "3"}', b'{"id": "2"},{"id": "3"}', b"{'id': '4'}",
        b'{"id": "5", "actor": {"id": 1}, "actor": {"id": 2}}', b'{"id": "6", "payload": [1,',
    ]
    df = spark.createDataFrame([(bytearray(v),) for v in values], "value binary")
    good, bad = split_corrupt(decode(df, F.col("value")))
    rows = good.orderBy("id").collect()
    assert [(r.id, r.actor) for r in rows] == [("1", None), ("5", '{"id":2}')]
    assert bad.count() == len(values) - 2


def test_readable_messages_are_parsed_once(spark, tmp_path):
    write_feed(tmp_path / "2024-01-05-7.json.gz", FEED_MIXED)
    for part in split_corrupt(read_feed(spark, [str(tmp_path / "2024-01-05-7.json.gz")])):
        assert part._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_quarantine_split_reasons(spark):
    rows = [
        (1, "A", "2024-01-01T00:00:00Z"), (None, "A", "x"), (2, None, "x"), (3, "t" * 51, "x"),
        (4, "A", None), (5, "A", "y" * 31),
    ]
    df = spark.createDataFrame(rows, "id bigint, type string, created_at string")
    good, bad = quarantine_split(df)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == [
        "created_at longer than 30", "created_at missing", "id missing", "type longer than 50", "type missing",
    ]


def test_enforce_schema_casts_by_name_and_reports_breaks(spark):
    df = spark.createDataFrame(
        [("1", "A", "t", "true"), ("x", "A", "t", None), (None, "A", "t", None)],
        "id string, type string, created_at string, public string",
    )
    out = enforce_schema(df, RAW_EVENTS)
    assert out.columns == RAW_EVENTS.names
    assert [r.id for r in out.collect()] == [1, None, None]
    reasons = sorted(r.reason for r in contract_breaks(df, RAW_EVENTS).collect())
    assert reasons == ["id is not bigint", "id missing"]


def landing_rows(spark, ids, hour=7):
    at = f"2024-08-05T{hour:02d}:00:00Z"
    rows = [(str(i), "WatchEvent", None, None, None, "{}", "true", at) for i in ids]
    feed = spark.createDataFrame(rows, "id string, type string, actor string, repo string, org string,"
                                 " payload string, public string, created_at string")
    return normalize(feed)


def test_land_batch_pads_folders_and_replays_nothing(spark, tmp_path):
    root = str(tmp_path / "landing")
    span = (2024080507, 2024080507)
    land_batch(landing_rows(spark, [1, 2, 3]), root, span)
    land_batch(landing_rows(spark, [2, 3, 4]), root, span)
    assert (tmp_path / "landing/year=2024/month=08/day=05/hour=07").is_dir()
    assert sorted(r.id for r in read_landing_hour(spark, root, 2024, 8, 5, 7).collect()) == [1, 2, 3, 4]
    assert read_landing_hour(spark, root, 2024, 8, 5, 8).count() == 0
    assert read_landing(spark, str(tmp_path / "none")).count() == 0


def test_partition_scan_reads_padded_and_unpadded_folders(spark, tmp_path):
    root = tmp_path / "landing"
    land_batch(landing_rows(spark, [1, 2]), str(root))
    landing_rows(spark, [3]).select(*LANDING.names).write.parquet(
        str(root / "year=2024/month=8/day=5/hour=7")
    )
    hour = read_landing_hour(spark, str(root), 2024, 8, 5, 7)
    assert sorted(r.id for r in hour.collect()) == [1, 2, 3]
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
