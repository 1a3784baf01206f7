"""Latest-per-key, ranks, keyed load, type-2 history."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.operators.latest import first_per_key, latest_per_key
from eventloom.operators.load import insert_if_absent, load_batch, near_keys
from eventloom.operators.ranking import global_rank, top_k_with_ties, value_ranges
from eventloom.operators.scd2 import (
    REPO_CHECKS, REPO_KEY, history_schema, read_history, scd2_merge, snapshot_table,
)
from eventloom.sources.tables import read_latest, read_table, replace_table
from tests.conftest import RAW, event, ts


def test_latest_per_key_ties_and_nulls(spark):
    rows = [
        (1, "a", ts("2024-01-01"), 1), (1, "b", ts("2024-01-02"), 2), (1, "c", ts("2024-01-02"), 3),
        (2, "d", None, 4), (2, "e", ts("2024-01-05"), 5),
        (None, "f", ts("2024-01-01"), 6), (None, "g", ts("2024-01-03"), 7),
    ]
    df = spark.createDataFrame(rows, "k bigint, v string, event_at timestamp, event_id bigint")
    got = {r.k: (r.v, r.event_at) for r in latest_per_key(df, ["k"], ["v"]).collect()}
    assert got == {1: ("c", ts("2024-01-02")), 2: ("d", None), None: ("g", ts("2024-01-03"))}


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9)], "k bigint, v bigint")
    out = first_per_key(df, ["k"], [F.col("v").asc()])
    assert {(r.k, r.v) for r in out.collect()} == {(1, 2), (2, 9)}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_global_rank_known_ties(spark):
    totals = [9, 9, 7, 5, 5, 5, 1]
    df = spark.createDataFrame([(i, t, -t) for i, t in enumerate(totals)], "id int, t bigint, u bigint")
    rows = global_rank(df, {"t": "rank_t", "u": "rank_u"}).orderBy("id").collect()
    assert [r.rank_t for r in rows] == [1, 1, 3, 4, 4, 4, 7]
    assert [r.rank_u for r in rows] == [6, 6, 5, 2, 2, 2, 1]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-(10**6), 10**6), st.sampled_from([0, 1, 2])), min_size=1, max_size=60))
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_global_rank_equals_window(spark, values, threshold):
    def rank(v):
        above = [x for x in values if (x is None and v is not None) or (None not in (x, v) and x > v)]
        return 1 + len(above)

    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = global_rank(df, {"v": "r"}).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.id, r.r) for r in rows) == [(i, rank(v)) for i, v in enumerate(values)]


def test_ranges_are_even_for_narrow_values(spark):
    """A year of epoch seconds, which lie within two percent of each other."""
    year = spark.range(0, 365 * 86400, 400).select(
        F.lit(0).alias("measure"), (F.col("id") + 1704067200).alias("value"), F.lit(1).alias("n")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in value_ranges(year).groupBy("part").count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 1.5 * sum(sizes) / 8


def test_global_rank_of_doubles(spark):
    inf, nan = float("inf"), float("nan")
    values = [0.5, 0.25, 0.5, -3.0, 1e300, 1e-9, 0.0, inf, -inf, nan, None, -0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    rows = global_rank(df, {"v": "r"}).orderBy("id").collect()
    assert [r.r for r in rows] == [5, 7, 5, 11, 4, 8, 9, 3, 12, 2, 1, 9]


@pytest.mark.parametrize("k, expected", [(1, [0, 1]), (2, [0, 1]), (3, [0, 1, 2]), (4, [0, 1, 2, 3, 4, 5])])
def test_top_k_keeps_ties(spark, k, expected):
    df = spark.createDataFrame(list(enumerate([9, 9, 7, 5, 5, 5, 1])), "id int, t bigint")
    assert sorted(r.id for r in top_k_with_ties(df, "t", k).collect()) == expected


def test_top_k_when_everything_ties(spark):
    df = spark.range(500).withColumn("t", F.lit(1))
    assert top_k_with_ties(df, "t", 100).count() == 500


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "id bigint, v string")
    batch = spark.createDataFrame(
        [(1, "new"), (2, "b"), (2, "a"), (3, "c"), (None, "n")], "id bigint, v string"
    )
    out = insert_if_absent(batch, target, "id", [F.col("v").asc()])
    assert {(r.id, r.v) for r in out.collect()} == {(2, "a"), (3, "c")}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.lists(st.integers(-(2**63), 2**63 - 1), max_size=20),
    batch=st.lists(st.integers(-(2**63), 2**63 - 1), max_size=20),
    shared=st.lists(st.integers(0, 1000), max_size=10),
)
def test_near_keys_keeps_every_match(spark, target, batch, shared):
    t = spark.createDataFrame([(k,) for k in target + shared], "id bigint")
    b = spark.createDataFrame([(k,) for k in batch + shared], "id bigint")
    kept = {r.id for r in near_keys(t, b, "id").collect()}
    assert kept >= set(target + shared) & set(batch + shared)
    assert kept <= set(target + shared)


def test_load_batch_twice_is_load_once(spark, tmp_path):
    raw_root, bad_root = str(tmp_path / "raw"), str(tmp_path / "bad")
    rows = [
        event(1), event(1), event(2, at="2024-01-02 05:00:00"), event(None), event(3, type=None),
        event(4, type="t" * 51), event(5, at="unreadable"),
    ]
    batch = spark.createDataFrame(rows, RAW)
    first = load_batch(batch, raw_root, bad_root, datetime(2024, 2, 1))
    assert (first.processed, first.inserted, first.rejected) == (7, 3, 3)
    assert first.dates == [date(2024, 1, 1), date(2024, 1, 2), None]
    second = load_batch(batch, raw_root, bad_root, datetime(2024, 2, 2))
    assert (second.inserted, second.rejected, second.dates) == (0, 3, first.dates)
    more = load_batch(
        spark.createDataFrame([event(2), event(9)], RAW), raw_root, bad_root, datetime(2024, 2, 3)
    )
    assert more.inserted == 1
    raw = spark.read.parquet(raw_root)
    assert sorted(r.id for r in raw.collect()) == [1, 2, 5, 9]
    assert raw.filter("id = 1").first().loaded_at == datetime(2024, 2, 1)
    assert spark.read.parquet(bad_root).count() == 3


def test_replaced_table_may_be_read_by_its_successor_and_may_be_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_table(spark.range(3), root)
    replace_table(read_latest(spark, root).filter("id > 0"), root)
    assert read_latest(spark, root).count() == 2
    replace_table(read_latest(spark, root).filter("id > 9"), root)
    assert read_latest(spark, root).count() == 0


def test_uncommitted_version_is_invisible(spark, tmp_path):
    root = tmp_path / "t"
    replace_table(spark.range(3), str(root))
    spark.range(9).write.parquet(str(root / "v=00000002"))
    (root / "v=00000002" / "_SUCCESS").unlink()
    assert read_latest(spark, str(root)).count() == 3
    assert read_table(spark, str(tmp_path / "absent"), spark.range(1).schema).count() == 0


def test_old_versions_expire(spark, tmp_path):
    root = tmp_path / "t"
    for n in range(1, 5):
        replace_table(spark.range(n), str(root), keep=2)
    assert sorted(p.name for p in root.iterdir()) == ["v=00000003", "v=00000004"]
    assert read_latest(spark, str(root)).count() == 4


def test_snapshot_keeps_closed_rows_when_old_runs_expire(spark, tmp_path):
    root = str(tmp_path / "snap")
    for day, language in enumerate(["Go", "C", "Go", "C"], start=1):
        frame = spark.createDataFrame([(1, "a", language, "", "0-10")], PROFILE)
        snapshot_table(root, frame, datetime(2024, 1, day), keep=1)
    schema = history_schema(frame.schema, REPO_KEY, REPO_CHECKS)
    rows = brief(read_history(spark, root, schema))
    assert {(r[1], r[2].day, r[3] and r[3].day) for r in rows} == {
        ("Go", 1, 2), ("C", 2, 3), ("Go", 3, 4), ("C", 4, None)
    }
    assert not (tmp_path / "snap/v=00000003/state=open").exists()


PROFILE = "repo_id bigint, repo_name string, primary_language string, description string, star_count_bucket string"
LOADS = [
    (datetime(2024, 1, 1), [(1, "a", "Go", None, "0-10"), (2, "b", "C", "x", "0-10"), (3, None, None, None, None)]),
    (datetime(2024, 1, 2), [(1, "a", "Go", None, "0-10"), (2, "b", "C", "x", "0-10"), (3, None, None, None, None)]),
    (datetime(2024, 1, 3), [(1, "a", "Rust", "", "0-10"), (2, "b", "C", "x", "0-10"), (4, "d", "Go", "", "0-10")]),
    (datetime(2024, 1, 4), [(2, "b", "C", "x", "11-100"), (1, "a", "Rust", "", "0-10")]),
]


def expected_history():
    d = lambda n: datetime(2024, 1, n)
    return {
        (1, "Go", d(1), d(3)), (1, "Rust", d(3), None), (2, "C", d(1), d(4)), (2, "C", d(4), None),
        (3, None, d(1), None), (4, "Go", d(3), None),
    }


def brief(df):
    return {(r.repo_id, r.primary_language, r.valid_from, r.valid_to) for r in df.collect()}


def test_scd2_merge_transitions(spark):
    empty = spark.createDataFrame([], PROFILE)
    history = spark.createDataFrame([], history_schema(empty.schema, REPO_KEY, REPO_CHECKS))
    for as_of, rows in LOADS:
        history = scd2_merge(history, spark.createDataFrame(rows, PROFILE), REPO_KEY, REPO_CHECKS, as_of)
    assert brief(history) == expected_history()
    assert history.filter("is_current").groupBy("repo_id").count().filter("count > 1").count() == 0


def test_snapshot_table_is_incremental_and_idempotent(spark, tmp_path):
    root = str(tmp_path / "snap")
    schema = history_schema(spark.createDataFrame([], PROFILE).schema, REPO_KEY, REPO_CHECKS)
    for as_of, rows in LOADS:
        for _ in range(2):
            snapshot_table(root, spark.createDataFrame(rows, PROFILE), as_of)
    history = read_history(spark, root, schema)
    assert brief(history) == expected_history()
    assert history.filter(F.col("is_current") != F.col("valid_to").isNull()).count() == 0


def test_snapshot_correction_at_the_same_time_replaces_the_row(spark, tmp_path):
    root = str(tmp_path / "snap")
    frames = [spark.createDataFrame([(1, "a", lang, "", "0-10")], PROFILE) for lang in ("Go", "C")]
    for frame in frames:
        snapshot_table(root, frame, datetime(2024, 1, 1))
    schema = history_schema(frames[0].schema, REPO_KEY, REPO_CHECKS)
    assert brief(read_history(spark, root, schema)) == {(1, "C", datetime(2024, 1, 1), None)}


def test_failed_snapshot_run_is_ignored(spark, tmp_path):
    root = tmp_path / "snap"
    frame = spark.createDataFrame([(1, "a", "Go", "", "0-10")], PROFILE)
    other = spark.createDataFrame([(1, "a", "C", "", "0-10")], PROFILE)
    schema = history_schema(frame.schema, REPO_KEY, REPO_CHECKS)
    snapshot_table(str(root), frame, datetime(2024, 1, 1))
    snapshot_table(str(root), other, datetime(2024, 1, 2))
    (root / "v=00000002" / "_SUCCESS").unlink()
    assert brief(read_history(spark, str(root), schema)) == {(1, "Go", datetime(2024, 1, 1), None)}
    snapshot_table(str(root), other, datetime(2024, 1, 3))
    assert brief(read_history(spark, str(root), schema)) == {
        (1, "Go", datetime(2024, 1, 1), datetime(2024, 1, 3)), (1, "C", datetime(2024, 1, 3), None),
    }
