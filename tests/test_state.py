"""State tables, the index of ids, redoable loads, states from inserted rows."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom.operators import load as loading
from eventloom.operators.anomaly import series, trend_state
from eventloom.operators.load import RawTable, load_batch
from eventloom.operators.scd2 import snapshot_table
from eventloom.plans import marts, rollups
from eventloom.plans.incremental import ACTOR_DAYS, ACTOR_TOTALS, REPO_DAYS, REPO_PUSHERS, REPO_TOTALS, STATES, Models
from eventloom.plans.staging import stg_raw_events
from eventloom.sources.state import bucketed, by_date
from tests.conftest import RAW, event
from tests.test_operators import PROFILE

LOADED = datetime(2024, 2, 1)


def files(root) -> dict[str, int]:
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def files_read(df) -> int:
    """How many files the scans of ``df`` opened, after partition pruning."""
    df = df.select("*")  # a plan of its own: scans count their files once
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plans = [leaves.apply(i) for i in range(leaves.size())]
    found = [p.metrics().get("numFiles") for p in plans if "FileScan" in p.toString() or "Scan parquet" in p.toString()]
    return sum(m.get().value() for m in found)


def summed(held, fresh):
    return held.unionByName(fresh).groupBy("k").agg(F.sum("n").alias("n"))


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    table = bucketed(str(tmp_path / "t"), spark.createDataFrame([], "k long, n long").schema, "k", buckets=8)
    rows = [(k, 1) for k in range(40)] + [(None, 5)]
    assert table.upsert(spark.createDataFrame(rows, "k long, n long"), summed, 3) == 3
    before = files(tmp_path / "t")
    table.upsert(spark.createDataFrame([(7, 10), (None, 1)], "k long, n long"), summed, 9)
    assert {tuple(r) for r in table.read(spark).collect()} == {(k, 1) for k in range(40) if k != 7} | {(7, 11), (None, 6)}
    new = {p for p in files(tmp_path / "t") if p not in before}
    assert {p: t for p, t in files(tmp_path / "t").items() if p in before} == before
    assert 1 <= len(new) <= 2 and table.version(spark) == 9
    # A run that did not commit is invisible, and the next attempt replaces it.
    table.upsert(spark.createDataFrame([(7, 100)], "k long, n long"), summed, 10)
    (tmp_path / "t/v=00000010/_SUCCESS").unlink()
    assert table.version(spark) == 9 and table.read(spark).filter("k = 7").first().n == 11
    table.upsert(spark.createDataFrame([(7, 1)], "k long, n long"), summed, 10)
    assert table.read(spark).filter("k = 7").first().n == 12


def test_only_the_asked_partitions_are_read(spark, tmp_path):
    schema = spark.createDataFrame([], "event_date date, n long").schema
    table = by_date(str(tmp_path / "d"), schema)
    rows = [(date(2024, 1, d), d) for d in range(1, 9)] + [(None, 0)]
    table.write(spark.createDataFrame(rows, "event_date date, n long"))
    some = table.read(spark, [date(2024, 1, 3), None])
    assert {tuple(r) for r in some.collect()} == {(date(2024, 1, 3), 3), (None, 0)}
    assert files_read(some) == 2
    assert table.read(spark, []).count() == 0 and table.read(spark).count() == 9


def test_old_copies_expire_and_shown_ones_stay(spark, tmp_path):
    table = bucketed(str(tmp_path / "t"), spark.createDataFrame([], "k long, n long").schema, "k", buckets=4, keep=2)
    table.upsert(spark.createDataFrame([(k, 0) for k in range(20)], "k long, n long"), summed)
    for _ in range(6):
        table.upsert(spark.createDataFrame([(1, 1)], "k long, n long"), summed)
    assert sum(r.n for r in table.read(spark).collect()) == 6 and table.read(spark).count() == 20
    kept = sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v="))
    assert kept == ["v=00000001", "v=00000006", "v=00000007"]


EVENTS = [
    [event(i, at=f"2024-01-{1 + i % 9:02d}T05:00:00Z", type=("PushEvent", "WatchEvent", "IssuesEvent")[i % 3],
           actor=i % 7, repo=i % 5, payload={"size": i}) for i in range(60)],
    [event(100 + i, at=f"2024-01-{9 + i % 2:02d}T06:00:00Z", actor=i, repo=i % 2, type="PushEvent") for i in range(6)]
    + [event(3), event(300, at="bad", repo=2), event(301, at="2023-05-05 01:00:00", repo=77, type="PushEvent", actor=None)],
    [event(400, at="2024-01-10T07:00:00Z", repo=3, type="PushEvent", actor=40_000)],
]


@pytest.fixture
def lake(spark, tmp_path):
    raw = RawTable(spark, str(tmp_path / "raw"))
    return raw, Models(raw, str(tmp_path / "states"))


def put(lake, rows):
    raw, models = lake
    return load_batch(raw.spark.createDataFrame(rows, RAW), raw.root, f"{raw.root}_bad", LOADED)


def plain(df):
    """Rows as text; sums of hours come in any order of addition, so they are rounded."""
    rounded = [F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema.fields]
    return sorted(map(str, df.select(*rounded).collect()))


def assert_like_a_rebuild(lake):
    raw, models = lake
    events = stg_raw_events(raw.read())
    assert plain(models.read(REPO_DAYS)) == plain(rollups.repo_days(events).select(*models.read(REPO_DAYS).columns))
    assert plain(models.read(ACTOR_DAYS)) == plain(rollups.actor_days(events).select(*models.read(ACTOR_DAYS).columns))
    assert plain(models.read(REPO_TOTALS)) == plain(rollups.repo_state(events, rollups.REPO_DAY))
    assert plain(models.read(ACTOR_TOTALS)) == plain(rollups.actor_state(events, rollups.DAILY_ACTOR))
    pushers = rollups.repo_push_stats(events).filter("unique_pushers > 0 and repo_id is not null")
    assert plain(rollups.count_pushers(models.read(REPO_PUSHERS)).filter("repo_id is not null").select(
        "repo_id", "unique_pushers")) == plain(pushers.select("repo_id", "unique_pushers"))
    assert plain(marts.daily_repo_view(models.read(REPO_DAYS), models.read(REPO_TOTALS))) == plain(marts.daily_repo(events))
    assert plain(marts.daily_actor_view(models.read(ACTOR_DAYS), models.read(ACTOR_TOTALS))) == plain(marts.daily_actor(events))
    assert plain(models.series().read(raw.spark)) == plain(trend_state(series(marts.daily_repo(events))))
    assert plain(models.events("fact_events").drop("event_date")) == plain(marts.fact_events(events))


def test_states_from_inserted_rows_equal_a_rebuild(lake):
    for rows in EVENTS:
        put(lake, rows)
        lake[1].refresh()
        assert_like_a_rebuild(lake)
    put(lake, EVENTS[0])  # nothing new
    lake[1].refresh()
    assert lake[0].last() == 3
    assert_like_a_rebuild(lake)


def test_several_loads_may_wait_for_one_refresh(lake):
    for rows in EVENTS:
        put(lake, rows)
    lake[1].refresh()
    assert_like_a_rebuild(lake)


def test_a_load_reads_and_writes_touched_partitions_only(lake):
    raw, models = lake
    put(lake, EVENTS[0])
    models.refresh()
    before = files(models.root)
    put(lake, EVENTS[2])
    fresh = raw.since(1)
    assert files_read(fresh) == 1 < len(files(raw.root))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "load_id" in plan.split("PartitionFilters")[1]
    models.refresh()
    written = set(files(models.root)) - set(before)
    assert {p: t for p, t in files(models.root).items() if p in before} == before
    days = {p.split("event_date=")[1][:10] for p in written if "event_date=" in p}
    buckets = {p.split("/v=")[0].rsplit("/", 1)[1]: 0 for p in written if "bucket=" in p}
    assert days == {"2024-01-10"} and set(buckets) == {"repo_totals", "actor_totals", "repo_pushers", "series"}
    assert sum("bucket=" in p for p in written) == 4
    assert files_read(models.read(REPO_TOTALS, models.touched(REPO_TOTALS, 1))) == 1


@pytest.mark.parametrize("step", ["overwrite_partitions", "delete"])
def test_a_crash_inside_a_load_is_finished_by_the_next(lake, monkeypatch, step):
    raw, models = lake
    put(lake, EVENTS[0])
    calls = []
    real = getattr(loading, step)

    def crash(*args):
        calls.append(args)
        if len(calls) == (2 if step == "overwrite_partitions" else 1):
            raise RuntimeError("driver lost")
        real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(loading, step, crash)
        with pytest.raises(RuntimeError):
            put(lake, EVENTS[1])
    report = put(lake, EVENTS[1])
    assert report.inserted == 0 and raw.last() == 2
    assert raw.read().count() == raw.read().select("id").distinct().count() == 68
    assert raw.held_keys(raw.read()).count() == 68
    models.refresh()
    assert_like_a_rebuild(lake)


@pytest.mark.parametrize("name", ["repo_days", "repo_pushers"])
def test_a_crash_inside_a_refresh_folds_each_load_once(lake, monkeypatch, name):
    raw, models = lake
    put(lake, EVENTS[0])
    models.refresh()
    put(lake, EVENTS[1])
    models.refresh_events()
    for state in STATES:
        if state.name != name:
            models.refresh_state(state)
    models.refresh()
    assert_like_a_rebuild(lake)


def test_totals_follow_from_the_days_folded(lake):
    """One fold of the events serves the days and the totals, unless a crash parted them."""
    models = lake[1]
    states = [REPO_DAYS, REPO_TOTALS, ACTOR_DAYS, ACTOR_TOTALS]
    for state in states:
        models.state(state)  # schemas are worked out with the folds as they are
    folded = []

    def counted(state):
        return replace(state, fold=lambda typed: folded.append(state.name) or state.fold(typed))

    put(lake, [event(1), event(2, repo=None), event(3, actor=None, at="bad"), event(4, repo=2, at="2024-01-02T00:00:00Z")])
    models.refresh([counted(state) for state in states])
    assert sorted(folded) == ["actor_days", "repo_days"]
    for state in states:
        assert plain(models.read(state)) == plain(state.fold(models.since(0)))
    put(lake, [event(5, type="PushEvent"), event(6, repo=3)])
    models.refresh_events()
    models.refresh_state(REPO_DAYS)  # and no further
    folded.clear()
    models.refresh([counted(state) for state in states])
    assert sorted(folded) == ["actor_days", "repo_totals"]
    for state in states:
        assert plain(models.read(state)) == plain(state.fold(models.since(0)))


def test_few_scattered_ids_are_looked_up_by_value(spark, tmp_path):
    raw = RawTable(spark, str(tmp_path / "raw"))
    rows = spark.range(0, 200_000, 7).select(
        (F.col("id") * 1_000_003 % 9_999_991).alias("id"), F.lit("WatchEvent").alias("type"),
        *[F.lit(None).cast("string").alias(c) for c in ("actor", "repo", "org", "payload")], F.lit(True).alias("public"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
    )
    load_batch(rows, raw.root, f"{raw.root}_bad", LOADED)
    raw.compact_keys()
    assert raw.held_keys(rows).count() == rows.select("id").distinct().count()
    ids = [r.id for r in rows.limit(3).collect()]
    probe = spark.createDataFrame([(ids[0],), (ids[1],), (5_000_000_000,)], "id long")
    held = raw.held_keys(probe)
    assert {r.id for r in held.collect()} == set(ids[:2])
    assert files_read(held) <= 3 < len(files(raw.keys.root))
    assert "In(id, [" in held._jdf.queryExecution().executedPlan().toString()
    new = load_batch(rows.limit(5).withColumn("id", F.col("id") + 20_000_000), raw.root, f"{raw.root}_bad", LOADED)
    assert new.inserted == 5 and raw.keys_of(1).count() == 5
    assert load_batch(rows, raw.root, f"{raw.root}_bad", LOADED).inserted == 0


def test_keys_fold_into_the_buckets(lake, monkeypatch):
    raw, _ = lake
    monkeypatch.setattr(loading, "COMPACT_EVERY", 2)
    for rows in EVENTS:
        put(lake, rows)
    assert raw.keys.version(raw.spark) == 2
    assert put(lake, sum(EVENTS, [])).inserted == 0
    assert sorted(r.id for r in raw.held_keys(raw.read()).collect()) == sorted(r.id for r in raw.read().collect())


def test_date_filter_prunes_the_daily_views(lake):
    _, models = lake
    put(lake, EVENTS[0])
    models.refresh()
    for view in (
        marts.daily_repo_view(models.read(REPO_DAYS), models.read(REPO_TOTALS)),
        marts.daily_actor_view(models.read(ACTOR_DAYS), models.read(ACTOR_TOTALS)),
    ):
        day = view.filter(F.col("event_date") == date(2024, 1, 4))
        plan = day._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan
        assert any("(event_date#" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
        assert day.count() > 0


def test_snapshot_leaves_files_of_unchanged_keys_alone(spark, tmp_path):
    root = str(tmp_path / "snap")
    rows = [(i, f"r{i}", "Go", "", "0-10") for i in range(200)]
    assert snapshot_table(root, spark.createDataFrame(rows, PROFILE), datetime(2024, 1, 1)) == 1
    before = files(root)
    assert snapshot_table(root, spark.createDataFrame(rows, PROFILE), datetime(2024, 1, 2)) == 1
    assert files(root) == before
    rows[17] = (17, "r17", "C", "", "0-10")
    assert snapshot_table(root, spark.createDataFrame(rows, PROFILE), datetime(2024, 1, 3)) == 2
    after = files(root)
    assert len(set(after) - set(before)) == 1 and {p: after[p] for p in before} == before
