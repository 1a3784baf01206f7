"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.oracle import ORACLE
from checks.queries import QUERIES
from eventloom.operators.load import near_keys
from eventloom.plans import marts, rollups, staging

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, raw, tmp_path):
    from tests.test_models import messy_events

    raw(messy_events()).write.parquet(str(tmp_path / "raw"))
    return staging.stg_raw_events(spark.read.parquet(str(tmp_path / "raw")))


def test_daily_facts_scan_once_and_read_no_payload(table):
    plan = plan_of(marts.daily_repo(table))
    assert plan.count("FileScan") == 1
    assert "Join" not in plan
    assert "payload" not in plan.split("ReadSchema")[1]


def test_profile_scans_once_without_joins_or_expand(table):
    plan = plan_of(rollups.repo_profile(table, "2024-02-01"))
    assert plan.count("FileScan") == 1
    assert "Join" not in plan and "Expand" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_no_model_uses_python_or_a_single_partition(table):
    for model in (marts.daily_repo, marts.daily_actor, marts.dim_actor, marts.fact_events,
                  rollups.repo_push_stats, rollups.repo_languages, staging.stg_actors):
        plan = plan_of(model(table))
        assert not [word for word in ("SinglePartition", "EvalPython", "InPandas") if word in plan]


def test_near_keys_reach_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(5,), (7,), (900,)], "id bigint")
    kept = near_keys(target, batch, "id")
    assert sorted(r.id for r in kept.collect()) == [5, 6, 7, 900]
    pushed = plan_of(kept).split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(id,900)" in pushed and "LessThanOrEqual(id,7)" in pushed


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"anomaly_piecewise"}


@pytest.mark.parametrize("name", ["trending_repos", "scd2", "anomaly_piecewise", "stream_daily"])
def test_queries_run_at_the_smallest_scale(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
    assert not [f for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
    assert df.select(F.count("*")).first()[0] == df.count()
