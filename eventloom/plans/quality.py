"""Declared data tests: not-null, unique, relationships and row assertions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.plans.staging import EVENT_VIEWS

# The declared tests (fixed values): 28 not-null, 11 unique, 2 relationships, 2 assertions.
NOT_NULL = {
    "raw_events": ["id", "type", "created_at"],
    "stg_raw_events": ["event_id", "event_type"],
    "stg_watch_events": ["event_id", "repo_id"],
    "stg_push_events": ["event_id", "push_id"],
    "stg_create_events": ["event_id"],
    "stg_fork_events": ["event_id"],
    "stg_issues_events": ["event_id", "issue_id"],
    "stg_pull_request_events": ["event_id", "pr_id"],
    "dim_actor": ["actor_id", "actor_login"],
    "dim_repo": ["repo_id", "repo_name", "is_current"],
    "dim_date": ["date_id"],
    "fact_events": ["event_id", "event_type", "actor_id", "date_id"],
    "fct_daily_repo_metrics": ["repo_id", "event_date", "total_events"],
}
STAGED_UNIQUE = ["watch", "push", "create", "fork", "issues", "pull_request"]
UNIQUE = {
    "raw_events": "id", "dim_actor": "actor_id", "dim_date": "date_id", "fact_events": "event_id",
}
RELATIONSHIPS = [
    ("fact_events", "actor_id", "dim_actor", "actor_id"),
    ("fact_events", "date_id", "dim_date", "date_id"),
]


def bad_intervals(dim_repo: DataFrame) -> DataFrame:
    """Versions that end before they start."""
    return dim_repo.filter(F.col("valid_to") < F.col("valid_from"))


def negative_stars(watch_stats: DataFrame) -> DataFrame:
    return watch_stats.filter(F.col("star_count") < 0)


ASSERTIONS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "assert_dim_repo_date_range_valid": ("dim_repo", bad_intervals),
    "assert_repo_stars_non_negative": ("int_repo_watch_stats", negative_stars),
}


def _unpivot(counts: DataFrame, test: str, entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per (table, column, counter column) of a one-row frame."""
    rows = F.array(*[
        F.struct(
            F.lit(test).alias("test"), F.lit(table).alias("table"), F.lit(column).alias("column"),
            F.coalesce(F.col(counter), F.lit(0)).cast("bigint").alias("failures"),
        )
        for table, column, counter in entries
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def not_null(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column; all columns of a table in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns])
    return _unpivot(counts, "not_null", [(table, c, f"n_{c}") for c in columns])


def unique(df: DataFrame, column: str, tables: Mapping[str, Column | None]) -> DataFrame:
    """Values occurring more than once, NULL aside.

    ``tables`` maps a reported table to the condition that selects its rows, so
    views cut from one table are checked by one grouping.
    """
    conditions = {t: F.lit(True) if w is None else w for t, w in tables.items()}
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        *[F.count_if(w).alias(f"n_{t}") for t, w in conditions.items()]
    )
    counts = per_value.agg(*[F.count_if(F.col(f"n_{t}") > 1).alias(f"n_{t}") for t in conditions])
    return _unpivot(counts, "unique", [(t, column, f"n_{t}") for t in conditions])


def relationships(
    table: str, child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Child rows whose key, if any, has no parent.

    Child rows fold to one per key first, so a key shared by many rows neither
    skews nor widens the join.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(
        F.count("*").alias("n")
    )
    known = parent.select(F.col(field).alias("_key"))
    counts = keys.join(known, "_key", "left_anti").agg(F.sum("n").alias("n"))
    return _unpivot(counts, "relationships", [(table, column, "n")])


def expect_empty(name: str, table: str, rows: DataFrame) -> DataFrame:
    return _unpivot(rows.agg(F.count("*").alias("n")), name, [(table, "", "n")])


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


def _results(parts: Sequence[DataFrame]) -> DataFrame:
    return with_status(reduce(DataFrame.unionByName, parts))


def not_null_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _results([not_null(t, tables[t], columns) for t, columns in NOT_NULL.items()])


def unique_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    staged = {
        f"stg_{view}_events": F.col("event_type").isin(*EVENT_VIEWS[view].types)
        for view in STAGED_UNIQUE
    }
    return _results([
        unique(tables["stg_raw_events"], "event_id", {"stg_raw_events": None, **staged}),
        *[unique(tables[t], column, {t: None}) for t, column in UNIQUE.items()],
    ])


def relationship_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _results([
        relationships(t, tables[t], column, tables[parent], field)
        for t, column, parent, field in RELATIONSHIPS
    ])


def assertion_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _results([expect_empty(name, t, rule(tables[t])) for name, (t, rule) in ASSERTIONS.items()])


def run_checks(tables: Mapping[str, DataFrame], keys: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Results of every declared test, one row each.

    Where ``tables`` hold a part of the rows, ``keys`` may name a wider table whose key
    column the uniqueness tests read instead.
    """
    return reduce(DataFrame.unionByName, [
        not_null_checks(tables), unique_checks({**tables, **(keys or {})}),
        relationship_checks(tables), assertion_checks(tables),
    ])


class QualityError(RuntimeError):
    """Raised by the quality gate; carries the failing results."""

    def __init__(self, failures: list):
        super().__init__("; ".join(
            f"{r.test}({r.table}.{r.column}): {r.failures}" for r in failures
        ))
        self.failures = failures
