"""Tables kept up to date from the rows a load inserted, and nothing else.

The raw table only ever gains rows, and all measures merge (counts and sums add, maxima
win, sets of actors unite).  So every state is brought up to date by folding the rows of
the loads it has not seen and merging them into the partitions they fall into: the
touched days, or the touched buckets of entities.  A state's version is the last load in
it, which makes a rerun after a crash fold each load exactly once, whatever step it had
reached.  History is never read; a full rebuild is the same fold with version 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.anomaly import TREND_STATE, merge_trend_states, trend_state
from eventloom.operators.load import RAW_ON_DISK, RawTable, on_dates, overwrite_partitions
from eventloom.plans import rollups
from eventloom.plans.marts import fact_events, fct_repo_stars
from eventloom.plans.staging import stg_raw_events, typed_events
from eventloom.session import stage_table, write_together
from eventloom.sources.paths import latest_version, mark_version
from eventloom.sources.state import StateTable, bucketed, by_date
from eventloom.sources.tables import read_table

TYPED = "typed_events"
LOAD_PARTS = ("event_date", "load_id")


def _facts(typed: DataFrame) -> DataFrame:
    return fact_events(typed, *LOAD_PARTS)


def _stars(typed: DataFrame) -> DataFrame:
    return fct_repo_stars(typed.filter(F.col("event_type") == "WatchEvent"), *LOAD_PARTS)


# One row per event, kept by day and load: name -> how typed events become rows.
EVENT_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {"fact_events": _facts, "fct_repo_stars": _stars}


@dataclass(frozen=True)
class State:
    """A table that is a fold of all events.

    ``fold`` gives rows from typed events; ``merge`` makes one row of several that stand
    for the same.  Days lie by date, entities by the hash of their id.  ``finer`` names
    the state whose rows ``merge`` turns into rows of this one.
    """

    name: str
    fold: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    entity: str | None = None
    finer: str | None = None

    def table(self, root: str, schema: T.StructType) -> StateTable:
        path = f"{root}/{self.name}"
        return bucketed(path, schema, self.entity) if self.entity else by_date(path, schema)

    def united(self, held: DataFrame, fresh: DataFrame) -> DataFrame:
        return self.merge(held.unionByName(fresh))


def _repo_days(rows: DataFrame) -> DataFrame:
    return rollups.merge_repo_state(rows, rollups.REPO_DAY, ("repo_id", "event_date"))


def _actor_days(rows: DataFrame) -> DataFrame:
    return rollups.merge_actor_state(rows, rollups.DAILY_ACTOR, ("actor_id", "event_date"))


REPO_DAYS = State("repo_days", rollups.repo_days, _repo_days)
ACTOR_DAYS = State("actor_days", rollups.actor_days, _actor_days)
REPO_TOTALS = State(
    "repo_totals", lambda typed: rollups.repo_state(typed, rollups.REPO_DAY),
    lambda rows: rollups.merge_repo_state(rows, rollups.REPO_DAY), "repo_id", REPO_DAYS.name,
)
ACTOR_TOTALS = State(
    "actor_totals", lambda typed: rollups.actor_state(typed, rollups.DAILY_ACTOR),
    lambda rows: rollups.merge_actor_state(rows, rollups.DAILY_ACTOR), "actor_id", ACTOR_DAYS.name,
)
REPO_PUSHERS = State("repo_pushers", rollups.repo_pushers, rollups.merge_pushers, "repo_id")
STATES = (REPO_DAYS, ACTOR_DAYS, REPO_TOTALS, ACTOR_TOTALS, REPO_PUSHERS)


# Schemas that builders give, by what is built; they depend on nothing else.
_SCHEMAS: dict[str, T.StructType] = {}


@dataclass(frozen=True)
class Models:
    """The event tables and states below ``root`` that follow the raw table.

    ``tables`` names the event tables that are kept, ``follow_series`` whether the sums
    per series are.
    """

    raw: RawTable
    root: str
    tables: tuple[str, ...] = tuple(EVENT_TABLES)
    follow_series: bool = True

    @property
    def spark(self) -> SparkSession:
        return self.raw.spark

    def _typed_rows(self, rows: DataFrame) -> DataFrame:
        return typed_events(stg_raw_events(rows, *LOAD_PARTS), "load_id")

    def _schema(self, name: str, build: Callable[[DataFrame], DataFrame]) -> T.StructType:
        if name not in _SCHEMAS:
            empty = T.StructType([T.StructField(f.name, f.dataType) for f in RAW_ON_DISK.fields])
            _SCHEMAS[name] = build(self._typed_rows(self.spark.createDataFrame([], empty))).schema
        return _SCHEMAS[name]

    def _event_table(self, name: str, schema: T.StructType) -> DataFrame:
        fields = [f for f in schema.fields if f.name not in LOAD_PARTS]
        parts = [T.StructField("event_date", T.DateType()), T.StructField("load_id", T.IntegerType())]
        return read_table(self.spark, f"{self.root}/{name}", T.StructType(fields + parts))

    def typed(self) -> DataFrame:
        rows = self._event_table(TYPED, self._schema(TYPED, lambda typed: typed))
        return rows.filter(F.col("load_id") <= self.events_version())

    def events(self, name: str) -> DataFrame:
        """One of :data:`EVENT_TABLES`."""
        rows = self._event_table(name, self._schema(name, EVENT_TABLES[name]))
        return rows.filter(F.col("load_id") <= self.events_version()).drop("load_id")

    def events_version(self) -> int:
        return latest_version(self.spark, f"{self.root}/events_done")

    def state(self, state: State) -> StateTable:
        return state.table(self.root, self._schema(state.name, state.fold))

    def read(self, state: State, only: Sequence | None = None) -> DataFrame:
        return self.state(state).read(self.spark, only)

    def refresh_events(self) -> None:
        """Parse the rows of the new loads once and write them by day and load.

        The raw table has its rows by day and load already, in files of an even size, and
        a task reads a few of them: nothing is shuffled, and each file becomes one.
        """
        after, last = self.events_version(), self.raw.last()
        if after >= last:
            return
        overwrite_partitions(self._typed_rows(self.raw.since(after)), f"{self.root}/{TYPED}", *LOAD_PARTS)
        fresh = self._event_table(TYPED, self._schema(TYPED, lambda typed: typed)).filter(
            F.col("load_id").between(after + 1, last) & on_dates(self.raw.dates(after))
        )
        write_together(self.spark, [
            partial(overwrite_partitions, EVENT_TABLES[name](fresh), f"{self.root}/{name}", *LOAD_PARTS)
            for name in self.tables
        ])
        mark_version(self.spark, f"{self.root}/events_done", last)

    def since(self, after: int) -> DataFrame:
        """Typed events of the loads past ``after``; reads only the dates they touched."""
        return self.typed().filter(F.col("load_id") > after).filter(on_dates(self.raw.dates(after)))

    def refresh_state(self, state: State, coarser: Sequence[State] = ()) -> None:
        """Fold the events of the new loads into ``state``, and its rows into the ``coarser`` states."""
        table, last = self.state(state), self.events_version()
        after = table.version(self.spark)
        # One that a crash left at another load has events of its own to fold.
        level = [other for other in coarser if self.state(other).version(self.spark) == after]
        if after < last:
            changes = stage_table(state.fold(self.since(after)), "changes")
            table.merge_in(changes, state.united, last)
            for other in level:
                self.state(other).upsert(other.merge(changes), other.united, last)
        for other in coarser:
            if other not in level:
                self.refresh_state(other)

    def series(self) -> StateTable:
        """The sums a trend or deviation needs, per repository's series of daily counts."""
        return bucketed(f"{self.root}/series", TREND_STATE, "repo_id")

    def refresh_series(self) -> None:
        """Bring the sums up to date: touched days leave with their old count and come
        back with the new one.  Needs :data:`REPO_DAYS` at the last load."""
        table, last = self.series(), self.events_version()
        after = table.version(self.spark)
        if after >= last:
            return
        grown = self.since(after).groupBy("repo_id", "event_date").agg(F.count("*").alias("more"))
        dates = [d for d in self.raw.dates(after) if d is not None]
        now = self.read(REPO_DAYS, dates).join(grown, ["repo_id", "event_date"]).select(
            "repo_id", F.col("event_date").alias("ds"), F.col("total_events").alias("y"), "more"
        )
        now = stage_table(now, "grown")
        before = now.withColumn("y", F.col("y") - F.col("more")).filter("y > 0")
        changes = trend_state(now).unionByName(trend_state(before, F.lit(-1)))
        table.upsert(changes, lambda held, fresh: merge_trend_states(held.unionByName(fresh)), last)

    def refresh(self, states: Sequence[State] = STATES) -> None:
        """Bring the event tables and ``states`` up to the last load."""
        self.refresh_events()
        names = {state.name for state in states}
        write_together(self.spark, [
            partial(self.refresh_state, state, [other for other in states if other.finer == state.name])
            for state in states if state.finer not in names
        ])
        if self.follow_series and REPO_DAYS in states:
            self.refresh_series()

    def repo_totals(self, only: Sequence | None = None) -> DataFrame:
        """Every repository measure over all days, with the number of distinct pushers."""
        return rollups.with_pushers(self.read(REPO_TOTALS, only), self.read(REPO_PUSHERS, only))

    def touched(self, state: State, after: int) -> list:
        """Partitions of ``state`` that the loads past ``after`` fall into."""
        return self.state(state).values_in(state.fold(self.since(after)))


def touched_keys(days: DataFrame, key: str, dates: Sequence[date | None]) -> DataFrame:
    """Entities with an event on one of the dates, as a table of one column."""
    return stage_table(
        days.filter(on_dates(dates)).select(F.col(key).alias("_touched")).distinct(), "touched"
    )


def of_touched(df: DataFrame, key: str, touched: DataFrame) -> DataFrame:
    return df.join(touched, F.col(key).eqNullSafe(F.col("_touched")), "left_semi")


def with_touched_replaced(
    previous: DataFrame, fresh: DataFrame, key: str, touched: DataFrame
) -> DataFrame:
    """``previous`` with the rows of the touched entities replaced by ``fresh``.

    Only rows of touched entities are aggregated again; the others pass by in
    an anti join, against a broadcast when few entities were touched.
    """
    kept = previous.join(touched, F.col(key).eqNullSafe(F.col("_touched")), "left_anti")
    return kept.unionByName(fresh)
