"""Keyed load: insert what is not there yet, refresh what a load touched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.timeparse import parse_event_ts
from eventloom.operators.latest import first_per_key
from eventloom.operators.normalize import bad_row_reason
from eventloom.schemas import LANDING, RAW_EVENTS
from eventloom.session import stage_table, write_together
from eventloom.sources.paths import delete, glob_paths, latest_version, version_path, versions
from eventloom.sources.state import StateTable, bucket_of, bucketed
from eventloom.sources.tables import append_absent, read_table

STAGED = T.StructType(
    [T.StructField(f.name, f.dataType) for f in RAW_EVENTS.fields]
    + [T.StructField("event_date", T.DateType())]
)
RAW_ON_DISK = T.StructType(STAGED.fields + [T.StructField("load_id", T.IntegerType())])
LOADS = T.StructType([T.StructField("event_date", T.DateType())])
KEYS = T.StructType([T.StructField("id", T.LongType())])
NEW_KEYS = T.StructType(
    KEYS.fields + [T.StructField("bucket", T.IntegerType()), T.StructField("load_id", T.IntegerType())]
)
KEY_SLICES = 64
# So many ids are looked up by value: what Spark pushes into a scan as a list.
POINTS = 10
# Loads whose ids may wait to be folded into the buckets of the index.
COMPACT_EVERY = 48


def insert_if_absent(
    batch: DataFrame, target: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """Rows of ``batch`` to append: one per key, none already in ``target``.

    The first row under ``order`` wins inside the batch and the target always
    wins over the batch.  Rows without a key are refused.
    """
    keyed = batch.filter(F.col(key).isNotNull())
    # The per-key choice comes first: it drops copies before its shuffle, so a
    # much repeated key is one row per task, and the anti join reuses that shuffle.
    return first_per_key(keyed, [key], order).join(target.select(key), key, "left_anti")


def near_keys(
    target: DataFrame, batch: DataFrame, key: str, bounds: tuple[int, int] | None = None,
    slices: int = KEY_SLICES,
) -> DataFrame:
    """``target`` without rows whose key cannot occur in ``batch``.

    The batch's key range (``bounds`` if already known) is cut into equal slices
    and each occupied slice contributes the smallest and largest key in it, so
    at most ``slices`` intervals reach the scan, where Parquet statistics skip
    the rest of the table.  Exact for any data; effective because feed ids grow
    with time.
    """
    low, high = bounds or batch.agg(F.min(key), F.max(key)).first()
    if low is None:
        return target.limit(0)
    width = (int(high) - int(low)) // slices + 1
    slot = F.floor((F.col(key).cast("decimal(38,0)") - F.lit(low)) / F.lit(width))
    intervals = (
        batch.filter(F.col(key).isNotNull()).groupBy(slot.alias("slot"))
        .agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    )
    within = F.lit(False)
    for row in intervals:
        within = within | F.col(key).between(row.lo, row.hi)
    return target.filter(within)


@dataclass
class LoadReport:
    processed: int
    inserted: int
    rejected: int
    # Event dates of the accepted rows, also of those already loaded.  None stands
    # for an unreadable event time.
    dates: list[date | None] = field(default_factory=list)
    # The load the inserted rows belong to, or the last one if there were none.
    load_id: int = 0


def delivery_order() -> list[Column]:
    """A total order over copies of one event, so that reruns choose alike."""
    rest = [name for name in LANDING.names if name not in ("id", "created_at")]
    return [F.col("created_at").asc_nulls_last(), F.xxhash64(*rest).asc()]


@dataclass(frozen=True)
class RawTable:
    """The raw table below ``root``, its loads and the index of its ids.

    Rows lie by event date and load.  A load first writes its rows to ``staged``; from
    then on it is finished by whoever comes next: its partitions of the table and of the
    index are overwritten as a whole, so doing that twice changes nothing, and its dates
    in ``loads`` commit it.  Run one loader of a table at a time.
    """

    spark: SparkSession
    root: str

    @property
    def staged(self) -> str:
        return f"{self.root}_staged"

    @property
    def loads(self) -> str:
        return f"{self.root}_loads"

    @property
    def keys(self) -> StateTable:
        """Ids of the loads up to its version, by hash, with Bloom filters in the files."""
        return bucketed(
            f"{self.root}_keys/old", KEYS, "id", **{
                "parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true",
            },
        )

    @property
    def new_keys(self) -> str:
        """Ids of the loads since, by hash and load."""
        return f"{self.root}_keys/new"

    def last(self) -> int:
        """The last load that is complete; 0 before the first."""
        return latest_version(self.spark, self.loads)

    def read(self) -> DataFrame:
        """All rows of complete loads."""
        return read_table(self.spark, self.root, RAW_ON_DISK).filter(F.col("load_id") <= self.last())

    def dates(self, after: int = 0) -> list[date | None]:
        """Event dates of the rows of all loads past ``after``."""
        found = [version_path(self.loads, n) for n in versions(self.spark, self.loads) if n > after]
        if not found:
            return []
        rows = self.spark.read.schema(LOADS).parquet(*found).distinct().collect()
        return sorted((r.event_date for r in rows), key=lambda d: (d is None, d or date.min))

    def since(self, after: int) -> DataFrame:
        """The rows of the loads past ``after``; reads only the dates they touched."""
        return self.read().filter(F.col("load_id") > after).filter(on_dates(self.dates(after)))

    def held_keys(self, batch: DataFrame) -> DataFrame:
        """The ids held that can occur in ``batch``.

        The index is read in the buckets of the batch only.  There a few ids are looked
        up by value, which Bloom filters and statistics answer per file, and many by
        the intervals of :func:`near_keys`.
        """
        ids = batch.select("id").filter(F.col("id").isNotNull())
        last, old = self.last(), self.keys
        found = ids.agg(
            F.collect_set(bucket_of("id")).alias("buckets"), F.min("id").alias("low"), F.max("id").alias("high"),
            F.approx_count_distinct("id").alias("n"),
        ).first() if last else None
        if not found or found.low is None:
            return self.spark.createDataFrame([], KEYS)
        new = read_table(self.spark, self.new_keys, NEW_KEYS).filter(
            F.col("bucket").isin(found.buckets) & F.col("load_id").between(old.version(self.spark) + 1, last)
        )
        held = old.read(self.spark, found.buckets).unionByName(new.select("id"))
        if found.n <= POINTS:
            few = [r.id for r in ids.distinct().limit(2 * POINTS).collect()]
            if len(few) <= POINTS:
                return held.filter(F.col("id").isin(few))
        return near_keys(held, ids, "id", (found.low, found.high))

    def keys_of(self, after: int) -> DataFrame:
        """Every row's id, for all ids that the loads past ``after`` brought."""
        fresh = stage_table(self.since(after).select("id").distinct(), "fresh-ids")
        return self.held_keys(fresh).join(fresh, "id", "left_semi")

    def finish(self) -> int:
        """Complete the staged load, if there is one; returns the last complete load."""
        spark, last = self.spark, self.last()
        number = latest_version(spark, self.staged)
        if number <= last:
            return last
        rows = spark.read.schema(STAGED).parquet(version_path(self.staged, number)).withColumn(
            "load_id", F.lit(number)
        )
        # Adaptive execution sizes the rebalanced partitions: a day that holds most
        # rows is split over tasks, small days share one.
        table = rows.select(*RAW_ON_DISK.names).hint("rebalance", "event_date").sortWithinPartitions("event_date", "id")
        ids = rows.select("id", bucket_of("id").alias("bucket"), "load_id").hint("rebalance", "bucket")
        write_together(spark, [
            lambda: overwrite_partitions(table, self.root, "event_date", "load_id"),
            lambda: overwrite_partitions(ids.sortWithinPartitions("bucket", "id"), self.new_keys, "bucket", "load_id"),
        ])
        rows.select("event_date").distinct().write.mode("overwrite").parquet(version_path(self.loads, number))
        delete(spark, version_path(self.staged, number))
        if number - self.keys.version(spark) >= COMPACT_EVERY:
            self.compact_keys()
        return number

    def compact_keys(self) -> None:
        """Fold the ids of all complete loads into the buckets."""
        last, old = self.last(), self.keys
        new = read_table(self.spark, self.new_keys, NEW_KEYS).filter(
            F.col("load_id").between(old.version(self.spark) + 1, last)
        )
        old.upsert(new.select("id"), lambda held, ids: held.unionByName(ids), last)
        for path in glob_paths(self.spark, f"{self.new_keys}/bucket=*/load_id=*"):
            if int(path.rsplit("=", 1)[1]) <= last:
                delete(self.spark, path)


def overwrite_partitions(rows: DataFrame, root: str, *parts: str) -> None:
    """Overwrite the partitions ``rows`` belong to, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(root)


class LoadFailed(RuntimeError):
    """A load broke off after it had read ``processed`` rows."""

    def __init__(self, processed: int) -> None:
        super().__init__(f"load failed after reading {processed} rows")
        self.processed = processed


def load_batch(landing: DataFrame, raw_root: str, quarantine_root: str, loaded_at: datetime) -> LoadReport:
    """Insert a landing batch into the raw table; rerunning it inserts nothing.

    The batch is evaluated once.  Rows that break the table contract go to quarantine,
    the others are stamped and, if their id is new, become a load of :class:`RawTable`.
    """
    spark = landing.sparkSession
    raw = RawTable(spark, raw_root)
    last = raw.finish()
    flagged = stage_table(
        landing.select(*LANDING.names).withColumn("reason", bad_row_reason())
        .withColumn("event_date", F.to_date(parse_event_ts(F.col("created_at")))),
        "load",
    )
    accepted = F.col("reason").isNull()
    seen = flagged.agg(
        F.count("*").alias("n"), F.count("reason").alias("bad"),
        F.collect_set(F.when(accepted, F.col("event_date"))).alias("dates"),
        F.count_if(accepted & F.col("event_date").isNull()).alias("undated"),
    ).first()
    dates: list[date | None] = sorted(seen.dates)
    report = LoadReport(seen.n, 0, seen.bad, dates + [None] * bool(seen.undated), last)
    stamp = F.lit(loaded_at).cast("timestamp").alias("loaded_at")
    try:
        batch = flagged.filter(accepted).drop("reason").select("*", stamp)
        fresh = insert_if_absent(batch, raw.held_keys(batch), "id", delivery_order()).select(*STAGED.names)
        inserted, path = Observation(), version_path(raw.staged, last + 1)
        counted = fresh.observe(inserted, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(path)
        if spark.read.schema(STAGED).parquet(path).isEmpty():
            delete(spark, path)
        else:
            report.load_id, report.inserted = raw.finish(), inserted.get["n"]
        if seen.bad:
            append_absent(flagged.filter(~accepted).drop("event_date").select("*", stamp), quarantine_root, LANDING.names)
    except Exception as error:
        raise LoadFailed(seen.n) from error
    return report


def on_dates(dates: Sequence[date | None]) -> Column:
    """Predicate on the partition column ``event_date``; prunes partitions."""
    known = [d for d in dates if d is not None]
    hit = F.col("event_date").isin(known) if known else F.lit(False)
    return hit | F.col("event_date").isNull() if len(known) < len(dates) else hit
