"""Replay, landing, loading and daily counts as streaming queries.

Flushing is the trigger's business: a time interval and a bound on files or
offsets per micro-batch.  Progress is checkpointed with the sink's own log, so
a restart neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from eventloom.operators.load import LoadFailed, LoadReport, RawTable, insert_if_absent, load_batch, near_keys
from eventloom.operators.normalize import normalize, split_corrupt
from eventloom.plans.incremental import REPO_DAYS, REPO_TOTALS, Models
from eventloom.plans.marts import daily_repo_view
from eventloom.schemas import FEED, HOUR_PARTITIONS
from eventloom.sources.feed import LANDING_ON_DISK, decode, json_object
from eventloom.sources.tables import append_table, read_table
from eventloom.streaming.runlog import BatchLog

# Flush settings of the live consumer (fixed values).
FLUSH_ROWS = 5000
FLUSH_DELAY = "30s"
FLUSH_INTERVAL = "30 seconds"
# Files count however long ago they were written.
ANY_AGE = "36500d"
DEDUPE_LANES = 16


def read_topic(
    spark: SparkSession, servers: str, topic: str,
    flush_rows: int = FLUSH_ROWS, flush_delay: str = FLUSH_DELAY, **options: str
) -> DataFrame:
    """Messages of a Kafka topic from its beginning: key, value, received_at.

    A micro-batch starts once ``flush_rows`` messages wait or ``flush_delay``
    has passed, and takes all that wait.  Needs Spark's Kafka package.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("minOffsetsPerTrigger", flush_rows).option("maxTriggerDelay", flush_delay)
        .options(**options).load()
        .select("key", "value", F.col("timestamp").alias("received_at"))
    )


def write_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Send replayed messages (key, value) to a Kafka topic."""
    writer = messages.writeStream.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).option("topic", topic)
    return _start(writer, None, checkpoint, interval)


def read_message_files(
    spark: SparkSession, folder: str, received_at: datetime | None = None, max_files: int = 100
) -> DataFrame:
    """Files of one message per line, as the same columns as a topic.

    ``received_at`` stands in for the arrival time; by default it is the time
    the file was written.
    """
    lines = (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", ANY_AGE).load(folder)
    )
    arrived = (
        F.lit(received_at).cast("timestamp") if received_at
        else F.col("_metadata.file_modification_time")
    )
    return lines.select(F.lit(None).cast("string").alias("key"), "value", arrived.alias("received_at"))


def replay_messages(lines: DataFrame) -> DataFrame:
    """Feed lines as messages: verbatim text keyed by event id.

    Blank lines and lines that are not a JSON object are dropped.  The rate is
    set by the files per trigger of the source, not by sleeping.
    """
    text = F.trim("value")
    found = lines.withColumn("_message", json_object(text, StructType([FEED["id"]])))
    event_id = F.col("_message.id")
    return found.filter(F.col("_message").isNotNull()).select(
        F.when(F.length(event_id) > 0, event_id).alias("key"), text.alias("value")
    )


def landing_rows(messages: DataFrame) -> DataFrame:
    """Landing rows of the readable messages, bad ids kept under a stable hash."""
    good, _ = split_corrupt(decode(messages, F.col("value")))
    return normalize(good, on_bad_id="hash", received_at=F.col("received_at"))


def unreadable_messages(messages: DataFrame) -> DataFrame:
    return split_corrupt(decode(messages, F.col("value")))[1]


def _start(
    writer: DataStreamWriter, path: str | None, checkpoint: str, interval: str | None
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def land_stream(
    messages: DataFrame, root: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL
) -> StreamingQuery:
    """Land a stream by event hour.  No watermark: late events land like any other.

    Without ``interval`` the query takes what is there and stops.  The folder
    must be the stream's own: its commit log decides which files count.
    """
    rows = landing_rows(messages)
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(*HOUR_PARTITIONS)
    return _start(writer, root, checkpoint, interval)


def quarantine_stream(
    messages: DataFrame, root: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL
) -> StreamingQuery:
    writer = unreadable_messages(messages).writeStream.format("parquet").outputMode("append")
    return _start(writer, root, checkpoint, interval)


def load_stream(
    spark: SparkSession, landing_root: str, raw_root: str, quarantine_root: str, checkpoint: str,
    loaded_at: datetime, interval: str | None = None, max_files: int = 1000,
    on_loaded: Callable[[LoadReport], None] | None = None, log: BatchLog | None = None,
) -> StreamingQuery:
    """Load every landed file, whatever hour it belongs to, exactly once by key.

    A micro-batch that is repeated after a failure inserts nothing again,
    because the insert itself is keyed.  ``on_loaded`` gets each report, for
    instance to refresh the days it names; it is repeated with its batch.  ``log``
    learns the input of a batch that fails.  Run one loader of a table at a time.
    """
    landed = (
        spark.readStream.schema(LANDING_ON_DISK).option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", ANY_AGE).option("pathGlobFilter", "*.parquet").parquet(landing_root)
    )

    def load(batch: DataFrame, number: int) -> None:
        try:
            report = load_batch(batch, raw_root, quarantine_root, loaded_at)
        except LoadFailed as error:
            if log:
                log.failed(number, error.processed)
            raise
        if on_loaded:
            on_loaded(report)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        landed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def dedupe_stream(landing: DataFrame, event_at: Column, lanes: int = DEDUPE_LANES) -> DataFrame:
    """Drop repeats of an id, however late they arrive; every id stays once.

    Copies are first dropped per (id, lane), the lane being the task that read
    them, so that one much repeated id is spread over ``lanes`` tasks; the
    second step then sees at most ``lanes`` copies.  There is no watermark, so
    the state holds every id; ``dedupe_into`` keeps them in a table instead.
    """
    timed = landing.withColumn("event_at", event_at)
    if lanes > 1:
        timed = (
            timed.withColumn("_lane", F.spark_partition_id() % lanes)
            .dropDuplicates(["id", "_lane"]).drop("_lane")
        )
    return timed.dropDuplicates(["id"])


def dedupe_into(rows: DataFrame, root: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep one row per id of a stream in the table at ``root``, however late it arrives.

    Each micro-batch inserts what the table does not hold yet, so a batch that is
    repeated after a failure inserts nothing again and no state grows with the
    stream.  Rows without an id are refused.  Run one writer of a table at a time.
    """
    schema = rows.schema
    order = [F.xxhash64(*schema.names).asc()]

    def insert(batch: DataFrame, _: int) -> None:
        held = near_keys(read_table(batch.sparkSession, root, schema), batch, "id")
        fresh = insert_if_absent(batch, held, "id", order)
        append_table(fresh.sortWithinPartitions("id"), root)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return rows.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def daily_repo_stream(
    spark: SparkSession, landing_root: str, root: str, checkpoint: str, loaded_at: datetime,
    interval: str | None = None, max_files: int = 1000,
) -> StreamingQuery:
    """Keep the daily facts per repository equal to the batch ones while events arrive.

    Each micro-batch is loaded by key into ``raw`` below ``root``; the rows it inserted
    are folded and merged into the days they fall on.  No event is read again, so a late
    one costs its own row and the measures of its day.  There is no watermark: late and
    undated events count like any other, and open days are there at once.  A batch that
    is repeated after a failure is merged once.  Read the result with
    ``daily_repo_streamed``.
    """
    def refresh(_: LoadReport) -> None:
        _streamed(spark, root).refresh([REPO_DAYS, REPO_TOTALS])

    return load_stream(
        spark, landing_root, f"{root}/raw", f"{root}/quarantine", checkpoint, loaded_at,
        interval, max_files, on_loaded=refresh,
    )


def daily_repo_streamed(spark: SparkSession, root: str) -> DataFrame:
    """The daily facts that ``daily_repo_stream`` keeps below ``root``."""
    models = _streamed(spark, root)
    return daily_repo_view(models.read(REPO_DAYS), models.read(REPO_TOTALS))


def _streamed(spark: SparkSession, root: str) -> Models:
    return Models(RawTable(spark, f"{root}/raw"), f"{root}/states", tables=(), follow_series=False)
