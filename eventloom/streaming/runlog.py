"""What micro-batches did, as rows of the run table: failed ones too."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from eventloom.schemas import PIPELINE_METRICS

WAIT_SECONDS = 60


class BatchLog(StreamingQueryListener):
    """Collects the progress of the queries that run inside its ``with`` block.

    Spark reports a micro-batch once it is done; of one that fails it reports only that
    the query ended, so the batch function tells its input by :meth:`failed`.  Events come
    on a thread of their own, a query's end as its last.  Names of queries must be unique
    within a block.
    """

    def __init__(self, spark: SparkSession) -> None:
        super().__init__()
        self.spark = spark
        self._changed = threading.Condition()
        self._open: set[str] = set()
        self._batches: list[tuple[str, int, int, int, str]] = []
        self._input: tuple[int, int] | None = None

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        with self._changed:
            self._changed.wait_for(lambda: not self._open, WAIT_SECONDS)
        self.spark.streams.removeListener(self)

    def failed(self, batch_id: int, rows: int) -> None:
        """The batch function read so many rows before it failed."""
        self._input = (batch_id, rows)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._open.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        done = event.progress
        if done.numInputRows:
            millis = dict(done.durationMs).get("triggerExecution", 0)
            self._batches.append((str(done.id), done.batchId, done.numInputRows, millis // 1000, "SUCCESS"))

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            if event.exception:
                batch_id, rows = self._input or (-1, 0)
                self._batches.append((str(event.id), batch_id, rows, 0, "FAILED"))
            self._open.discard(str(event.runId))
            self._changed.notify_all()

    def input_rows(self) -> int:
        """Rows read by all batches, and by the one that failed."""
        return sum(rows for _, _, rows, _, _ in self._batches) or (self._input or (0, 0))[1]

    def rows(self, run_id: str, logical_hour: datetime, run_ts: datetime) -> DataFrame:
        """One run row per micro-batch."""
        made = [
            (f"{run_id}/{query[:8]}/{batch}", logical_hour, rows, 0, 0, 0, seconds, status, run_ts)
            for query, batch, rows, seconds, status in self._batches
        ]
        return self.spark.createDataFrame(made, PIPELINE_METRICS)
