"""Session settings the library relies on, and its scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings of :func:`pin` plus the given ``conf``.

    Shuffle partitions are left to the caller and to adaptive execution, which
    coalesces them to the size of the data at run time.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Event times are UTC wall-clock text, so parsing must not use local time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated member counts with its last value, as in the text parser.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return spark


def write_together(spark: SparkSession, writes: Iterable[Callable[[], object]], threads: int = 4) -> None:
    """Run independent writes at the same time, so that the tail of one job does
    not leave the cluster idle.  The first error is raised after all have ended."""
    with ThreadPoolExecutor(threads) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for job in started:
        job.result()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder.

    Only a session that names none (a local test) gets a temporary folder, and
    only on a local master, because executors elsewhere could not read it.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="eventloom-"))
        root = context.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_root(spark), "eventloom", f"{name}-{uuid.uuid4().hex}")


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where a frame has several consumers whose plans would otherwise each
    recompute it from the raw scan.  A written table survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
