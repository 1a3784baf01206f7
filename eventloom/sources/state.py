"""State tables: rewritten partition by partition, with a version per rewrite.

``root/v=<n>/<part>=<value>/`` holds what version ``n`` rewrote and nothing else.  The
table as of a version is, for each partition, its newest committed copy, so a run reads
and writes the partitions it touches and the files of all others stay as they are.  A
version counts once its ``_SUCCESS`` marker is there; a failed run is invisible and its
folder is overwritten by the next attempt.  Where the version number is that of the last
load folded in, a rerun after a crash folds every load exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import stage_table
from eventloom.sources.paths import delete, glob_paths, latest_version, version_path, versions
from eventloom.sources.tables import KEEP_VERSIONS

BUCKET = "bucket"
BUCKETS = 64
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class StateTable:
    """A table whose rows belong to one partition each, by ``part_of``.

    ``part`` is a column of ``schema`` (a date, say) or, as in :func:`bucketed`, one
    that is kept in the folder names only.
    """

    root: str
    schema: T.StructType
    part: str
    part_type: T.DataType
    part_of: Callable[[], Column]
    sort: str | None = None
    keep: int = KEEP_VERSIONS
    options: tuple[tuple[str, str], ...] = ()

    def version(self, spark: SparkSession) -> int:
        return latest_version(spark, self.root)

    def folders(self, spark: SparkSession) -> dict[str, str]:
        """Partition value -> its newest committed folder."""
        newest: dict[str, tuple[int, str]] = {}
        committed = set(versions(spark, self.root))
        for path in glob_paths(spark, f"{self.root}/v=*/{self.part}=*"):
            version, value = path.rsplit("/", 2)[-2:]
            number, value = int(version.split("=")[1]), unquote(value.split("=", 1)[1])
            if number in committed and number > newest.get(value, (0, ""))[0]:
                newest[value] = (number, path)
        return {value: path for value, (_, path) in newest.items()}

    def read(self, spark: SparkSession, only: Iterable | None = None) -> DataFrame:
        """The rows of all partitions, or of those with the values in ``only``."""
        folders = self.folders(spark)
        if only is not None:
            wanted = {NO_VALUE if value is None else str(value) for value in only}
            folders = {value: path for value, path in folders.items() if value in wanted}
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields])
        if not folders:
            return spark.createDataFrame([], nullable)
        on_disk = T.StructType([f for f in nullable.fields if f.name != self.part])
        on_disk = on_disk.add(T.StructField("v", T.IntegerType())).add(T.StructField(self.part, self.part_type))
        rows = spark.read.schema(on_disk).option("basePath", self.root).parquet(*sorted(folders.values()))
        return rows.select(*self.schema.names)

    def values_in(self, rows: DataFrame) -> list:
        """The partition values of ``rows``; few by construction (days, or buckets)."""
        return [r[0] for r in rows.select(self.part_of().alias(self.part)).distinct().collect()]

    def write(self, rows: DataFrame, version: int | None = None) -> int:
        """Commit ``rows`` as the new content of every partition they belong to.

        Partitions without rows keep their content; a version without rows is committed too.
        """
        spark = rows.sparkSession
        version = self.version(spark) + 1 if version is None else version
        parted = rows.select(*self.schema.names).withColumn(self.part, self.part_of())
        ordered = [self.part, self.sort] if self.sort else [self.part]
        # Adaptive execution splits a partition that holds most rows and merges small ones.
        (
            parted.hint("rebalance", self.part).sortWithinPartitions(*ordered)
            .write.mode("overwrite").options(compression="zstd", **dict(self.options)).partitionBy(self.part)
            .parquet(version_path(self.root, version))
        )
        self.expire(spark)
        return version

    def upsert(
        self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None
    ) -> int:
        """Replace the touched partitions by ``merge(their rows, changes)``."""
        return self.merge_in(stage_table(changes, "changes"), merge, version)

    def merge_in(
        self, staged: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None
    ) -> int:
        """:meth:`upsert` of changes that are a table already."""
        touched = self.values_in(staged)
        return self.write(merge(self.read(staged.sparkSession, touched), staged), version)

    def expire(self, spark: SparkSession) -> None:
        """Delete copies of partitions that no version among the newest ``keep`` shows."""
        old = versions(spark, self.root)[:-max(self.keep, 1) + 1 or None]
        if not old:
            return
        copies: dict[str, list[int]] = {}
        for path in glob_paths(spark, f"{self.root}/v=*/{self.part}=*"):
            number, value = int(path.rsplit("/", 2)[-2].split("=")[1]), path.rsplit("/", 1)[-1]
            if number in old:
                copies.setdefault(value, []).append(number)
        shown = {max(numbers) for numbers in copies.values()}
        for number in old[:-1]:
            if number not in shown:
                delete(spark, version_path(self.root, number))
        for value, numbers in copies.items():
            for number in set(numbers) - {max(numbers)}:
                delete(spark, f"{version_path(self.root, number)}/{value}")


def bucketed(
    root: str, schema: T.StructType, key: str, buckets: int = BUCKETS, keep: int = KEEP_VERSIONS, **options: str
) -> StateTable:
    """A table dealt into ``buckets`` by a hash of ``key``; a null key has a bucket as well."""
    return StateTable(
        root, schema, BUCKET, T.IntegerType(), lambda: bucket_of(key, buckets), key, keep, tuple(options.items())
    )


def by_date(root: str, schema: T.StructType, column: str = "event_date", keep: int = KEEP_VERSIONS) -> StateTable:
    return StateTable(root, schema, column, T.DateType(), lambda: F.col(column), None, keep)
