"""File-system lookups through Hadoop, so any store Spark can read works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in (found or [])]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(glob_paths(spark, path))


def list_files(spark: SparkSession, pattern: str) -> dict[str, str]:
    """File name -> full path for a glob."""
    return {p.rsplit("/", 1)[-1]: p for p in glob_paths(spark, pattern)}


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions below ``root``, oldest first.

    A version counts once the writer left its ``_SUCCESS`` marker, so a failed
    or running write is invisible.
    """
    marked = glob_paths(spark, f"{root}/v=*/_SUCCESS")
    return sorted(int(p.rsplit("/", 2)[-2].split("=")[1]) for p in marked)


def latest_version(spark: SparkSession, root: str) -> int:
    """Newest committed version; 0 when there is none."""
    return max(versions(spark, root), default=0)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file, making the folder it goes to."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def expire_versions(spark: SparkSession, root: str, keep: int, part: str = "") -> None:
    """Delete all but the newest ``keep`` committed versions, or one folder in them."""
    for version in versions(spark, root)[:-keep]:
        delete(spark, f"{version_path(root, version)}{part}")


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version:08d}"


def mark_version(spark: SparkSession, root: str, version: int) -> None:
    """Commit a version that has no rows of its own: progress, not data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{version_path(root, version)}/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()
    expire_versions(spark, root, 2)
