"""Warehouse tables on plain Parquet: contracts, replaced and appended tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import stage_table
from eventloom.sources.paths import exists, expire_versions, latest_version, version_path


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; absent ones become NULL."""
    def column(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def contract_breaks(
    df: DataFrame, schema: T.StructType, max_lengths: dict[str, int] | None = None
) -> DataFrame:
    """Rows of ``df`` that the table contract refuses, with the ``reason``."""
    return df.withColumn("reason", broken_rule(df, schema, max_lengths)).filter(F.col("reason").isNotNull())


def broken_rule(df: DataFrame, schema: T.StructType, max_lengths: dict[str, int] | None = None) -> Column:
    """The first rule of the contract a row breaks: a value that does not convert, an
    absent required value, a text too long.  NULL for a good row."""
    reason = F
    for field in schema.fields:
        if field.name not in df.columns:
            continue
        value = F.col(field.name)
        reason = reason.when(
            value.isNotNull() & value.try_cast(field.dataType).isNull(),
            f"{field.name} is not {field.dataType.simpleString()}",
        )
        if not field.nullable:
            reason = reason.when(value.isNull(), f"{field.name} missing")
    for name, limit in (max_lengths or {}).items():
        reason = reason.when(F.length(name) > limit, f"{name} longer than {limit}")
    return reason.otherwise(None)


def split_by_contract(
    df: DataFrame, schema: T.StructType, max_lengths: dict[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows in the shape of ``schema``, rows it refuses with the ``reason``).

    ``df`` is written once, as both parts read it.
    """
    staged = stage_table(df, "contract")
    bad = contract_breaks(staged, schema, max_lengths)
    reason = "reason" if "reason" not in df.columns else "_reason"
    flagged = staged.withColumn(reason, broken_rule(staged, schema, max_lengths))
    return enforce_schema(flagged.filter(F.col(reason).isNull()), schema), bad


KEEP_VERSIONS = 5


def replace_table(df: DataFrame, root: str, keep: int = KEEP_VERSIONS) -> int:
    """Write ``df`` as the next version of the table, also when it is empty.

    Readers keep the previous version until the new one is committed, and the
    plan of ``df`` may read that previous version.  Versions beyond the newest
    ``keep`` are deleted.
    """
    spark = df.sparkSession
    version = latest_version(spark, root) + 1
    df.write.mode("overwrite").parquet(version_path(root, version))
    expire_versions(spark, root, max(keep, 1))
    return version


def read_latest(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    version = latest_version(spark, root)
    if not version:
        if schema is None:
            raise FileNotFoundError(f"no committed version below {root}")
        return spark.createDataFrame([], _nullable(schema))
    reader = spark.read if schema is None else spark.read.schema(_nullable(schema))
    return reader.parquet(version_path(root, version))


def append_table(df: DataFrame, root: str) -> None:
    df.write.mode("append").parquet(root)


def append_absent(df: DataFrame, root: str, identity: list[str]) -> None:
    """Append rows whose ``identity`` columns are not in the table yet.

    For small side tables such as quarantines, so that a rerun repeats nothing.
    """
    marked = df.withColumn("fingerprint", F.sha2(F.to_json(F.struct(*identity)), 256))
    marked = marked.dropDuplicates(["fingerprint"])
    known = read_table(df.sparkSession, root, marked.schema).select("fingerprint")
    append_table(marked.join(known, "fingerprint", "left_anti"), root)


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A plain (appended or partitioned) table; no rows before its first write."""
    # Names with a leading "_" or "." are markers and uncommitted work.
    if not exists(spark, f"{root}/[^_.]*"):
        return spark.createDataFrame([], _nullable(schema))
    return spark.read.schema(_nullable(schema)).parquet(root)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
