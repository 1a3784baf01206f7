"""Ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import stage_table


def value_ranges(values: DataFrame) -> DataFrame:
    """Adds ``at``, a number that grows with the descending order of (measure, value),
    and ``part``, the range a value fell into.

    The borders are sampled by the sort, so a range holds about as many values as any
    other, however they are spread.
    """
    # Written once: a second evaluation could sample other borders.
    return stage_table(
        values.orderBy("measure", F.col("value").desc_nulls_first())
        .withColumn("at", F.monotonically_increasing_id()),
        "rank-values",
    ).withColumn("part", F.shiftright("at", 33))


def _ranked_values(values: DataFrame) -> DataFrame:
    """``rank()`` descending of each distinct (measure, value) weighted by ``n``.

    A value's rank is one more than the rows above it: those of higher ranges, and
    those before it inside its own.
    """
    ranged = value_ranges(values)
    inside = (
        Window.partitionBy("measure", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per range and measure, that is per partition of the sort.
    above = Window.partitionBy("measure").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("measure", "part").agg(F.sum("n").alias("part_n")).select(
        "measure", "part", F.coalesce(F.sum("part_n").over(above), F.lit(0)).alias("above_part")
    )
    return (
        ranged.withColumn("above_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(totals, ["measure", "part"])
        .select("measure", "value", (F.col("above_part") + F.col("above_inside") + 1).alias("rank"))
    )


def global_rank(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """Add ``rank() over (order by column desc)`` for each ``column -> name``.

    Equal to the un-partitioned window (ties share a rank, gaps follow, NULL first),
    but only the distinct values are ordered, and by a distributed sort.  They are
    joined back; adaptive execution broadcasts them when they turn out to be few, and
    else splits a value that most rows share.  ``df`` is read once per rank and once
    more, so pass a table, not a long plan; the columns must have a common type.
    """
    columns = list(ranks)
    entries = F.array(*[F.struct(F.lit(i).alias("measure"), F.col(c).alias("value"))
                        for i, c in enumerate(columns)])
    values = (
        df.select(F.explode(entries).alias("e")).select("e.*")
        .groupBy("measure", "value").agg(F.count("*").alias("n"))
    )
    ranked = stage_table(_ranked_values(values), "ranks")
    result = df
    for i, c in enumerate(columns):
        lookup = ranked.filter(F.col("measure") == i).select(
            F.col("value").alias("_value"), F.col("rank").alias(ranks[c])
        )
        result = result.join(lookup, F.col(c).eqNullSafe(F.col("_value")), "left").drop("_value")
    return result


def top_k_with_ties(df: DataFrame, column: str, k: int, name: str = "rank") -> DataFrame:
    """Rows with ``rank() over (order by column desc) <= k``; ties all stay.

    Only the k largest distinct values can hold such a rank.  They are found by
    a distributed top-k and joined back; the lookup has at most k rows.
    """
    top = (
        df.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("n"))
        .orderBy(F.col("_value").desc_nulls_first()).limit(k)
    )
    above = Window.orderBy(F.col("_value").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    lookup = (
        top.withColumn(name, F.coalesce(F.sum("n").over(above), F.lit(0)) + 1)
        .filter(F.col(name) <= k).select("_value", name)
    )
    return df.join(F.broadcast(lookup), F.col(column).eqNullSafe(F.col("_value"))).drop("_value")
