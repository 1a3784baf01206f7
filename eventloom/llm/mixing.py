"""Mixing sources to target weights, in DataFrame functions only.

Sizes are words.  One scan reduces every text to its size; the sums per source fold
inside the scan tasks, so a source with a third of all rows costs no more than
others.  Targets are the shares of the budget by weight, none above ``max_rate``
times its source; what is cut off is shared again by weight until nothing is above.
A source's repetition rate is target / size, and each of its documents appears
``floor(rate)`` times plus once more with the probability of the rest, by a hash of
its id and a seed.  Of ``SEEDS`` candidate seeds each source uses the one whose draw
takes the word count nearest its target, found in one aggregation over the sizes.

Defined results: null text has size 0; null source is a source of its own and the
last; a null id is hashed as empty text; repeated rows draw alike; a source without
words has target 0 and takes nothing.  No document is taken beyond ``max_rate``
times, and reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import WORD, id_text, text_of
from eventloom.session import stage_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_RATE = 2
SEEDS = 16
# A draw is the first 13 hex digits of an md5, that is 52 bits, as a share of 2**52.
DIGITS = 13


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _draw(seed: Column) -> Column:
    """A number in [0, 1) from the id and the seed."""
    digest = F.md5(F.concat(id_text(), F.lit(":"), seed.cast("string")))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(16 ** DIGITS))


def _copies(rate: Column, seed: Column) -> Column:
    whole = F.floor(rate)
    return (whole + (_draw(seed) < rate - whole).cast("bigint")).cast("bigint")


def _ranked(totals: DataFrame) -> DataFrame:
    """Adds ``position``, the 0-based place in code point order with null last.

    The order is a distributed sort; only the number of rows per sorted partition
    is summed in one task.
    """
    ordered = stage_table(
        totals.orderBy(F.col("source").asc_nulls_last()).withColumn("__at", F.monotonically_increasing_id()),
        "mix-order",
    ).withColumn("__part", F.shiftright("__at", 33))
    parts = ordered.groupBy("__part").agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return ordered.join(before, "__part").withColumn(
        "position", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("__at", "__part", "__before")


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE
) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size``.

    The water level L, the target of a weight of 1, is raised in rounds: sources
    whose cap lies below L times their weight are full, the rest share what is left.
    A round is one aggregation to three numbers; every round fills a source.
    """
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = stage_table(
        _ranked(totals).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(int(max_rate)))
        .drop("position"),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        below = F.col("cap") <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.coalesce(F.sum(F.when(below, F.col("cap"))), F.lit(0)), F.count(F.when(below, 1)),
            F.coalesce(F.sum(F.when(~below, F.col("weight"))), F.lit(0)),
        ).first()
        if row[1] == full or not row[2]:
            break
        full, level = row[1], (share * total - row[0]) / row[2]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE,
    seeds: int = SEEDS,
) -> tuple[DataFrame, DataFrame]:
    """The sizes ``doc_id, source, size`` of all rows, and per source its size, target,
    ``rate`` and ``seed``."""
    sizes = stage_table(docs.select("doc_id", "source", n_words(text_of()).alias("size")), "mix-sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage_table(
        source_targets(totals, weights, share, max_rate)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)),
        "mix-targets",
    )
    drawn = _with_targets(sizes, targets).select(
        "source", "target", "size", *[(F.col("size") * _copies(F.col("rate"), F.lit(s))).alias(f"s{s}") for s in range(seeds)]
    )
    taken = drawn.groupBy("source", "target").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(seeds)])
    miss = F.array_sort(F.array(*[
        F.struct(F.abs(F.col(f"s{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed")) for s in range(seeds)
    ]))
    best = taken.select(F.col("source").alias("__source"), miss[0]["seed"].alias("seed"))
    chosen = targets.join(best, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    return sizes, stage_table(chosen, "mix-chosen")


def _with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the columns of their source; adaptive execution splits a hot source."""
    mine = targets.withColumnRenamed("source", "__source")
    return rows.join(mine, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row."""
    sizes, targets = mix_plan(docs, **options)
    return _with_targets(sizes, targets).withColumn("copies", _copies(F.col("rate"), F.col("seed"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows taken 0 times go."""
    _, targets = mix_plan(docs, **options)
    targets = targets.select(*[F.col(c).alias(f"__{c}") for c in ("source", "rate", "seed")])
    rows = docs.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    copies = _copies(F.col("__rate"), F.col("__seed")).cast("int")
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies))).select(docs.columns)


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS position FROM sizes GROUP BY source),
weighted AS (
  SELECT source, source_size, [{', '.join(map(str, WEIGHTS))}][position % {len(WEIGHTS)} + 1] AS weight,
    source_size * {MAX_RATE} AS cap FROM totals),
filled AS (
  SELECT *, sum(cap) OVER w AS used, sum(weight) OVER () - sum(weight) OVER w AS rest,
    sum(source_size) OVER () * {SHARE}::DOUBLE AS budget
  FROM weighted WINDOW w AS (ORDER BY cap::DOUBLE / weight RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
levels AS (
  SELECT 0::DOUBLE AS reached, max(budget) / sum(weight)::DOUBLE AS level FROM filled
  UNION ALL
  SELECT cap::DOUBLE / weight, CASE WHEN rest > 0 THEN (budget - used)::DOUBLE / rest::DOUBLE END FROM filled),
level AS (
  SELECT coalesce(min(level) FILTER (WHERE level >= reached AND (level < next OR next IS NULL)), 0) AS level
  FROM (SELECT level, reached, lead(reached) OVER (ORDER BY reached) AS next
        FROM (SELECT reached, max(level) AS level FROM levels GROUP BY reached)) WHERE level IS NOT NULL),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * level) AS target,
    CASE WHEN source_size > 0 THEN least(cap::DOUBLE, weight * level) / source_size ELSE 0 END AS rate
  FROM weighted, level),
draws AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, g.seed,
    s.size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || g.seed), 1, {DIGITS}))::BIGINT
      / {float(16 ** DIGITS)!r}::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, range({SEEDS}) g(seed)),
chosen AS (
  SELECT source, arg_min(seed, (miss, seed)) AS seed
  FROM (SELECT source, seed, abs(sum(taken) - any_value(target)) AS miss FROM draws GROUP BY source, seed) GROUP BY source)
SELECT d.doc_id, d.size, d.source_size, d.target, d.taken
FROM draws d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.seed = c.seed
"""
