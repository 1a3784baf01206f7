"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Every text is reduced to ``STATS`` statistics in one vectorised pass.
2. A forest of shallow trees is grown on the labelled rows; every path from a root is
   a conjunctive rule over the statistics.
3. A lasso logistic regression on the rules' indicators keeps few of them.
4. The rules that are left become one Spark column expression for the score.

Labels, language, source and id are no inputs of a score.  The statistics of the
labelled rows are all that training reads, so it moves no text; growing and fitting
run on the cluster over all labelled rows.  The model is at most ``TREES * 2 **
(DEPTH + 1)`` rules, a fixed bound.

Defined results: null text is empty text, whose statistics are all 0; with labels of
one kind, or none, the score is their smoothed share; a label row without a
document, or a null label, is ignored; repeated rows are scored alike; other columns
are passed on or ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import SpanHash, blocks, bytes_of, crc_mod, fold, pin_batches, spaced, text_of, words
from eventloom.session import stage_table

TREES, DEPTH, LASSO, SEED = 24, 3, 0.001, 17
CUT = 0.3

# Byte classes: lower, upper, digit, blank, line end, stop, pause, exclamation, bar,
# symbol, other ASCII, first byte of a longer character, its further bytes.
LOWER, UPPER, DIGIT, BLANK, LINE, STOP, PAUSE, CRY, BAR, SYMBOL, OTHER, LEAD, TAIL = range(13)
STATS = (
    "chars", "words", "word_chars", "lower", "upper", "digit", "stop", "pause", "cry", "bar", "symbol", "other",
    "long_char", "distinct", "echo", "line_words", "line_repeat", "symbol_end", "upper_words", "long_words",
)


def _classes() -> np.ndarray:
    of = np.full(256, OTHER, dtype=np.int64)
    for letters, kind in (
        ("abcdefghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), ("0123456789", DIGIT),
        (" \t\x0b\x0c", BLANK), ("\r\n", LINE), (".?", STOP), (",;:", PAUSE), ("!", CRY), ("|", BAR),
        ("#$%&*@~^=+<>\\_{}[]", SYMBOL),
    ):
        of[[ord(c) for c in letters]] = kind
    of[0x80:0xC0] = TAIL
    of[0xC0:] = LEAD
    return of


_CLASS = _classes()
_HASH = SpanHash()


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes per owner."""
    if not len(hashes):
        return np.zeros(n)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n).astype(float)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATS`` for each text of a column without nulls."""
    raw, starts = bytes_of(column)
    n = len(column)
    data, starts = spaced(raw, starts)
    owner = np.repeat(np.arange(n), np.diff(starts))
    kind = _CLASS[data]
    count = np.bincount(owner * 13 + kind, minlength=13 * n).reshape(n, 13).astype(float)
    count[:, BLANK] -= 1
    chars = count.sum(axis=1) - count[:, TAIL]
    first, last = words(data)
    word_of = np.searchsorted(starts, first, side="right") - 1
    n_words = np.bincount(word_of, minlength=n).astype(float)
    sums = _HASH.prefix(fold(data))
    h = _HASH.spans(sums, first, last)
    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (word_of[1:] == word_of[:-1])
    # A line ends at a line break or where its text ends.
    stops = np.union1d(np.flatnonzero(kind == LINE), starts[1:] - 1)
    begins = np.append(0, stops[:-1] + 1)
    full = stops > begins
    begins, stops = begins[full], stops[full]
    line_of = np.searchsorted(starts, begins, side="right") - 1
    lines = np.bincount(line_of, minlength=n).astype(float)
    ends_odd = kind[last - 1] if len(last) else np.zeros(0, dtype=np.int64)
    glyphs = np.maximum(chars - count[:, BLANK] - count[:, LINE], 1)
    w = np.maximum(n_words, 1)
    length = (last - first).astype(float)
    caps = np.concatenate([[0], np.cumsum(kind == UPPER)])
    shout = (caps[last] - caps[first] >= 2) & (caps[last] - caps[first] >= 0.5 * length)
    line_hash = _HASH.spans(sums, begins, stops)
    columns = [
        np.log1p(chars), np.log1p(n_words), glyphs * (n_words > 0) / w,
        *(count[:, c] / glyphs for c in (LOWER, UPPER, DIGIT, STOP, PAUSE, CRY, BAR, SYMBOL, OTHER, LEAD)),
        _distinct(h, word_of, n) / w, _per_text(same, word_of, n) / w, np.log1p(n_words / np.maximum(lines, 1)),
        (lines - _distinct(line_hash, line_of, n)) / np.maximum(lines, 1),
        _per_text(np.isin(ends_odd, (SYMBOL, BAR, CRY)), word_of, n) / w,
        _per_text(shout, word_of, n) / w, _per_text(length > 20, word_of, n) / w,
    ]
    return np.stack(columns, axis=1)


def with_stats(df: DataFrame) -> DataFrame:
    """``df`` with a column of doubles for each statistic of its ``text``."""
    pin_batches(df.sparkSession)
    names = [stat_column(s) for s in STATS]
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.DoubleType()) for c in names])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(iter([batch.append_column("__filled", batch.column("text").fill_null(""))]), "__filled"):
                values = statistics(block.column("__filled"))
                kept = block.drop_columns(["__filled"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *(pa.array(values[:, i]) for i in range(len(names)))],
                    names=[*kept.schema.names, *names],
                )

    return df.mapInArrow(add, schema)


def stat_column(stat: str) -> str:
    return f"__stat_{stat}"


@dataclass(frozen=True)
class RuleModel:
    """``rules`` are (weight, conditions); a condition is (statistic, is_above, limit)."""

    intercept: float
    rules: tuple

    def score(self) -> Column:
        total = reduce(
            lambda a, b: a + b,
            [F.when(_holds(conditions), F.lit(weight)).otherwise(0.0) for weight, conditions in self.rules],
            F.lit(self.intercept),
        )
        return 1.0 / (1.0 + F.exp(-total))


def _holds(conditions) -> Column:
    return reduce(lambda a, b: a & b, [
        (F.col(stat_column(s)) > limit) if above else (F.col(stat_column(s)) <= limit) for s, above, limit in conditions
    ])


def tree_rules(text: str) -> list[tuple]:
    """Every path of the forest's printed form as a sorted tuple of conditions.

    Several limits on one side of a statistic shrink to the binding one.
    """
    rules, path = {}, []
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip())
        found = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-+.eE\d]+)\)", line)
        if re.match(r"\s*Tree \d+", line):
            path = []
        if not found:
            continue
        path = [p for p in path if p[0] < depth]
        path.append((depth, (STATS[int(found[1])], found[2] == ">", float(found[3]))))
        binding: dict = {}
        for _, (stat, above, limit) in path:
            known = binding.get((stat, above), limit)
            binding[stat, above] = max(known, limit) if above else min(known, limit)
        rules[tuple(sorted((s, a, v) for (s, a), v in binding.items()))] = None
    return list(rules)


def fit_rules(labelled: DataFrame) -> RuleModel:
    """A model from rows of statistics and ``label`` (0 or 1)."""
    counts = {int(r[0]): r[1] for r in labelled.groupBy("label").count().collect()}
    prior = RuleModel(math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)), ())
    if min(counts.get(0, 0), counts.get(1, 0)) < 1:
        return prior
    features = array_to_vector(F.array(*[F.col(stat_column(s)) for s in STATS]))
    rows = labelled.withColumn("features", features)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64, featureSubsetStrategy="onethird", minInstancesPerNode=5
    ).fit(rows.select("features", F.col("label").cast("double").alias("label")))
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return prior
    indicators = array_to_vector(F.array(*[_holds(r).cast("double") for r in rules]))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, aggregationDepth=2).fit(
        labelled.select(indicators.alias("features"), F.col("label").cast("double").alias("label"))
    )
    weights = lasso.coefficients.toArray()
    kept = tuple((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-9)
    return RuleModel(float(lasso.intercept), kept)


def train(stats: DataFrame, labels: DataFrame, folds: int = 5) -> RuleModel:
    """Fits on the labelled rows whose id does not fall into the held-out fold."""
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label")).filter("label in (0, 1)")
    rows = stats.filter(crc_mod(folds) != 0).join(known, "doc_id")
    return fit_rules(stage_table(rows.select("label", *[stat_column(s) for s in STATS]), "quality-labelled"))


def doc_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and statistics of every row, written once for training and scoring."""
    return stage_table(with_stats(docs.select("doc_id", text_of().alias("text"))).drop("text"), "quality-stats")


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    stats = doc_stats(docs)
    score = train(stats, labels, folds).score()
    return stats.select("doc_id", (crc_mod(folds) == 0).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int")
    )


def quality_filter(docs: DataFrame, labels: DataFrame, folds: int = 5, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject; no text is shuffled."""
    model = train(doc_stats(docs), labels, folds)
    return with_stats(docs).filter(model.score() >= cut).select(docs.columns)
