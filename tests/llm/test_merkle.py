"""The manifest against a plain tree in Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom.llm import merkle


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return h(*(encoded(row[c]) for c in ("doc_id", "source", "lang", "n_chars")), encoded(text))


def tree(nodes):
    """The top and, per leaf, its siblings as (before, after) of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // 8 * 8
            paths[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1:run + 8])))
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], paths


def folded(node, path):
    for before, after in path:
        node = h(before, node, after)
    return node


def brute(rows):
    groups = {}
    for r in rows:
        text = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        leaf, crc = leaf_of(r, r["text"]), zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode())
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf, leaf_of(r, text) if crc % 3 == 0 else leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        tops[lang] = tree([leaf for _, leaf, _ in groups[lang]])
    root, over = tree([tops[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, above in zip(langs, over):
        subroot, paths = tops[lang]
        for (i, leaf, shown), path in zip(groups[lang], paths):
            path = path + above
            end = folded(shown, path)
            out.append((i, leaf, subroot, root, h(*(a + b for a, b in path)), end, end == root))
    return Counter(out)


def digest(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[n] for n in names) for r in merkle.manifest_digest(df).collect())


def test_digest_equals_a_plain_tree(edge, sample, empty):
    for df in (edge, sample, empty, sample.limit(1), sample.filter("lang = 'en'").limit(9)):
        assert digest(df) == brute(df.collect())


@pytest.mark.parametrize("levels", [1, 2])
def test_many_rounds(spark, sample, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8 ** levels)
    many = spark.range(1100).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit("s").alias("source"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("l"), "id")).when(F.col("id") < 600, "en").alias("lang"),
        F.lit(7).alias("n_chars"), F.lit(0).alias("pos"), F.lit(0).alias("row"), F.lit(0).alias("path"),
    )
    assert digest(many) == brute(many.collect())


def test_rows_come_back_whole_and_verify(sample):
    rows = sample.select("doc_id", "lang", "text", merkle.leaf_hash([F.col("text")]).alias("leaf"), F.lit(1).alias("root"))
    built = merkle.build_manifest(rows).select("row.*", "path", F.col("root").alias("top"))
    assert built.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("top")).isEmpty()
    assert built.filter(merkle.fold(merkle.leaf_hash([F.lit("other")]), F.col("path")) == F.col("top")).isEmpty()
    assert built.drop("path", "top").exceptAll(rows).isEmpty() and built.count() == rows.count()


def test_equal_rows_and_order(spark):
    row = (5, "same", "en", "s", 4)
    twice = spark.createDataFrame([row] * 20 + [(None, "x", "en", None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert digest(twice.repartition(4)) == brute(twice.collect())


def test_a_change_in_any_column_changes_the_root(sample):
    def root(df):
        return merkle.manifest_digest(df).select("root").distinct().collect()

    plain = root(sample)
    one = F.col("doc_id") == 7
    for c in ("source", "n_chars", "text", "lang"):
        value = F.lit(-1) if c == "n_chars" else F.lit("changed")
        assert root(sample.withColumn(c, F.when(one, value).otherwise(F.col(c)))) != plain
    assert root(sample.repartition(7)) == plain
