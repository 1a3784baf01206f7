"""Ranked search against scores of all documents in Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import search
from tests.llm.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(search.TERM, (text or "").translate(LOWER))


def brute(docs, items, k):
    words = [(i, terms_of(t)) for i, t in docs]
    n_docs, length = sum(1 for _, w in words if w), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, wanted in queries.items():
        found = []
        for i, w in words:
            tf = Counter(t for t in w if t in wanted)
            m = 50 + (50 * len(w) * n_docs) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c) // (1000 * c + 20 * m)) for t, c in tf.items())
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def run(docs, items, **options):
    return sorted((tuple(r) for r in search.ranked_search(docs, items, **options).collect()), key=str)


ITEMS = "item_id long, text string, term string, rank string"


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "t", "r") for r in rows], ITEMS)


def pairs(df, a, b="text"):
    return [(r[a], r[b]) for r in df.select(a, b).collect()]


@pytest.mark.parametrize("k", [1, 50])
def test_equals_scores_of_all_documents(spark, sample, k):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert run(sample, items, k=k) == brute(pairs(sample, "doc_id"), pairs(items, "item_id"), k)


def test_edge_rows(spark, edge, empty):
    rows = [(1, "one TWO passage"), (1, "bytes of it"), (2, None), (None, "Word5 word6 É ÀÉ x"), (3, " ,;: "), (4, "İ 中文 😀")]
    items = items_of(spark, rows)
    for docs in (edge, empty):
        assert run(docs, items) == brute(pairs(docs, "doc_id"), rows, 50)
    assert run(edge, items_of(spark, [])) == []


def test_many_shards_and_blocks(spark, sample, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 16)
    monkeypatch.setattr(search, "FIRST_DEPTH", 1)
    monkeypatch.setattr(search, "DEEPER", 2)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(15)
    want = brute(pairs(sample, "doc_id"), pairs(items, "item_id"), 7)
    assert run(sample.repartition(5), items, k=7, most=60) == want


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(300)] + [(i, "nothing") for i in range(300, 999)], "doc_id long, text string")
    got = run(docs.repartition(6), items_of(spark, [(1, "here same")]))
    assert [(r[1], r[2]) for r in sorted(got, key=lambda r: r[1])] == [(i + 1, i) for i in range(50)]
    assert len({r[3] for r in got}) == 1


def test_reading_stops_before_the_lists_end():
    """A rare high impact settles the item without the tail of the common list."""
    n = 5000
    doc = np.concatenate([np.arange(n), np.arange(60)])
    term = np.concatenate([np.zeros(n, dtype=int), np.ones(60, dtype=int)])
    impact = np.concatenate([np.full(n, 10), np.full(60, 10_000)])
    lists = search.Lists(term, doc, impact, 2, n)
    best, score = lists.nra(np.array([0, 1]), np.arange(n), 50)
    assert best.tolist() == list(range(50)) and set(score.tolist()) == {10_010}


@pytest.mark.parametrize("seed", range(20))
def test_nra_on_random_lists(seed):
    rng = np.random.default_rng(seed)
    n_docs, n_terms = int(rng.integers(1, 400)), int(rng.integers(1, 12))
    pair = rng.choice(n_docs * n_terms, size=int(rng.integers(0, n_docs * n_terms + 1)), replace=False)
    doc, term, impact = pair // n_terms, pair % n_terms, rng.integers(0, 6, len(pair))
    lists = search.Lists(term, doc, impact, n_terms, n_docs)
    total = np.bincount(doc, weights=impact, minlength=n_docs).astype(int)
    order = np.lexsort((np.arange(n_docs), -total))
    want = [d for d in order if total[d] > 0][:10]
    best, score = lists.nra(np.arange(n_terms), np.arange(n_docs), 10)
    assert best.tolist() == want and score.tolist() == total[want].tolist()


def test_words_in_every_document_weigh_nothing(spark):
    docs = spark.createDataFrame([(i, "common") for i in range(2000)], "doc_id long, text string")
    assert run(docs, items_of(spark, [(1, "common")])) == brute(pairs(docs, "doc_id"), [(1, "common")], 50)
    assert search.ranked_search(docs.withColumn("n", F.lit(1)), items_of(spark, [(1, "absent")])).count() == 0
