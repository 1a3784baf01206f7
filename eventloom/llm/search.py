r"""Ranked lexical search by NRA: sorted reads only, score intervals per document.

1. One scan turns every text into its length and the counts of the query's terms; texts
   go no further.  The number of documents, their total length and the documents per
   term come from that table, over all rows.
2. Each task cuts its documents into shards.  In a shard every term has its list of
   (document, impact), sorted by impact, and an item reads its terms' lists from the top,
   ever deeper.  The impacts read so far are a document's lower bound; its upper bound
   adds, for each list it was not yet seen in, the last impact read there.  A document
   whose upper bound is under the k-th best lower bound is out; when the sum of the last
   impacts is under it too, no unseen document can come in.  Reading goes on until every
   document that is left has equal bounds, so that scores and ties are final.
3. The shards' best are merged per item: k rows per item and shard, ranked with a limit
   on the map side.

So lists are never moved, nothing is per item and document but the arrays of one shard,
and a term that stands in every document is cut into as many lists as there are shards.
The query set is dealt into blocks of at most ``BLOCK_PAIRS`` items x terms (more only for
one item that has more); a block's terms go to the tasks with the function, and every
further block reads the texts again.

Defined results: null and empty texts have no terms and are found by nothing; texts are
read whole; rows of documents count one by one, also with equal or null ids (null is
ranked first among equal scores); rows of one item id are one item with all their terms,
a null id is an item; items without terms, and empty tables, give no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import UPPER, blocks, bytes_of, fold, pin_batches, spaced
from eventloom.session import stage_table

K = 50
BLOCK_PAIRS = 1 << 19
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 21
FIRST_DEPTH, DEEPER = 64, 4

# Fixed value: the signs of a term, all that is neither below nor between digits and letters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IN_TERM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _IN_TERM[_low:_high + 1] = False


@dataclass(frozen=True)
class QueryBlock:
    """Items with the places of their terms in ``terms``, which is sorted."""

    item_ids: list
    term_lists: list[np.ndarray]
    terms: list[bytes]


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id, term``."""
    low = F.translate("text", UPPER, UPPER.lower())
    return items.select("item_id", F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def query_blocks(items: DataFrame, most: int = BLOCK_PAIRS) -> Iterator[QueryBlock]:
    """The query set in blocks of at most ``most`` pairs of item and term, each item whole."""
    pairs = stage_table(item_terms(items), "search-items")
    parts = max(1, -(-pairs.count() // most))
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(parts))
        sizes = pairs.groupBy(block.alias("block")).agg(
            F.count("*").alias("pairs"), F.min("item_id").eqNullSafe(F.max("item_id")).alias("single")
        )
        if sizes.filter((F.col("pairs") > most) & ~F.col("single")).isEmpty():
            break
        parts *= 2
    for row in sizes.orderBy("block").collect():
        mine: dict = {}
        for item, term in pairs.filter(block == row["block"]).toLocalIterator():
            mine.setdefault(item, []).append(term.encode())
        terms = sorted({t for found in mine.values() for t in found})
        place = {t: i for i, t in enumerate(terms)}
        yield QueryBlock(list(mine), [np.array(sorted(place[t] for t in found)) for found in mine.values()], terms)


def _counts(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text, and text, term and number of every query term found, in that order."""
    data, starts = spaced(*bytes_of(texts))
    data = fold(data)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = _IN_TERM[data]
    first = np.flatnonzero(np.diff(inside) == 1)
    kept = inside[1:].astype(bool)
    letters = data[kept]
    # Every run of kept bytes is a term; a text ends with a space, so none crosses texts.
    ends = np.flatnonzero(kept[:-1] & ~kept[1:]) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - first)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    )
    of = np.searchsorted(starts, first, side="right") - 1
    n = np.bincount(of, minlength=len(texts))
    found = pc.index_in(words, value_set=terms)
    known = np.asarray(found.is_valid())
    pair = of[known] * np.int64(len(terms)) + found.drop_null().to_numpy(zero_copy_only=False)
    pair, tf = np.unique(pair, return_counts=True)
    return n, pair // max(1, len(terms)), pair % max(1, len(terms)), tf


def term_counts(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tfs``: each row's length and the query terms in it."""
    pin_batches(docs.sparkSession)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pa.array(terms, pa.large_binary())
        for rows in blocks(batches):
            texts = rows.column("text")
            n, of, term, tf = _counts(texts, values)
            cuts = pa.array(np.searchsorted(of, np.arange(rows.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(term, pa.int32())),
                pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int64())),
            ], names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, schema)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to a document's score, in 64-bit whole numbers."""
    m = 50 + (50 * n * documents) // max(1, length)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Lists:
    """A shard's list of (document, impact) for every term, highest impact first."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int, n_docs: int) -> None:
        live = impact > 0
        term, doc, impact = term[live], doc[live], impact[live]
        order = np.lexsort((-impact, term))
        self.doc, self.impact, self.n_docs = doc[order], impact[order], n_docs
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))

    def nra(self, terms: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best documents and their scores; of equal scores the lower ``rank``."""
        first, length = self.start[terms], self.start[terms + 1] - self.start[terms]
        first, length = first[length > 0], length[length > 0]
        lower = np.zeros(self.n_docs, dtype=np.int64)
        read, depth, alive = np.zeros_like(length), FIRST_DEPTH, None
        seen_doc, seen_list = [], []
        while True:
            stop = np.minimum(length, depth)
            size = stop - read
            lists = np.repeat(np.arange(len(first)), size)
            at = (first + read)[lists] + np.arange(len(lists)) - np.repeat(np.cumsum(size) - size, size)
            if alive is not None:
                wanted = alive[self.doc[at]]
                at, lists = at[wanted], lists[wanted]
            np.add.at(lower, self.doc[at], self.impact[at])
            seen_doc.append(self.doc[at])
            seen_list.append(lists)
            read = stop
            last = np.where(read < length, self.impact[first + read - 1], 0)
            unseen = int(last.sum())
            upper = lower + unseen
            for docs, of in zip(seen_doc, seen_list):
                np.subtract.at(upper, docs, last[of])
            found = np.flatnonzero(lower if alive is None else alive)
            kth = int(np.partition(lower[found], len(found) - k)[len(found) - k]) if len(found) >= k else 0
            left = found[upper[found] >= kth]
            if unseen < kth or unseen == 0:
                alive = np.zeros(self.n_docs, dtype=bool)
                alive[left] = True
                if (upper[left] == lower[left]).all():
                    best = left[np.lexsort((rank[left], -lower[left]))[:k]]
                    return best, lower[best]
            depth *= DEEPER


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            size = len(part.column("terms").flatten())
            if held and (docs + part.num_rows > SHARD_DOCS or postings + size > SHARD_POSTINGS):
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
            held.append(part)
            docs, postings = docs + part.num_rows, postings + size
    if held:
        yield pa.Table.from_batches(held)


def _best_of_shards(counts: DataFrame, query: QueryBlock, item_type: T.DataType, k: int) -> DataFrame:
    """``item_id, doc_id, score``: every shard's ``k`` best of each item."""
    spark = counts.sparkSession
    row = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    documents, length = int(row[0]), int(row[1])
    weight = np.zeros(len(query.terms), dtype=np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    item_ids, term_lists = query.item_ids, query.term_lists
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), counts.schema["doc_id"], T.StructField("score", T.LongType()),
    ])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            shard = shard.combine_chunks()
            ids = shard.column("doc_id").combine_chunks()
            terms = shard.column("terms").combine_chunks()
            sizes = terms.value_lengths().to_numpy()
            doc = np.repeat(np.arange(shard.num_rows), sizes)
            term = terms.flatten().to_numpy()
            tf = shard.column("tfs").combine_chunks().flatten().to_numpy()
            n = shard.column("n").to_numpy()
            lists = Lists(term, doc, impacts(weight[term], tf, n[doc], documents, length), len(weight), shard.num_rows)
            rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
            item, best, score = [], [], []
            for i, wanted in enumerate(term_lists):
                docs, scores = lists.nra(wanted, rank, k)
                item.append(np.full(len(docs), i))
                best.append(docs)
                score.append(scores)
            if item:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(item), pa.int32()), ids.take(pa.array(np.concatenate(best))),
                    pa.array(np.concatenate(score), pa.int64()),
                ], names=["item", "doc_id", "score"])

    names = spark.createDataFrame(
        list(enumerate(item_ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)])
    )
    ranked = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first()))
    best = counts.mapInArrow(search, schema).withColumn("rank", ranked).filter(F.col("rank") <= k)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, most: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    item_type = items.schema["item_id"].dataType
    found = None
    for query in query_blocks(items, most):
        counts = stage_table(term_counts(docs, query.terms), "search-counts")
        best = _best_of_shards(counts, query, item_type, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), docs.schema["doc_id"],
            T.StructField("score", T.LongType()),
        ]))
    return found


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS ws
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT rid, doc_id, len(ws)::BIGINT AS n FROM d),
total AS (SELECT count(*) FILTER (WHERE n > 0) AS docs, sum(n)::BIGINT AS length FROM sized),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM benchmark),
tf AS (
  SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY rid, term),
w AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
scored AS (
  SELECT item_id, rid, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN sized USING (rid), total GROUP BY item_id, rid)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {K}
"""
