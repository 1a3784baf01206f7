"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph (a line that is not empty) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane modulo a power of two:

* ``EXACT`` lanes of 64 bits, each another mix of the paragraph's hashes.  Equal
  multisets of paragraphs have equal sums, others differ but for a negligible chance;
* ``SKETCH`` lanes of 32 bits.  The paragraph's runs of ``RUN`` words each add 1 or -1
  to one lane, so that the cosine of two sums estimates how much of their text two
  documents share.

The order of paragraphs does not matter, and adding or subtracting the fingerprint of
some paragraphs inserts or deletes them without the rest of the text (``merge``).

``edited_fingerprints`` also needs the next document.  Documents are dealt out by
ranges of ``doc_id`` between quantiles that are computed first, and sorted there, so the
next one is the next row; only the first and last row of each range meet in a second,
small step.  Every text is shuffled once.

Defined results: null text is empty; an empty text has the zero vector, equal only to
itself; ids sort ascending with null first, equal ids by text, so repeated rows follow
each other; a single document is its own next; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import SpanHash, blocks, bytes_of, mix, pin_batches, shingle_hashes, shuffle_parts, spaced, text_of, words

EXACT, SKETCH, RUN = 16, 128, 3
_ONE, _TWO = SpanHash(1), SpanHash(2)
_ODD = mix(np.arange(7001, 7001 + EXACT, dtype=np.uint64)) | np.uint64(1)


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Exact and sketch lanes of each text of a column without nulls."""
    n = len(column)
    data, starts = spaced(*bytes_of(column))
    data = np.ascontiguousarray(data)
    stops = np.union1d(np.flatnonzero(data == 10), starts[1:] - 1)
    begins = np.append(0, stops[:-1] + 1)
    full = stops > begins
    begins, stops = begins[full], stops[full]
    owner = np.searchsorted(starts, begins, side="right") - 1
    sums = _ONE.prefix(data)
    one = _ONE.spans(sums, begins, stops)
    two = _TWO.spans(_TWO.prefix(data), begins, stops)
    exact = np.zeros((n, EXACT), dtype=np.uint64)
    if len(owner):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        for j in range(EXACT):
            exact[owner[first], j] = np.add.reduceat(mix(one * _ODD[j] + two), first)
    first, last = words(data)
    h = _ONE.spans(sums, first, last)
    begin = np.searchsorted(first, np.append(begins, len(data)))
    runs, count = shingle_hashes(h, begin[:-1], np.diff(begin), RUN)
    lane = np.repeat(owner, count) * SKETCH + (runs % np.uint64(SKETCH)).astype(np.int64)
    sign = 1.0 - 2.0 * ((runs >> np.uint64(40)) & np.uint64(1)).astype(float)
    sketch = np.bincount(lane, weights=sign, minlength=n * SKETCH).reshape(n, SKETCH)
    return exact, sketch.astype(np.int64).astype(np.int32)


def pack(exact: np.ndarray, sketch: np.ndarray) -> list[str]:
    rows = np.concatenate([exact.astype("<u8").view(np.uint8), sketch.astype("<i4").view(np.uint8)], axis=1)
    return [base64.b64encode(row.tobytes()).decode() for row in rows]


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[:8 * EXACT], "<u8"), np.frombuffer(raw[8 * EXACT:], "<i4")


def merge(fingerprint: str, paragraphs: str, delete: bool = False) -> str:
    """The fingerprint with the paragraphs of another one inserted or deleted."""
    (a, b), (c, d) = unpack(fingerprint), unpack(paragraphs)
    exact, sketch = (a - c, b - d) if delete else (a + c, b + d)
    return pack(exact[None], sketch[None])[0]


def likeness(one, two) -> np.ndarray:
    """Row by row, 1 for equal fingerprints, else the cosine of the sketches within 0 and 1."""
    (a, b), (c, d) = one, two
    b, d = b.astype(float), d.astype(float)
    size = np.sqrt((b * b).sum(axis=1) * (d * d).sum(axis=1))
    cosine = np.clip((b * d).sum(axis=1) / np.maximum(size, 1e-300), 0.0, 1.0)
    return np.where((a == c).all(axis=1) & (b == d).all(axis=1), 1.0, cosine)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` for every row; a map over the scan without a shuffle."""
    pin_batches(docs.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(pack(*vectors(block.column("text"))), pa.string())],
                names=["doc_id", "fingerprint"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(
        add, "doc_id long, fingerprint string"
    )


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _edited(ids: list, texts: list[str], following: list[str], own, next_) -> pa.RecordBatch:
    size = [len(t) for t in texts]
    edited = [t[:n - n // 4] + f[:n // 4] for t, n, f in zip(texts, size, following)]
    changed = vectors(pa.array(edited, pa.string()))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(size, pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(pack(*own), pa.string()), pa.array(pack(*changed), pa.string()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, next_)),
    ], names=_NAMES)


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row but the last of a sorted partition, with the row after it."""
    ids, texts, held = [], [], None
    for block in blocks(batches):
        here = vectors(block.column("text"))
        both = here if held is None else tuple(np.concatenate([h[-1:], v]) for h, v in zip(held, here))
        ids += block.column("doc_id").to_pylist()
        texts += block.column("text").to_pylist()
        if len(ids) > 1:
            yield _edited(ids[:-1], texts[:-1], texts[1:], tuple(v[:-1] for v in both), tuple(v[1:] for v in both))
        ids, texts, held = ids[-1:], texts[-1:], here


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row of a sorted range."""
    first, last = None, None
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1) if first is None else first
            last = batch.slice(batch.num_rows - 1)
    if first is not None:
        yield pa.RecordBatch.from_arrays(
            [first.column("part"), first.column("text"), last.column("doc_id"), last.column("text")],
            names=["part", "head", "doc_id", "text"],
        )


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        yield _edited(
            block.column("doc_id").to_pylist(), block.column("text").to_pylist(), block.column("head").to_pylist(),
            vectors(block.column("text")), vectors(block.column("head")),
        )


def _range_of(rows: DataFrame, parts: int) -> Column:
    """The range of a row's id; ranges hold about equally many rows, null is in the first."""
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    borders = F.array(*[F.lit(b) for b in sorted(set(found or []))]).cast("array<bigint>")
    return F.coalesce(F.size(F.filter(borders, lambda b: b < F.col("doc_id"))), F.lit(0))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter of code points is
    replaced by the first as many of the next document's, and their likeness."""
    spark = pin_batches(docs.sparkSession)
    parts = shuffle_parts(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    ordered = (
        rows.withColumn("part", _range_of(rows, parts)).repartitionById(parts, "part")
        .sortWithinPartitions("doc_id", "text")
    )
    # One row per range.  Its borders are fixed numbers, so both readers of ``ordered``
    # see the same ranges, whether they share the exchange or not.
    edges = ordered.mapInArrow(_edges, "part int, head string, doc_id long, text string").repartition(parts, "part")
    order = edges.select("part")
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = order.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(whole)).alias("next"))
    heads = edges.select(F.col("part").alias("next"), "head")
    lasts = edges.select("part", "doc_id", "text").join(after, "part").join(heads, "next")
    return ordered.mapInArrow(_inside, EDITED).unionByName(
        lasts.select("doc_id", "text", "head").mapInArrow(_across, EDITED)
    )
