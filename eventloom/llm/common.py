"""What several operators share: text blocks, vectorised word and span hashes, sessions.

Text is handled as UTF-8 bytes.  A *block* is a run of whole texts of one task, at
most ``BLOCK_BYTES`` long unless a single text is longer, so that the arrays built
over it stay small whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
ARROW_ROWS = 1000

# The ASCII white space that separates words, as a regular expression class.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FOLD = np.frombuffer(FOLD, dtype=np.uint8)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def pin_batches(spark: SparkSession) -> SparkSession:
    """Bounds the rows of one Arrow batch, since texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_text(name: str = "doc_id") -> Column:
    """The id as decimal text; a missing id counts as empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_mod(n: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``: a fixed split that reruns repeat."""
    return F.crc32(id_text(name).cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BLOCK_BYTES):
    """Slices of the batches whose text column holds at most ``most`` bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = byte_lengths(batch.column(text))
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    # Workers are used again by later stages; what this one freed goes back first.
    pa.default_memory_pool().release_unused()


def byte_lengths(column: pa.Array) -> np.ndarray:
    return np.diff(offsets_of(column))


def offsets_of(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind)
    return raw[column.offset:column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes back to back, and where each text starts (one more for the end).

    The column must have no nulls.
    """
    offsets = offsets_of(column)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spaced(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one space after each, so that no word crosses texts."""
    n = len(starts) - 1
    out = np.full(len(data) + n, 32, dtype=np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(starts))
    out[at] = data
    return out, starts + np.arange(n + 1)


def fold(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a buffer."""
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(_SPACE[data], out=inside[1:-1].view(bool))
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = _BASE) -> None:
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, BLOCK_BYTES)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


def _letters(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64((0xD1B54A32D192ED03 + 2 * seed) & _MASK))


class SpanHash:
    """Hashes of any spans of a buffer in constant time each, from one prefix sum."""

    def __init__(self, seed: int = 0) -> None:
        self.letters = _letters(seed)
        self.powers = Powers(_BASE + 2 * seed)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        up, _ = self.powers.upto(len(data))
        sums = np.empty(len(data) + 1, dtype=np.uint64)
        sums[0] = 0
        terms = self.letters[data]
        terms *= up[:len(data)]
        np.cumsum(terms, out=sums[1:])
        return sums

    def raw(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = self.powers.upto(len(sums))
        return (sums[ends] - sums[starts]) * down[starts]

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(sums, starts, ends) + (ends - starts).astype(np.uint64))


def shingle_hashes(word_hash: np.ndarray, first: np.ndarray, count: np.ndarray, k: int):
    """Hashes of the runs of ``k`` words within each text, and their number per text.

    ``first`` and ``count`` give each text's words.  A text of fewer than ``k`` words
    has one run, its whole sequence; a text without words has none.
    """
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    total = int(n.sum())
    owner = np.repeat(np.arange(len(n)), n)
    start = first[owner] + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(count, k)[owner]
    h = np.zeros(total, dtype=np.uint64)
    for j in range(k):
        live = j < length
        step = h * np.uint64(0x9FB21C651E98DF25) + word_hash[np.where(live, start + j, 0)] if total else h
        h = np.where(live, mix(step), h)
    return h, n


def group_starts(rows: pa.Table | pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Which rows begin a group, in rows sorted by whole-number columns."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for name in by:
        values = rows.column(name).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut anew, so that no group stands in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            edge = pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
            if group_starts(edge, by)[1]:
                yield pa.concat_batches(held)
                held = []
        last = int(np.flatnonzero(group_starts(batch, by))[-1])
        if last:
            yield pa.concat_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)
    pa.default_memory_pool().release_unused()
