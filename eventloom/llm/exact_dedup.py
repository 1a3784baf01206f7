"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every scan task (a *sender*) folds A-Z, digests each text, sorts the distinct
   fingerprints (the first 48 bits of the digest) and cuts them by range into one
   Golomb-Rice coded message per *owner*.  A copy inside the sender adds nothing to
   a message, so a group of copies costs one code per sender however large it is.
2. Owners decode and merge the messages of their range and answer each sender with
   one bit per code: does another sender hold it as well?
3. Senders unfold their rows.  Only the texts of the suspects (repeated inside a
   sender, or flagged) are moved: their folded bytes are grouped, and the bytes decide
   which texts are equal.  Copies inside a task are one row before that shuffle, so a
   group of copies sends its text once per task.  A chance equality of fingerprints is
   thrown out there, and so would be one of digests: rows learn their group by digest
   and length where these name one text, and by the bytes where they do not.

Senders keep no texts.  Those of the suspects come from a second scan, which tells
them by a hash that Spark computes of the text as it stands; what else has the same
hash moves along and joins no group.  Beyond Spark's broadcast threshold (some million
suspects by default) that scan meets the hashes in a shuffle, which moves all texts once.

Senders' tables are written to the shared folder first, so that the answers refer to
the same senders even if an executor is lost.

Defined results: null text is empty text.  Of equal texts the largest ``doc_id``
stays; a group whose ids are all null keeps those rows.  Rows repeating a ``doc_id``
and text all count in ``group_size`` and share one decision.  Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import FOLD, pin_batches, shuffle_parts, text_of
from eventloom.session import stage_table

FINGERPRINT_BITS = 48
# A sender is cut after so many rows, which bounds its memory to about 40 MB.
SENDER_ROWS = 300_000

POSTINGS = (
    "sender long, owner int, codes int, rice int, code binary, runs binary,"
    " ids array<bigint>, digests binary, sizes binary, marks binary"
)
MOVED = "doc_id long, digest binary, n_bytes long, bytes binary"


def sha256(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()


def rice_encode(gaps: np.ndarray, k: int) -> bytes:
    """Golomb-Rice code: all k-bit remainders, then all quotients in unary."""
    low = (gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    return np.packbits(np.concatenate([low.astype(np.uint8).ravel(), unary])).tobytes()


def rice_decode(code: bytes, n: int, k: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    low = bits[:n * k].reshape(n, k).astype(np.uint64)
    remainder = (low << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    ones = np.flatnonzero(bits[n * k:])[:n]
    quotients = np.diff(ones, prepend=-1) - 1
    return (quotients.astype(np.uint64) << np.uint64(k)) + remainder


def owner_of(fingerprints: np.ndarray, owners: int) -> np.ndarray:
    width = -(-(1 << FINGERPRINT_BITS) // owners)
    return (fingerprints // np.uint64(width)).astype(np.int64)


def _messages(
    sender: int, ids: list, digests: list[bytes], sizes: list[int], marks: list[int], owners: int
) -> pa.RecordBatch:
    prints = np.frombuffer(b"".join(d[:8] for d in digests), dtype=">u8").astype(np.uint64)
    prints >>= np.uint64(64 - FINGERPRINT_BITS)
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    first = np.flatnonzero(np.diff(prints, prepend=prints[0] + np.uint64(1)))
    runs = np.diff(first, append=len(prints)).astype("<i4")
    distinct = prints[first]
    owner = owner_of(distinct, owners)
    cuts = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
    width = -(-(1 << FINGERPRINT_BITS) // owners)
    sizes, marks = np.asarray(sizes, dtype="<i8"), np.asarray(marks, dtype="<i8")
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        base = np.uint64(int(owner[a]) * width)
        gaps = np.diff(distinct[a:b], prepend=base)
        rice = max(0, int(width // (b - a)).bit_length() - 1)
        held = order[first[a]:first[b] if b < len(first) else len(order)]
        rows.append((
            sender, int(owner[a]), int(b - a), rice, rice_encode(gaps, rice), runs[a:b].tobytes(),
            [ids[i] for i in held], b"".join(digests[i] for i in held), sizes[held].tobytes(),
            marks[held].tobytes(),
        ))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), _POSTINGS_ARROW.types)], schema=_POSTINGS_ARROW
    )


_POSTINGS_ARROW = pa.schema([
    ("sender", pa.int64()), ("owner", pa.int32()), ("codes", pa.int32()), ("rice", pa.int32()),
    ("code", pa.binary()), ("runs", pa.binary()), ("ids", pa.list_(pa.int64())), ("digests", pa.binary()),
    ("sizes", pa.binary()), ("marks", pa.binary()),
])


def _sender(owners: int, digest: Callable[[bytes], bytes]):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        cut, ids, digests, sizes, marks = 0, [], [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            for text in batch.column(1):
                raw = text.as_buffer().to_pybytes().translate(FOLD)
                digests.append(digest(raw))
                sizes.append(len(raw))
            marks += batch.column(2).to_pylist()
            if len(ids) >= SENDER_ROWS:
                yield _messages(part << 20 | cut, ids, digests, sizes, marks, owners)
                cut, ids, digests, sizes, marks = cut + 1, [], [], [], []
        if ids:
            yield _messages(part << 20 | cut, ids, digests, sizes, marks, owners)

    return send


def _answer(owners: int):
    width = -(-(1 << FINGERPRINT_BITS) // owners)

    def answer(messages: pd.DataFrame) -> pd.DataFrame:
        codes = [
            np.cumsum(rice_decode(m.code, m.codes, m.rice)) + np.uint64(m.owner * width)
            for m in messages.itertuples()
        ]
        merged = np.sort(np.concatenate(codes))
        shared = np.unique(merged[1:][merged[1:] == merged[:-1]])
        bits = [np.packbits(np.isin(c, shared, assume_unique=True)).tobytes() for c in codes]
        return pd.DataFrame({"sender": messages["sender"], "owner": messages["owner"], "bits": bits})

    return answer


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            runs = np.frombuffer(row["runs"], dtype="<i4")
            flagged = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8))[:len(runs)].astype(bool)
            suspect = np.repeat(flagged | (runs > 1), runs)
            digests = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(32), len(suspect), [None, pa.py_buffer(row["digests"])]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()), digests.cast(pa.binary()),
                    pa.array(np.frombuffer(row["sizes"], dtype="<i8")),
                    pa.array(np.frombuffer(row["marks"], dtype="<i8")), pa.array(suspect),
                ],
                names=["doc_id", "digest", "n_bytes", "mark", "suspect"],
            )


def _mover(digest: Callable[[bytes], bytes]):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [text.as_buffer().to_pybytes().translate(FOLD) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([digest(raw) for raw in raws], pa.binary()),
                    pa.array([len(raw) for raw in raws], pa.int64()), pa.array(raws, pa.binary()),
                ],
                names=["doc_id", "digest", "n_bytes", "bytes"],
            )

    return move


def dedup_decisions(
    docs: DataFrame, owners: int | None = None, digest: Callable[[bytes], bytes] = sha256
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    ``owners`` is the number of fingerprint ranges; it defaults to the session's
    shuffle partitions, the number its user has fitted to the data.  ``digest`` (32
    bytes) is what fingerprints are cut from and ``text_sha256`` shows; groups are of
    equal bytes whatever it is.
    """
    spark = pin_batches(docs.sparkSession)
    owners = owners or shuffle_parts(spark)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("mark")
    )
    postings = stage_table(
        rows.mapInArrow(_sender(owners, digest), POSTINGS),
        "dedup-postings",
    )
    bits = (
        postings.select("sender", "owner", "codes", "rice", "code").groupBy("owner")
        .applyInPandas(_answer(owners), "sender long, owner int, bits binary")
    )
    held = stage_table(
        postings.select("sender", "owner", "runs", "ids", "digests", "sizes", "marks")
        .join(bits, ["sender", "owner"])
        .mapInArrow(_unfold, "doc_id long, digest binary, n_bytes long, mark long, suspect boolean"),
        "dedup-rows",
    )
    suspects = held.filter("suspect").drop("suspect")
    # Written, so that their size is known: as few as they mostly are, the texts meet them in place.
    marks = stage_table(suspects.select("mark").distinct(), "dedup-marks")
    moved = (
        rows.join(marks, "mark", "left_semi").select("doc_id", "text")
        .mapInArrow(_mover(digest), MOVED)
    )
    # Written, so that the join below reads two plain exchanges and a hot group is split.
    texts = stage_table(
        moved.groupBy("digest", "n_bytes", "bytes").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "dedup-groups",
    )
    named, decided = ["digest", "n_bytes"], ["doc_id", "digest", "keep_id", "group_size"]
    alone = held.filter(~F.col("suspect")).select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size")
    )
    clashes = stage_table(texts.groupBy(*named).count().filter("count > 1").select(*named), "dedup-clashes")
    if clashes.isEmpty():
        grouped = suspects.join(texts.drop("bytes"), named).select(*decided)
    else:
        plain = texts.drop("bytes").join(clashes, named, "left_anti")
        told = moved.join(clashes, named, "left_semi").join(texts, [*named, "bytes"])
        grouped = suspects.join(plain, named).select(*decided).unionByName(told.select(*decided))
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """``docs`` without the rows that an equal text with a larger ``doc_id`` replaces.

    A row is known by ``doc_id`` and text, so that another text of the same id is not
    touched.  Rows that repeat both become one, also where the ids are null.
    """
    decisions = stage_table(dedup_decisions(docs, owners), "dedup-decisions")
    folded = F.sha2(F.translate(text_of(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)
    named = decisions.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "kept", "group_size")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__sha"))
    dropped = named.filter(~F.col("kept")).select("__id", "__sha").distinct()
    kept = docs.withColumn("__digest", folded).join(dropped, same, "left_anti")
    again = (
        named.filter(F.col("kept") & (F.col("group_size") > 1))
        .groupBy("__id", "__sha").count().filter("count > 1").select("__id", "__sha")
    )
    if again.isEmpty():
        return kept.select(docs.columns)
    # Only where rows repeat: one of each (doc_id, folded text) stays.
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "__digest"])
    return kept.join(again, same, "left_anti").unionByName(once).select(docs.columns)
