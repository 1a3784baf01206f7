"""Byte-level BPE through a global distinct-word shuffle.

1. A scan task cuts its texts into pre-tokens and keeps, per block of documents, the
   distinct pre-tokens and the positions at which they stand (indices into the block's
   list, the most frequent first, so that they compress well).
2. The distinct pre-tokens go to the owner of their hash.  An owner encodes each word
   once, whatever the number of blocks, and answers every block with the ids.  A word
   that fills a third of the corpus is sent once per block.
3. Positions and answers meet by block, and documents are put together by position.

Positions and words are in one exchange, which both later steps read, so that texts
are scanned and cut once and never shuffled themselves.  Decoding looks every id up in
the token-byte table, which is as large as the vocabulary and bounded by it.

Defined results: null and empty texts have no tokens; every row of the input gives
one row, repeated rows and ids included; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import blocks, pin_batches, shuffle_parts, text_of

# Text bytes of the documents whose words share one dictionary.
DICTIONARY_BYTES = 8 << 20
# Ids put together at a time.
CHUNK_IDS = 1 << 18


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def _ranks(vocab: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in vocab.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=2)
def _encoder(vocab: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=_ranks(vocab), special_tokens={})


@lru_cache(maxsize=2)
def token_table(vocab: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token bytes back to back, and the start and length of each id."""
    ranks = _ranks(vocab)
    starts = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int64)
    sizes = np.zeros_like(starts)
    at = 0
    for token, rank in ranks.items():
        starts[rank], sizes[rank] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), dtype=np.uint8), starts, sizes


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of the spans back to back: start, start + 1, ... for each."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def pack(values: np.ndarray) -> bytes:
    """Small numbers as compressed byte planes, lowest first."""
    values = np.ascontiguousarray(values, dtype="<u4")
    planes = values.view(np.uint8).reshape(-1, 4).T
    used = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(planes[:used]).tobytes()
    return bytes([used]) + len(values).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    used, n = blob[0], int.from_bytes(blob[1:5], "little")
    raw = pa.decompress(blob[5:], used * n, "zstd", asbytes=True) if n else b""
    planes = np.zeros((4, n), dtype=np.uint8)
    planes[:used] = np.frombuffer(raw, dtype=np.uint8).reshape(used, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pattern_of(pattern: str) -> regex.Pattern:
    """The pre-token pattern, with white space as Unicode defines it."""
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


# A row is either words of one block for one owner (docs null) or a block's positions.
CUT = "key long, block long, owner int, words binary, bytes binary, docs array<bigint>, counts binary, at binary, place binary"
_CUT = pa.schema([
    ("key", pa.int64()), ("block", pa.int64()), ("owner", pa.int32()), ("words", pa.binary()), ("bytes", pa.binary()),
    ("docs", pa.list_(pa.int64())), ("counts", pa.binary()), ("at", pa.binary()), ("place", pa.binary()),
])


def _cut_block(block: int, ids: list, found: list[np.ndarray], local: dict[str, int], owners: int) -> pa.RecordBatch:
    """``local`` numbers the block's words as met; here the most frequent become the first."""
    counts = [len(f) for f in found]
    met = np.concatenate(found)
    order = np.argsort(-np.bincount(met, minlength=len(local)), kind="stable")
    rank = np.empty(len(order), dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    at = rank[met]
    names = list(local)
    encoded = [names[i].encode() for i in order]
    owner = np.fromiter((crc32(w) % owners for w in encoded), dtype=np.int64, count=len(encoded))
    place = np.argsort(owner, kind="stable")
    rows = [(block, block, None, None, None, ids, pack(np.asarray(counts)), pack(at), pack(place))]
    for o in np.unique(owner):
        mine = [encoded[i] for i in place[np.searchsorted(owner, o, sorter=place):np.searchsorted(owner, o, "right", sorter=place)]]
        raw = b"".join(mine)
        sizes = pack(np.fromiter(map(len, mine), dtype=np.uint32, count=len(mine)))
        rows.append((int(o), block, int(o), sizes, len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True),
                     None, None, None, None))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CUT)], schema=_CUT)


def _cutter(pattern: str, owners: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = pattern_of(pattern).findall
        # Keys of blocks lie above those of owners.
        block = (TaskContext.get().partitionId() + 1) << 24
        ids, found, local, size = [], [], {}, 0
        for part in blocks(batches):
            texts = part.column("text")
            ids += part.column("doc_id").to_pylist()
            size += texts.nbytes
            for text in texts.to_pylist():
                found.append(np.array([local.setdefault(w, len(local)) for w in find(text)], dtype=np.uint32))
            if size >= DICTIONARY_BYTES:
                yield _cut_block(block, ids, found, local, owners)
                ids, found, local, size, block = [], [], {}, 0, block + 1
        if ids:
            yield _cut_block(block, ids, found, local, owners)

    return cut


def _read_words(row) -> list[bytes]:
    sizes = unpack(row.words).astype(np.int64)
    raw = pa.decompress(row.bytes[8:], int.from_bytes(row.bytes[:8], "little"), "zstd", asbytes=True) if len(sizes) else b""
    ends = np.cumsum(sizes)
    return [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


ANSWER = "block long, owner int, sizes binary, ids binary"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _owner(vocab, pattern: str):
    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["words"].notna()]
        out = []
        if len(rows):
            piece, known = _encoder(vocab.value, pattern)._encode_single_piece, {}
            for row in rows.itertuples():
                found = []
                for word in _read_words(row):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(piece(word), dtype="<u4").tobytes()
                    found.append(ids)
                sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
                out.append((row.block, row.owner, pack(sizes), pack(np.frombuffer(b"".join(found), dtype="<u4"))))
        return pd.DataFrame(out, columns=["block", "owner", "sizes", "ids"])

    return encode


def _assemble(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    rows = rows[rows["at"].notna()]
    out = {"doc_id": [], "ids": []}
    for row in rows.itertuples():
        answers = answers.sort_values("owner")
        sizes = np.concatenate([unpack(b) for b in answers["sizes"]] or [np.zeros(0, dtype="<u4")]).astype(np.int64)
        flat = np.concatenate([unpack(b) for b in answers["ids"]] or [np.zeros(0, dtype="<u4")])
        place = unpack(row.place)
        starts = np.zeros(len(place), dtype=np.int64)
        lengths = np.zeros(len(place), dtype=np.int64)
        starts[place], lengths[place] = np.cumsum(sizes) - sizes, sizes
        at, counts = unpack(row.at), unpack(row.counts).astype(np.int64)
        ends = np.cumsum(counts)
        for doc, a, b in zip(row.docs, ends - counts, ends):
            mine = at[a:b]
            out["doc_id"].append(doc)
            out["ids"].append(flat[spans(starts[mine], lengths[mine])].astype(np.int32))
    return pd.DataFrame({"doc_id": pd.Series(out["doc_id"], dtype="Int64"), "ids": pd.Series(out["ids"], dtype=object)})


def _encoded(docs: DataFrame, vocab_path: str, pattern: str, owners: int | None):
    """Blocks of documents, the ids of their words, and the vocabulary."""
    spark: SparkSession = pin_batches(docs.sparkSession)
    owners = owners or shuffle_parts(spark)
    vocab = spark.sparkContext.broadcast(vocabulary(vocab_path))
    cut = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
        .mapInArrow(_cutter(pattern, owners), CUT).repartition(owners, "key")
    )
    return cut, cut.groupBy("key").applyInPandas(_owner(vocab, pattern), ANSWER), vocab


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, owners: int | None = None) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs``, as the vocabulary's own library encodes."""
    cut, answers, _ = _encoded(docs, vocab_path, pattern, owners)
    return cut.groupBy("key").cogroup(answers.groupBy("block")).applyInPandas(_assemble, "doc_id long, ids array<int>")


def _digests(vocab):
    """Assembles a block's ids, decodes them again and keeps the digests, in one worker."""
    def finish(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        data, starts, sizes = token_table(vocab.value)
        whole = _assemble(rows, answers)
        ids_sha, decoded_sha = [], []
        for ids in whole["ids"]:
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            decoded = hashlib.sha256()
            for part in _chunks(ids):
                decoded.update(data[spans(starts[part], sizes[part])].tobytes())
            decoded_sha.append(decoded.hexdigest())
        return pd.DataFrame({
            "doc_id": whole["doc_id"], "n_tokens": whole["ids"].map(len).astype("int64"),
            "ids_sha256": pd.Series(ids_sha, dtype=object), "decoded_sha256": pd.Series(decoded_sha, dtype=object),
        })

    return finish


def encode_digest(docs: DataFrame, vocab_path: str, pattern: str, owners: int | None = None) -> DataFrame:
    """``decoded_digest`` of the encoded documents.

    Ids are assembled, decoded and digested by one Python worker a task, not by two that
    hand them on through the JVM.
    """
    cut, answers, vocab = _encoded(docs, vocab_path, pattern, owners)
    return cut.groupBy("key").cogroup(answers.groupBy("block")).applyInPandas(_digests(vocab), DIGEST)


def _decoder(vocab):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, sizes = token_table(vocab.value)
        for batch in batches:
            column = batch.column("ids")
            ids, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy())
            texts = [b"".join(
                data[spans(starts[part], sizes[part])].tobytes() for part in _chunks(ids[a:b])
            ) for a, b in zip(np.append(0, ends[:-1]), ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return decode


def decode_documents(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``."""
    vocab = encoded.sparkSession.sparkContext.broadcast(vocabulary(vocab_path))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decoder(vocab), f"{fields}, decoded binary")


def _chunks(ids: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, len(ids), CHUNK_IDS):
        yield ids[start:start + CHUNK_IDS]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("ids")
        sizes = column.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes) * 4
        raw = column.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sizes),
            pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends - sizes * 4, ends)], pa.string()),
            pa.array([hashlib.sha256(b.as_buffer()).hexdigest() for b in batch.column("decoded")], pa.string()),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def token_digest(decoded: DataFrame) -> DataFrame:
    """Per row the number of ids, and digests of the ids and of the decoded bytes."""
    return decoded.mapInArrow(_digest, DIGEST)


def decoded_digest(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``token_digest`` of the decoded documents, decoded and digested by one Python worker.

    No decoded text goes back to the JVM.
    """
    decode = _decoder(encoded.sparkSession.sparkContext.broadcast(vocabulary(vocab_path)))
    return encoded.select("doc_id", "ids").mapInArrow(lambda batches: _digest(decode(batches)), DIGEST)
