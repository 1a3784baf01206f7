"""LM scoring by subword lattice likelihood.

A word's lattice holds every segmentation into pieces of an existing vocabulary, and one
arc over the whole word if the training documents have it:

    P(word) = max(c - D, 0) / N + D * V / N * (sum over segmentations of its piece weights)

with c the word's training count, N all tokens, V the distinct words and D the absolute
discount n1 / (n1 + 2 n2).  The end of a text is a token of probability (documents / N),
so the whole is a distribution over texts.  Piece weights start from the vocabulary's
own scores (ranks, read as a Zipf law) and are re-estimated on the distinct training
words by expectation maximisation.  All recursions run in log space over the prefixes
of a word; the score without the whole-word arcs is reported beside the other.

1. One scan cuts the texts into words and keeps, per block of documents, the distinct
   words and each document's counts as indices into that list; both go to the shared
   folder.  Distinct words go to the owner of their hash with their training counts.
2. Owners add up the corpus counts.  The word list grows with the corpus and stays
   distributed; each round of expectation brings one number per piece to the driver,
   a bound set by the vocabulary.
3. Owners score every distinct word once and answer the blocks, where documents are
   summed up.

Defined results: null text is empty and has one token, the end; with no training
document all counts are 0, the weights stay the vocabulary's; characters that no
piece covers fall back to their bytes, of which the vocabulary has every one; repeated
rows count and are scored each; a missing id counts as empty text in the split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.bpe import pack, unpack
from eventloom.llm.common import FOLD, SpanHash, blocks, crc_mod, mix, pin_batches, shuffle_parts, text_of
from eventloom.session import stage_table

DICTIONARY_BYTES = 8 << 20
ROUNDS = 4
# Mass given to every piece besides its expected count.
PRIOR = 0.01
LOW, SMOOTH = -1e30, 0.1
MARK = "▁"
# Words are scored in batches of about so many characters.
BATCH_CHARS = 1 << 16
_SPACES = bytes(range(9, 14))


def read_pieces(path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pieces, their starting log weights, and the ids of the 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, rank, byte_ids = [], [], np.zeros(256, dtype=np.int64)
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = len(pieces)
            rank.append(math.inf)
        else:
            rank.append(-model.get_score(i))
        pieces.append(model.id_to_piece(i))
    rank = np.asarray(rank)
    rank[np.isinf(rank)] = rank[np.isfinite(rank)].max(initial=0) + 1
    weight = 1.0 / (2.0 + rank - rank.min())
    return pieces, np.log(weight / weight.sum()), byte_ids


_POINTS = SpanHash(5)
_STEP = np.uint64(_POINTS.powers.base)


def _point(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(1))


class Lattice:
    """Pieces by hash, and the recursions over batches of words of one length."""

    def __init__(self, pieces: list[str], byte_ids: np.ndarray) -> None:
        self.n, self.byte_ids = len(pieces), byte_ids
        plain = [(p, i) for i, p in enumerate(pieces) if i not in set(byte_ids.tolist())]
        self.longest = max(len(p) for p, _ in plain)
        hashes = np.array([self._hash(p) for p, _ in plain], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array([i for _, i in plain])[order]
        self.single = {p for p, _ in plain if len(p) == 1}

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for point in _point(np.array([ord(c) for c in piece], dtype=np.uint64)).tolist():
            h = (h * int(_STEP) + point) & ((1 << 64) - 1)
        return h

    def arcs(self, codes: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """For (start, end) the words whose characters there are a piece, and the piece."""
        points, out = _point(codes), {}
        for start in range(codes.shape[1]):
            h = np.zeros(len(codes), dtype=np.uint64)
            for end in range(start + 1, min(codes.shape[1], start + self.longest) + 1):
                h = h * _STEP + points[:, end - 1]
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                hit = np.flatnonzero(self.hashes[at] == h)
                if len(hit):
                    out[start, end] = hit, self.ids[at[hit]]
        return out

    def fallback(self, codes: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(word, place, byte pieces) of the characters that are no piece themselves."""
        known = {p for p in np.unique(codes).tolist() if chr(p) in self.single}
        rows, places = np.nonzero(~np.isin(codes, list(known)))
        return [
            (int(r), int(c), self.byte_ids[list(chr(codes[r, c]).encode("utf-8", "surrogatepass"))])
            for r, c in zip(rows, places)
        ]

    def forward(self, codes: np.ndarray, arcs, rare, weights: np.ndarray) -> np.ndarray:
        alpha = np.full((len(codes), codes.shape[1] + 1), LOW)
        alpha[:, 0] = 0.0
        by_place = _by_place(rare)
        for end in range(1, codes.shape[1] + 1):
            for start in range(max(0, end - self.longest), end):
                if (start, end) in arcs:
                    hit, ids = arcs[start, end]
                    alpha[hit, end] = np.logaddexp(alpha[hit, end], alpha[hit, start] + weights[ids])
            for row, ids in by_place.get(end - 1, ()):
                alpha[row, end] = np.logaddexp(alpha[row, end], alpha[row, end - 1] + weights[ids].sum())
        return alpha

    def expected(self, codes: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words, weighted by their counts."""
        arcs, rare = self.arcs(codes), self.fallback(codes)
        alpha = self.forward(codes, arcs, rare, weights)
        beta = np.full(alpha.shape, LOW)
        beta[:, -1] = 0.0
        by_place, total, uses = _by_place(rare), alpha[:, -1], np.zeros(self.n)
        for start in range(codes.shape[1] - 1, -1, -1):
            for end in range(start + 1, min(codes.shape[1], start + self.longest) + 1):
                if (start, end) in arcs:
                    hit, ids = arcs[start, end]
                    tail = weights[ids] + beta[hit, end]
                    beta[hit, start] = np.logaddexp(beta[hit, start], tail)
                    share = np.exp(np.minimum(alpha[hit, start] + tail - total[hit], 0.0)) * counts[hit]
                    uses += np.bincount(ids, weights=share, minlength=self.n)
            for row, ids in by_place.get(start, ()):
                tail = weights[ids].sum() + beta[row, start + 1]
                beta[row, start] = np.logaddexp(beta[row, start], tail)
                np.add.at(uses, ids, math.exp(min(alpha[row, start] + tail - total[row], 0.0)) * counts[row])
        return uses

    def log10(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        alpha = self.forward(codes, self.arcs(codes), self.fallback(codes), weights)
        return alpha[:, -1] / math.log(10)


def _by_place(rare) -> dict[int, list]:
    out: dict[int, list] = {}
    for row, place, ids in rare:
        out.setdefault(place, []).append((row, ids))
    return out


def by_length(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words as code points with the mark before them, batched by their length."""
    marked = [(MARK + t.decode("utf-8", "surrogatepass")).encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked)) // 4
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
        width = int(size[group[0]])
        step = max(1, BATCH_CHARS // width)
        for i in range(0, len(group), step):
            at = group[i:i + step]
            yield at, np.frombuffer(b"".join(marked[j] for j in at), dtype="<u4").reshape(-1, width)


@lru_cache(maxsize=1)
def _lattice(pieces: tuple, byte_ids: tuple) -> Lattice:
    return Lattice(list(pieces), np.array(byte_ids))


CUT = "key long, block long, owner int, words binary, bytes binary, train binary, docs array<bigint>, sizes binary, at binary, times binary, place binary"
_CUT = pa.schema([
    ("key", pa.int64()), ("block", pa.int64()), ("owner", pa.int32()), ("words", pa.binary()), ("bytes", pa.binary()),
    ("train", pa.binary()), ("docs", pa.list_(pa.int64())), ("sizes", pa.binary()), ("at", pa.binary()),
    ("times", pa.binary()), ("place", pa.binary()),
])


def pack_words(found: list[bytes]) -> tuple[bytes, bytes]:
    raw = b"".join(found)
    sizes = pack(np.fromiter(map(len, found), dtype=np.uint32, count=len(found)))
    return sizes, len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack_words(sizes: bytes, blob: bytes) -> list[bytes]:
    size = unpack(sizes).astype(np.int64)
    length = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], length, "zstd", asbytes=True) if length else b""
    ends = np.cumsum(size)
    return [raw[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]


def _cut_block(block: int, ids, held, texts: list[list[bytes]], owners: int) -> pa.RecordBatch:
    local: dict[bytes, int] = {}
    docs = [np.fromiter((local.setdefault(w, len(local)) for w in found), dtype=np.int64, count=len(found)) for found in texts]
    train = np.zeros(len(local), dtype=np.int64)
    sizes, at, times = [], [], []
    for doc, out in zip(docs, held):
        which, n = np.unique(doc, return_counts=True)
        sizes.append(len(which))
        at.append(which)
        times.append(n)
        if not out:
            train[which] += n
    found = list(local)
    owner = np.fromiter((crc32(w) % owners for w in found), dtype=np.int64, count=len(found))
    place = np.argsort(owner, kind="stable")
    join = lambda parts: pack(np.concatenate(parts)) if parts else pack(np.zeros(0))
    rows = [(block, block, None, None, None, None, ids, pack(np.asarray(sizes)), join(at), join(times), pack(place))]
    for mine in np.split(place, np.flatnonzero(np.diff(owner[place])) + 1) if len(place) else ():
        o = int(owner[mine[0]])
        rows.append((o, block, o, *pack_words([found[i] for i in mine]), pack(train[mine]), None, None, None, None, None))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CUT)], schema=_CUT)


def _cutter(owners: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (TaskContext.get().partitionId() + 1) << 24
        ids, held, texts, size = [], [], [], 0
        for part in blocks(batches):
            ids += part.column("doc_id").to_pylist()
            held += part.column("held_out").to_pylist()
            for text in part.column("text"):
                raw = text.as_buffer().to_pybytes().translate(FOLD)
                texts.append(raw.split())
                size += len(raw)
            if size >= DICTIONARY_BYTES:
                yield _cut_block(block, ids, held, texts, owners)
                ids, held, texts, size, block = [], [], [], 0, block + 1
        if ids:
            yield _cut_block(block, ids, held, texts, owners)

    return cut


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """An owner's words with their training counts."""
    counts: dict[bytes, int] = {}
    for row in rows.itertuples():
        for word, n in zip(unpack_words(row.words, row.bytes), unpack(row.train).tolist()):
            counts[word] = counts.get(word, 0) + n
    values = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    return pd.DataFrame([(
        int(rows["owner"].iloc[0]), *pack_words(list(counts)), values.astype("<i8").tobytes(), int(values.sum()),
        *(int((values >= 1).sum()), int((values == 1).sum()), int((values == 2).sum())),
    )], columns=["owner", "words", "bytes", "counts", "total", "seen", "once", "twice"])


LEXICON = "owner int, words binary, bytes binary, counts binary, total long, seen long, once long, twice long"


def _expectation(model, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, uses = _lattice(*model.value), None
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i8")
                found = unpack_words(row["words"], row["bytes"])
                live = np.flatnonzero(counts)
                for _, codes in by_length([found[i] for i in live]):
                    part = lattice.expected(codes, np.ones(len(codes)), weights)
                    uses = part if uses is None else uses + part
        if uses is not None:
            at = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(uses[at])], names=["piece", "uses"])

    return run


def _scores(model, weights: np.ndarray, discount: float, backoff: float, total: int):
    """An owner scores each of its words once and answers every block."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lattice = _lattice(*model.value)
        asked = [unpack_words(r.words, r.bytes) for r in rows.itertuples()]
        known = {w: i for i, w in enumerate(dict.fromkeys(w for words in asked for w in words))}
        counts, pieces = np.zeros(len(known), dtype=np.int64), np.zeros(len(known))
        for row, words in zip(rows.itertuples(), asked):
            at = np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words))
            counts[at] += unpack(row.train).astype(np.int64)
        for at, codes in by_length(list(known)):
            pieces[at] = lattice.log10(codes, weights)
        whole = np.log10(np.maximum(np.maximum(counts - discount, 0) / max(total, 1), 1e-300))
        score = np.logaddexp(whole * math.log(10), (pieces + math.log10(backoff)) * math.log(10)) / math.log(10)
        out = []
        for row, words in zip(rows.itertuples(), asked):
            at = np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words))
            out.append((row.block, row.owner, counts[at].astype("<i8").tobytes(), score[at].astype("<f8").tobytes(),
                        pieces[at].astype("<f4").tobytes()))
        return pd.DataFrame(out, columns=["block", "owner", "counts", "scores", "pieces"])

    return run


SUMS = "doc_id long, n_words long, known_words long, base_sum double, lattice_sum double, piece_sum double"


def _sum_up(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    out = []
    answers = answers.sort_values("owner")
    for row in rows.itertuples():
        place = unpack(row.place)
        counts, scores, pieces = np.zeros(len(place)), np.zeros(len(place)), np.zeros(len(place))
        counts[place] = np.frombuffer(b"".join(answers["counts"]), "<i8")
        scores[place] = np.frombuffer(b"".join(answers["scores"]), "<f8")
        pieces[place] = np.frombuffer(b"".join(answers["pieces"]), "<f4")
        at, times, sizes = unpack(row.at), unpack(row.times).astype(float), unpack(row.sizes).astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        total = lambda values: np.bincount(doc, weights=values * times, minlength=len(sizes))
        out.append(pd.DataFrame({
            "doc_id": pd.Series(list(row.docs), dtype="Int64"), "n_words": total(np.ones(len(at))).astype(np.int64),
            "known_words": total((counts[at] > 0).astype(float)).astype(np.int64),
            "base_sum": total(np.log10(counts[at] + SMOOTH)), "lattice_sum": total(scores[at]),
            "piece_sum": total(pieces[at]),
        }))
    names = [f.split()[0] for f in SUMS.split(", ")]
    return pd.concat(out)[names] if out else pd.DataFrame(columns=names)


def lattice_scores(docs: DataFrame, model_path: str, folds: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """Per row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents of the held-out fold take no part in any count.
    """
    spark = pin_batches(docs.sparkSession)
    owners = shuffle_parts(spark)
    held = crc_mod(folds) == 0
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), text_of().alias("text"))
    cut = stage_table(docs.mapInArrow(_cutter(owners), CUT), "lm-cut")
    asked = cut.filter("owner is not null").select("block", "owner", "words", "bytes", "train")
    lexicon = stage_table(asked.groupBy("owner").applyInPandas(_add_up, LEXICON), "lm-lexicon")
    ends = docs.filter(~F.col("held_out")).count()
    total, seen, once, twice = (x or 0 for x in lexicon.agg(*[F.sum(c) for c in ("total", "seen", "once", "twice")]).first())
    discount = once / (once + 2 * twice) if once else SMOOTH
    total, kinds = total + ends, seen + (ends > 0)

    pieces, weights, byte_ids = read_pieces(model_path)
    model = spark.sparkContext.broadcast((tuple(pieces), tuple(byte_ids.tolist())))
    for _ in range(rounds if seen else 0):
        rows = lexicon.filter("seen > 0").select("words", "bytes", "counts").mapInArrow(
            _expectation(model, weights), "piece long, uses double"
        ).groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # at most one row per piece
        uses = np.full(len(pieces), PRIOR)
        for row in rows:
            uses[row["piece"]] += row["uses"]
        weights = np.log(uses / uses.sum())
    # Without training words every word is left to its pieces, and half the tokens end a text.
    end, backoff = (ends / total, discount * seen / total) if seen else (0.5, 0.5)

    answers = asked.groupBy("owner").applyInPandas(
        _scores(model, weights, discount, backoff, total),
        "block long, owner int, counts binary, scores binary, pieces binary",
    )
    positions = cut.filter("owner is null").select("block", "docs", "sizes", "at", "times", "place")
    sums = positions.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_sum_up, SUMS)
    norm = math.log10(total + SMOOTH * (kinds + 1))
    return sums.select(
        "doc_id", (crc_mod(folds) == 0).alias("held_out"), (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known_words") + int(ends > 0)).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base_sum") + math.log10(ends + SMOOTH) - (F.col("n_words") + 1) * norm).alias("base_score"),
        (F.col("lattice_sum") + math.log10(end)).alias("score"),
        (F.col("piece_sum") + math.log10(end)).alias("piece_score"),
    )
