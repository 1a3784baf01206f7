"""Removal of repeated byte strings by prefix-free parsing, distributed.

Every ``SPAN``-byte string that starts a second time is found, exactly and across the
whole corpus, without a row per byte.

1. *Parse.*  A position is a trigger if its rolling hash of ``GRAM`` bytes is the
   smallest of some ``SPAN - GRAM + 1`` neighbouring ones, which ends a phrase.  Unlike
   a hash modulo p this bounds every phrase, so each ``SPAN``-byte string holds a
   trigger, and equal strings hold it at the same place.  A string *belongs* to the
   trigger with the smallest hash in it; a trigger's strings start at consecutive bytes.
2. *Dictionary.*  Grams are exchanged by hash, one compressed message per sender and
   owner; a gram repeated inside a sender is sent once and its places are known there,
   so that a frequent passage costs one entry per sender.  Only triggers whose gram
   occurs again, a small part of a corpus, go on.
3. *Corpus order.*  Phrases with a repeated gram, each with the bytes its strings
   cover, meet by gram.  Their suffixes are sorted by their first ``SPAN`` bytes (as
   hashes of two bases, since only the runs of equal ones matter), then by document
   and start.  All of a run but its first place is repeated.
4. Spans are put together per document.

A phrase that stands in one batch with the same bytes several times goes on once; the
later places are repeated for certain.

Not done by the name: no suffix array of the whole dictionary and parse is merged into
corpus order.  It would move the suffix of every phrase, about the corpus again per
sorting round, to order suffixes that occur once; here only those with a repeated gram
are ordered, as far as ``SPAN`` bytes.

Defined results: null text is empty; a text shorter than ``SPAN`` keeps all; a null id
counts as the smallest.  Rows with the same ``doc_id`` and text stand at the same place,
so that they get the same spans and neither repeats the other; several texts of one id,
or without one, are documents in the order of their digests.  Matches never cross texts,
which are read whole.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.bpe import pack, spans, unpack
from eventloom.llm.common import SpanHash, blocks, bytes_of, group_starts, mix, pin_batches, shuffle_parts, text_of, whole_groups
from eventloom.session import stage_table

SPAN, GRAM = 100, 32
RUN = SPAN - GRAM + 1
# Text bytes whose triggers make up one message per owner.
SENDER_BYTES = 16 << 20
# Strings of one gram that are sorted at a time.
STRINGS = 1 << 20
HASH_BITS = 48
NO_ID = -(1 << 63)
_GRAMS, _ONE, _TWO = SpanHash(11), SpanHash(12), SpanHash(13)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def triggers(data: np.ndarray, starts: np.ndarray):
    """Per trigger: gram hash, text, its place, first string's place, number of strings.

    ``starts`` has one entry more than texts; places count from the text's start.
    """
    if len(data) < SPAN:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
    sums = _GRAMS.prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = _GRAMS.spans(sums, at, at + GRAM)
    # Ties go to the first place, which depends on the string alone.
    bits = np.uint64(int(len(grams)).bit_length())
    least = _sliding_least((grams >> bits << bits) | at.astype(np.uint64), RUN)
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    string = np.arange(len(place))
    text = np.searchsorted(starts, string, side="right") - 1
    inside = string + SPAN <= starts[text + 1]
    string, place, text = string[inside], place[inside], text[inside]
    first = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    n = np.diff(first, append=len(string))
    base = starts[text[first]]
    hashes = grams[place[first]] >> np.uint64(64 - HASH_BITS)
    return hashes, text[first], place[first] - base, string[first] - base, n


def pack_wide(values: np.ndarray) -> bytes:
    """Whole numbers, best in order, as compressed byte planes of their differences."""
    values = np.asarray(values, dtype="<i8")
    steps = np.diff(values, prepend=np.zeros(1, dtype="<i8")).view("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack_wide(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], 8 * n, "zstd", asbytes=True) if n else b""
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(8, n).T
    return np.cumsum(np.ascontiguousarray(planes).view("<i8").ravel())


MESSAGE = "owner int, docs binary, grams binary, doc binary, place binary, first binary, n binary, known binary, sure boolean"
_MESSAGE = pa.schema([
    ("owner", pa.int32()), ("docs", pa.binary()), ("grams", pa.binary()), ("doc", pa.binary()), ("place", pa.binary()),
    ("first", pa.binary()), ("n", pa.binary()), ("known", pa.binary()), ("sure", pa.bool_()),
])


def _dealt(grams: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the grams owner by owner, in their order, and where each owner's start."""
    owner = (grams % np.uint64(owners)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return order, np.append(0, np.cumsum(np.bincount(owner, minlength=owners)))


def _messages(ids: np.ndarray, parts: list[tuple], owners: int, sender: int) -> pa.RecordBatch | None:
    grams, doc, place, first, n = (np.concatenate(c) for c in zip(*parts))
    ranked, rank = np.unique(ids, return_inverse=True)
    doc = rank[doc]
    order = np.argsort(grams, kind="stable")
    grams, doc, place, first, n = (v[order] for v in (grams, doc, place, first, n))
    new = np.ones(len(grams), dtype=bool)
    new[1:] = grams[1:] != grams[:-1]
    run = np.cumsum(new) - 1
    alone = (np.bincount(run) == 1)[run] if len(run) else new

    def row(owner: int, at: np.ndarray, known: np.ndarray, sure: bool) -> tuple:
        # Only the documents of this message, since there is one for every owner.
        own, its = np.unique(doc[at], return_inverse=True)
        return (owner, pack_wide(ranked[own]), pack_wide(grams[at].astype(np.int64)), pack(its), pack(place[at]),
                pack(place[at] - first[at]), pack(n[at]), pack_wide(known.astype(np.int64)), sure)

    rows = []
    asked, repeated = np.flatnonzero(alone), np.unique(grams[~alone])
    (asks, starts), (knows, begins) = _dealt(grams[asked], owners), _dealt(repeated, owners)
    for o in np.flatnonzero(np.diff(starts) + np.diff(begins)).tolist():
        rows.append(row(o, asked[asks[starts[o]:starts[o + 1]]], repeated[knows[begins[o]:begins[o + 1]]], False))
    if not alone.all():
        # Repeated here, so no owner needs to be asked.
        rows.append(row(sender % owners, np.flatnonzero(~alone), repeated[:0], True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MESSAGE)], schema=_MESSAGE) if rows else None


def _sender(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, parts, count, size = [], [], 0, 0
        for block in blocks(batches):
            data, starts = bytes_of(block.column("text"))
            grams, doc, place, first, n = triggers(data, starts)
            ids.append(block.column("id").to_numpy())
            parts.append((grams, doc + count, place, first, n))
            count, size = count + block.num_rows, size + len(data)
            if size >= SENDER_BYTES:
                found = _messages(np.concatenate(ids), parts, owners, part)
                ids, parts, count, size = [], [], 0, 0
                if found is not None:
                    yield found
        if ids:
            found = _messages(np.concatenate(ids), parts, owners, part)
            if found is not None:
                yield found

    return send


TRIGGER = "id long, place int, before int, n int"


def _again(sent: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the sent grams were sent twice or are known to be repeated; one sort for all."""
    both = np.concatenate([sent, known])
    order = np.argsort(both, kind="stable")
    ordered = both[order]
    new = np.ones(len(both), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    again = np.diff(start, append=len(both)) > 1
    again[run[order >= len(sent)]] = True
    out = np.empty(len(both), dtype=bool)
    out[order] = again[run]
    return out[:len(sent)]


def _repeated(messages: pd.DataFrame) -> pd.DataFrame:
    """The triggers of an owner's grams that occur more than once."""
    none = np.zeros(0, dtype=np.int64)
    sure = messages["sure"].to_numpy(dtype=bool)
    grams = [unpack_wide(b) for b in messages["grams"]]
    sent = np.concatenate([none, *(g for g, s in zip(grams, sure) if not s)])
    known = np.concatenate([none, *(unpack_wide(b) for b in messages["known"])])
    asked = np.repeat(~sure, [len(g) for g in grams])
    again = np.ones(len(asked), dtype=bool)
    again[asked] = _again(sent, known)
    id_ = np.concatenate([none, *(unpack_wide(d)[unpack(b)] for d, b in zip(messages["docs"], messages["doc"]))])
    found = {"id": id_[again]}
    for name, column in (("place", "place"), ("before", "first"), ("n", "n")):
        found[name] = np.concatenate([none, *(unpack(b) for b in messages[column])])[again].astype(np.int32)
    return pd.DataFrame(found)


PHRASE = "gram long, id long, first int, n int, covered binary"


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of the triggers with the bytes their strings cover.

    Of equal phrases in a block the first place goes on; the others go on without bytes.
    """
    for block in blocks(batches):
        ids = block.column("id").to_numpy()
        found = block.column("found")
        counts = found.value_lengths().to_numpy()
        flat = found.flatten()
        row = np.repeat(np.arange(len(ids)), counts)
        place, before, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        data, starts = bytes_of(block.column("text"))
        place, size = place - before, n + SPAN - 1
        # A doc_id may repeat with another text; what does not fit is no phrase of it.
        fits = place + size <= np.diff(starts)[row]
        row, place, before, n, size = (v[fits] for v in (row, place, before, n, size))
        begin = starts[row] + place
        sums, again = _ONE.prefix(data), _TWO.prefix(data)
        gram = _ONE.spans(sums, begin + before, begin + before + GRAM).view(np.int64)
        one, two = _ONE.spans(sums, begin, begin + size), _TWO.spans(again, begin, begin + size)
        order = np.lexsort((place, ids[row], two, one))
        o1, o2 = one[order], two[order]
        head = np.ones(len(order), dtype=bool)
        head[1:] = (o1[1:] != o1[:-1]) | (o2[1:] != o2[:-1])
        where = ids[row][order], place[order]
        lead = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else order
        same = (where[0] == where[0][lead]) & (where[1] == where[1][lead])
        send = np.zeros(len(order), dtype=bool)
        send[order] = same
        ends = np.cumsum(np.where(send, size, 0))
        covered = pa.Array.from_buffers(
            pa.binary(), len(row),
            [pa.py_buffer(np.packbits(send, bitorder="little").tobytes()),
             pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()),
             pa.py_buffer(data[spans(begin[send], size[send])].tobytes())],
        )
        # Places without bytes are settled, so they need not meet their gram.
        gram = np.where(send, gram, mix((ids[row] + place).astype(np.uint64)).view(np.int64))
        yield pa.RecordBatch.from_arrays([
            pa.array(gram), pa.array(ids[row]), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32)), covered,
        ], names=["gram", "id", "first", "n", "covered"])


def _string_keys(covered: pa.Array, n: np.ndarray) -> np.ndarray:
    """A hash of every string of the phrases, one after the other."""
    keys = [np.zeros(0, dtype=np.uint64)]
    rows = pa.RecordBatch.from_arrays([covered, pa.array(n)], names=["covered", "n"])
    for block in blocks(iter([rows]), "covered"):
        data, starts = bytes_of(block.column("covered"))
        string = spans(starts[:-1], block.column("n").to_numpy())
        one = _ONE.spans(_ONE.prefix(data), string, string + SPAN)
        two = _TWO.spans(_TWO.prefix(data), string, string + SPAN)
        keys.append(one ^ (two << np.uint64(1) | two >> np.uint64(63)))
    return np.concatenate(keys)


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (id, start, stop) of the strings that are not the first of their run.

    Equal strings have equal hashes, so that a gram with very many strings is sorted in
    parts, by hash; no more than ``STRINGS`` or so at a time.
    """
    for run in whole_groups(batches, ["gram"]):
        ids, first = run.column("id").to_numpy(), run.column("first").to_numpy().astype(np.int64)
        n = run.column("n").to_numpy().astype(np.int64)
        group = np.cumsum(group_starts(run, ["gram"])) - 1
        covered = run.column("covered")
        sent = covered.is_valid().to_numpy(zero_copy_only=False)
        # Phrases without bytes repeat an earlier place of their block.
        out = [(ids[~sent], first[~sent], first[~sent] + n[~sent] + SPAN - 1)]
        ids, first, n, group = ids[sent], first[sent], n[sent], group[sent]
        if len(ids):
            keys = _string_keys(covered.drop_null(), n)
            phrase = np.repeat(np.arange(len(ids), dtype=np.int32), n)
            shift = first - np.cumsum(n) + n
            parts = -(-len(keys) // STRINGS)
            repeated = np.zeros(len(keys), dtype=bool)
            for part in range(parts):
                at = np.flatnonzero(keys % np.uint64(parts) == part) if parts > 1 else np.arange(len(keys))
                key, of = keys[at], group[phrase[at]]
                place, doc = at + shift[phrase[at]], ids[phrase[at]]
                order = np.lexsort((place, doc, key, of))
                k, g = key[order], of[order]
                head = np.ones(len(order), dtype=bool)
                head[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
                lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(order) else order
                repeated[at[order]] = (doc[order] != doc[lead]) | (place[order] != place[lead])
            at = np.flatnonzero(repeated)
            if len(at):
                cut = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(phrase[at], prepend=-1) != 0))
                last = at[np.append(cut[1:], len(at)) - 1]
                begin, of = at[cut], phrase[at[cut]]
                out.append((ids[of], begin + shift[of], last + shift[of] + SPAN))
        id_, start, stop = (np.concatenate(c) for c in zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(id_), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["id", "start", "stop"]
        )


def _with_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``id, text`` with one ``id`` per document, ascending in their order, and the names
    of the ids, if they are not ``doc_id`` itself.

    Where one id, or no id, has several texts, these are numbered, in the order of id
    (null first) and text digest, by a distributed sort of ids and digests.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("string").alias("text")
    )
    named = rows.select("doc_id", F.sha2("text", 256).alias("digest"))
    several = named.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    if several.filter("low < high").isEmpty():
        # The same two columns in every use, so that the texts are shuffled once.
        return rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text"), None
    numbered = stage_table(
        named.distinct().orderBy(F.col("doc_id").asc_nulls_first(), "digest")
        .select("doc_id", "digest", F.monotonically_increasing_id().alias("id")),
        "repeats-ids",
    )
    keys = numbered.select("id", F.col("doc_id").alias("named"), F.col("digest").alias("its"))
    same = F.col("doc_id").eqNullSafe(F.col("named")) & (F.sha2("text", 256) == F.col("its"))
    return rows.join(keys, same).select("id", "text"), numbered.select("id", "doc_id")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``id, spans``: per document with repeated strings its spans (start, stop), unmerged."""
    spark = pin_batches(texts.sparkSession)
    owners = shuffle_parts(spark)
    found = (
        texts.mapInArrow(_sender(owners), MESSAGE).groupBy("owner").applyInPandas(_repeated, TRIGGER)
        .groupBy("id").agg(F.collect_list(F.struct("place", "before", "n")).alias("found"))
    )
    phrases = texts.join(found, "id").select("id", "text", "found").mapInArrow(_phrases, PHRASE)
    runs = phrases.repartition(owners, "gram").sortWithinPartitions("gram").mapInArrow(
        _sorted_runs, "id long, start int, stop int"
    )
    return runs.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    order = np.argsort(starts, kind="stable")
    for a, b in zip(starts[order].tolist(), stops[order].tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


KEPT = "id long, n_bytes long, removed array<struct<start:int,stop:int>>, kept binary"


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, removed, kept``: every row's removed runs and remaining bytes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for block in blocks(batches):
            ids, sizes, removed, kept = [], [], [], []
            for id_, text, found in zip(block.column("id").to_pylist(), block.column("text"), block.column("spans")):
                raw = text.as_buffer().to_pybytes()
                gone = []
                if found.is_valid:
                    flat = found.values
                    a, b = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    inside = b <= len(raw)
                    gone = merged(a[inside], b[inside])
                edges = [0, *(x for run in gone for x in run), len(raw)]
                ids.append(id_)
                sizes.append(len(raw))
                removed.append([{"start": a, "stop": b} for a, b in gone])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, runs), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "removed", "kept"],
            )

    texts, names = _with_ids(docs)
    done = texts.join(repeated_spans(texts), "id", "left").select("id", "text", "spans").mapInArrow(cut, KEPT)
    if names is None:
        return done.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), *done.columns[1:])
    return done.join(names, "id").select("doc_id", *done.columns[1:])


def repeat_digest(cut: DataFrame) -> DataFrame:
    """Per row the number of bytes, of removed bytes and runs, and a digest of the rest."""
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
