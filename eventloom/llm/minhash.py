"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature is ``HASHES`` symbols of 8 bits, each the low bits of the mixed minimum of
one hash function over the document's shingles.  Two documents of similarity J differ in
a symbol with probability 1 - J, so the distance bound ``T`` is set four standard
deviations above the mean at the link threshold: a pair right at the threshold is missed
with a chance of 3 in 100,000, one above it less often.  The signature is split into
``m`` chunks with ``2 * m > T``: by the pigeonhole principle two signatures within T
differ in at most one symbol of some chunk, so the chunk without one of its symbols,
for each symbol, is a key; *every* pair within T shares a key.  Keys carry 57-bit
hashes and their number; candidates are confirmed on full sets.

Copies and hot buckets.  Documents with equal sets are one class from the start.  A
bucket is never turned into all its pairs, and no more than its rows ever travels:

1. every member is paired with the bucket's smallest member only (linear);
2. in crowded buckets that still hold several components, every member is paired with
   the next one in an order by hash (linear), again while that closes half of them;
3. the members of buckets that are still open meet with their signatures, to tell which
   of them have a partner within T in another component.  A pair counts in the first of
   its shared keys only.  Out go members, not pairs;
4. those members meet again with their full sets.  Pairs are confirmed there and links
   that join nothing new are left out, so a group gives fewer links than members.

Pairs inside one component need no check, since they cannot change the components.  A
bucket of more than ``SLICE`` members, or whose sets are larger than ``SLICE_BYTES``, is
compared slice against slice, so that no task holds more than two slices.

Shingles are 64-bit hashes of words folded to lower case (A-Z).  Defined results: null
text is empty; a document without words has an empty set, links with nothing and is
kept; one with fewer than k words has one shingle; texts are read whole.  Rows are told
apart by ``doc_id`` and text: two texts of one id are two documents.  In the decisions a
row without an id links with nothing and is kept; the filter lets such rows link like any
other and prefers rows with an id.  Repeated rows become one.  An empty table gives no
rows; other columns are untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import (
    SpanHash, blocks, bytes_of, fold, group_starts, mix, pin_batches, shingle_hashes, spaced, text_of, whole_groups, words,
)
from eventloom.llm.components import components
from eventloom.session import stage_table

HASHES = 128
SLICE, SLICE_BYTES = 4096, 1 << 24
# Buckets of this size or more are thinned by neighbours before they are compared.
CROWD = 32
_HASH = SpanHash()
_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(1001, 1001 + HASHES, dtype=np.uint64))


def distance_bound(percent: int) -> int:
    """The largest distance that counts, for a link threshold in percent: four standard
    deviations above the mean distance at the threshold."""
    apart = 1 - percent / 100
    return min(HASHES - 2, math.ceil(HASHES * apart + 4 * math.sqrt(HASHES * apart * (1 - apart))))


def chunk_cuts(bound: int) -> list[int]:
    """Where the chunks of a signature start, and its end; a chunk has two symbols or more."""
    chunks = bound // 2 + 1
    return [round(i * HASHES / chunks) for i in range(chunks + 1)]


def key_sets(bound: int) -> list[tuple[int, ...]]:
    """The symbols of every key: each chunk without one of its symbols, the last first."""
    cuts = chunk_cuts(bound)
    return [kept for a, b in zip(cuts, cuts[1:]) for kept in combinations(range(a, b), b - a - 1)]


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in order, back to back, and their number."""
    data, starts = spaced(*bytes_of(column))
    data = fold(data)
    first, last = words(data)
    h = _HASH.spans(_HASH.prefix(data), first, last)
    begin = np.searchsorted(first, starts)
    shingles, n = shingle_hashes(h, begin[:-1], np.diff(begin), k)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.bincount(owner[new], minlength=len(n))


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of ``HASHES`` 8-bit symbols per set; rows of empty sets are meaningless."""
    out = np.zeros((len(sizes), HASHES), dtype=np.uint8)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(starts):
        for j in range(HASHES):
            least = np.minimum.reduceat(shingles * _ODD[j] + _ADD[j], starts)
            out[full, j] = (mix(least) & np.uint64(0xFF)).astype(np.uint8)
    return out


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return (total[ends] - total[ends - sizes]).view(np.int64)


SIGNED = "doc_id long, digest binary, n_shingles long, s1 long, s2 long, signature binary"


def _signer(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            shingles, sizes = shingle_sets(block.column("text"), k)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id"), block.column("digest"), pa.array(sizes.astype(np.int64)),
                pa.array(_sums(mix(shingles), sizes)), pa.array(_sums(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), sizes)),
                pa.array([r.tobytes() for r in signatures(shingles, sizes)], pa.binary()),
            ], names=["doc_id", "digest", "n_shingles", "s1", "s2", "signature"])

    return sign


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, HASHES)


def _keyer(bound: int):
    sets = key_sets(bound)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, rep = _matrix(batch.column("signature")).astype(np.uint64), batch.column("rep")
            for i, kept in enumerate(sets):
                h = np.full(len(rows), i + 1, dtype=np.uint64)
                for j in kept:
                    h = mix(h * np.uint64(0x9FB21C651E98DF25) + rows[:, j])
                # The low bits tell which key it is.
                h = h & ~np.uint64(HASHES - 1) | np.uint64(i)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), rep], names=["key", "rep"])

    return keys


def first_shared_key(one: np.ndarray, two: np.ndarray, bound: int) -> np.ndarray:
    """The number of the first key that each pair of signatures shares; HASHES if none."""
    cuts = np.array(chunk_cuts(bound))
    differs = one != two
    errors = np.add.reduceat(differs, cuts[:-1], axis=1)
    shares = errors <= 1
    chunk = shares.argmax(axis=1)
    start, end = cuts[chunk], cuts[chunk + 1]
    # Keys of a chunk leave out its symbols from the last to the first.
    at = np.arange(HASHES)
    wrong = (differs & (at >= start[:, None]) & (at < end[:, None])).argmax(axis=1)
    left_out = np.where(errors[np.arange(len(chunk)), chunk] == 0, end - 1, wrong)
    return np.where(shares.any(axis=1), start + (end - 1 - left_out), HASHES)


def _near(pairs: DataFrame, reps: DataFrame, bound: int, percent: int) -> DataFrame:
    """Pairs (a, b) within the distance bound and of compatible set sizes."""
    side = lambda c: reps.select(
        F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = (_matrix(batch.column("s_a")) != _matrix(batch.column("s_b"))).sum(axis=1)
                yield batch.select(["a", "b"]).filter(pa.array(apart <= bound))

    return joined.select("a", "b", "s_a", "s_b").mapInArrow(close, "a long, b long")


def _full_sets(needed: DataFrame, reps: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``rep, shingles`` of the classes in ``needed``; only one text of each is read."""
    wanted = reps.join(needed.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "digest")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            shingles, sizes = shingle_sets(block.column("text"), k)
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                block.column("rep"), pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.view(np.int64)))
            ], names=["rep", "shingles"])

    named = wanted.select("rep", F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    texts = docs.join(named, same).select("rep", "text").dropDuplicates(["rep"])
    return stage_table(texts.mapInArrow(sets, "rep long, shingles array<bigint>"), "near-sets")


def _confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs that link by their full shingle sets."""
    pairs = stage_table(pairs, "near-pairs")
    needed = pairs.select(F.col("a").alias("rep")).distinct().union(pairs.select("b").distinct())
    full = _full_sets(needed, reps, docs, k)
    side = lambda c: full.select(F.col("rep").alias(c), F.col("shingles").alias(f"s_{c}"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - both
    return (
        pairs.join(side("b"), "b").join(side("a"), "a")
        .filter(100 * both.cast("bigint") >= percent * union.cast("bigint")).select("a", "b")
    )


PAIR_ROWS = 1 << 16


def _expanded(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j inside groups of the given sizes, some at a time."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    later = ends - np.arange(len(ends)) - 1
    done = np.cumsum(later)
    row = 0
    while row < len(later):
        base = done[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(done, base + PAIR_ROWS, side="right")))
        n = later[row:stop]
        i = np.repeat(np.arange(row, stop), n)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        row = stop


class _Run:
    """Sorted rows of whole (key, x, y) groups, and the pairs among them worth a check."""

    def __init__(self, rows: pa.RecordBatch, bound: int, percent: int) -> None:
        self.rows, self.bound, self.percent = rows, bound, percent
        self.group = np.cumsum(group_starts(rows, ["key", "x", "y"])) - 1
        self.key, self.rep, self.label, self.left, self.right, self.n = (
            rows.column(c).to_numpy(zero_copy_only=False) for c in ("key", "rep", "label", "left", "right", "n_shingles")
        )
        self.symbols = _matrix(rows.column("signature"))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Members of different components within the bound, in the pair's first key."""
        for i, j in _expanded(np.bincount(self.group)):
            wanted = (self.label[i] != self.label[j]) & (self.left[i] & self.right[j] | self.right[i] & self.left[j])
            wanted &= 100 * np.minimum(self.n[i], self.n[j]) >= self.percent * np.maximum(self.n[i], self.n[j])
            i, j = i[wanted], j[wanted]
            one, two = self.symbols[i], self.symbols[j]
            apart = (one != two).sum(axis=1)
            close = apart <= self.bound
            i, j, apart, one, two = i[close], j[close], apart[close], one[close], two[close]
            first = first_shared_key(one, two, self.bound) == (self.key[i] & (HASHES - 1))
            if first.any():
                yield i[first], j[first], apart[first]


def _having_partners(bound: int, percent: int):
    """The rows that have a pair worth a check; each once for its group."""
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "x", "y"]):
            run = _Run(rows, bound, percent)
            paired = np.zeros(rows.num_rows, dtype=bool)
            for i, j, _ in run.pairs():
                paired[i] = paired[j] = True
            if paired.any():
                yield rows.filter(pa.array(paired))

    return members


class _Forest:
    """Which labels have been joined so far."""

    def __init__(self) -> None:
        self.top: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.top.get(x, x)) != x:
            self.top[x] = self.top.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.top[max(a, b)] = min(a, b)
        return a != b


def _linking(bound: int, percent: int):
    """Links between components, confirmed on full sets; none that joins nothing new.

    A member is checked against all its partners at once, nearest members first.
    """
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["key", "x", "y"]):
            run, forest, found = _Run(rows, bound, percent), _Forest(), []
            sets = rows.column("shingles")
            ends = np.append(0, np.cumsum(sets.value_lengths().to_numpy())).astype(np.int64)
            # Sets are in the order of their unsigned hashes.
            values = sets.flatten().to_numpy().view(np.uint64)
            for i, j, apart in run.pairs():
                order = np.lexsort((j, i))
                i, j, apart = i[order], j[order], apart[order]
                cuts = np.append(np.flatnonzero(np.diff(i, prepend=-1)), len(i))
                for m in np.argsort(np.minimum.reduceat(apart, cuts[:-1]), kind="stable"):
                    one, others = i[cuts[m]], j[cuts[m]:cuts[m + 1]]
                    mine = forest.find(run.label[one])
                    others = others[[forest.find(x) != mine for x in run.label[others].tolist()]]
                    if not len(others):
                        continue
                    own, size = values[ends[one]:ends[one + 1]], ends[others + 1] - ends[others]
                    at = np.arange(size.sum()) + np.repeat(ends[others] - np.cumsum(size) + size, size)
                    theirs = values[at]
                    place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                    both = np.add.reduceat(own[place] == theirs, np.cumsum(size) - size)
                    linked = 100 * both >= percent * (len(own) + size - both)
                    for other in others[linked]:
                        if forest.join(run.label[one], run.label[other]):
                            found.append((run.rep[one], run.rep[other]))
            if found:
                ends_of = np.array(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ends_of.min(axis=1)), pa.array(ends_of.max(axis=1))
                ], names=["a", "b"])

    return links


def _open_members(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold several components."""
    of = labels.select(F.col("id").alias("rep"), F.col("component").alias("label"))
    known = shared.join(of, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    bucket = Window.partitionBy("key")
    return known.withColumn("lo", F.min("label").over(bucket)).withColumn("hi", F.max("label").over(bucket)).withColumn(
        "n", F.count("*").over(bucket)
    ).filter("lo < hi").drop("lo", "hi")


def _neighbours(open_: DataFrame, turn: int) -> DataFrame:
    """Each member of a crowded bucket with the next one by hash, if of another component.

    The order is the same in all buckets, so that members meet the same neighbours there.
    """
    order = Window.partitionBy("key").orderBy(F.xxhash64("rep", F.lit(turn)), "rep")
    following = F.lead(F.struct("rep", "label")).over(order)
    pairs = open_.filter(F.col("n") >= CROWD).select("rep", "label", following.alias("next"))
    return pairs.filter("label != next.label").select(
        F.least("rep", "next.rep").alias("a"), F.greatest("rep", "next.rep").alias("b")
    ).distinct()


def _sliced(members: DataFrame, slices) -> DataFrame:
    """Members of a bucket cut into pairs of ``slices`` slices, of rows that can meet."""
    slices = slices.cast("int")
    mine = F.pmod(F.xxhash64("rep"), slices).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda s: F.struct(
        F.least(s, F.col("mine")).alias("x"), F.greatest(s, F.col("mine")).alias("y")
    ))
    cut = members.withColumns({"mine": mine, "slices": slices}).withColumn("pair", F.explode(pairs))
    return cut.select(
        *members.columns, "pair.x", "pair.y", (F.col("mine") == F.col("pair.x")).alias("left"),
        (F.col("mine") == F.col("pair.y")).alias("right"),
    )


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")


MEMBER = "key long, rep long, label long, x int, y int, left boolean, right boolean, n_shingles long, signature binary"


def _last_links(open_: DataFrame, reps: DataFrame, docs: DataFrame, k: int, bound: int, percent: int) -> DataFrame:
    """The links that are missing between the components of open buckets."""
    columns = [c.split()[0] for c in MEMBER.split(", ")]
    signed = open_.join(reps.select("rep", "n_shingles", "signature"), "rep")
    meeting = _sliced(signed, F.ceil(F.col("n") / SLICE)).select(*columns)
    # A row that has partners in several slices comes once.
    paired = stage_table(
        _by_group(meeting).mapInArrow(_having_partners(bound, percent), MEMBER).dropDuplicates(["key", "rep"])
        .select("key", "rep", "label", "n_shingles", "signature"),
        "near-paired",
    )
    full = _full_sets(paired, reps, docs, k)
    bytes_in = F.sum(F.col("n_shingles") * 8).over(Window.partitionBy("key"))
    cut = _sliced(paired.withColumn("size", bytes_in), F.ceil(F.col("size") / SLICE_BYTES))
    return (
        _by_group(cut.join(full, "rep").select(*columns, "shingles"))
        .mapInArrow(_linking(bound, percent), "a long, b long").distinct()
    )


def near_links(docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """``id, component`` for the classes that link with another class."""
    bound = distance_bound(percent)
    bucket = Window.partitionBy("key")
    shared = stage_table(
        reps.select("rep", "signature").mapInArrow(_keyer(bound), "key long, rep long")
        .withColumn("center", F.min("rep").over(bucket)).withColumn("top", F.max("rep").over(bucket))
        .filter("center < top").drop("top"),
        "near-shared",
    )
    pairs = shared.filter("center < rep").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    found = stage_table(_confirmed(_near(pairs, reps, bound, percent), reps, docs, k, percent), "near-links")
    labels, before, turn = components(found), None, 0
    shared = shared.drop("center")
    while True:
        open_ = stage_table(_open_members(shared, labels), "near-open")
        crowded = open_.filter(F.col("n") >= CROWD).count()
        if not crowded or before is not None and 2 * crowded > before:
            break
        before, turn = crowded, turn + 1
        more = _confirmed(_near(_neighbours(open_, turn), reps, bound, percent), reps, docs, k, percent)
        found = stage_table(found.unionByName(more), "near-links")
        labels = components(found)
    last = stage_table(_last_links(open_, reps, docs, k, bound, percent), "near-last")
    return labels if last.isEmpty() else components(found.unionByName(last))


SETS = ["s1", "s2", "n_shingles"]


def _components(docs: DataFrame, k: int, percent: int, unnamed: bool) -> tuple[DataFrame, DataFrame]:
    """Every row as ``doc_id, digest, s1, s2, n_shingles``, and the component of each set.

    With ``unnamed`` rows without an id count, too.  Classes are numbered, so that two
    texts of one id are two classes.
    """
    pin_batches(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"),
        F.unhex(F.sha2(text_of(), 256)).alias("digest"),
    )
    signed = stage_table(docs.select("doc_id", "digest", "text").mapInArrow(_signer(k), SIGNED), "near-signed")
    counted = F.col("n_shingles") > 0
    counted = counted if unnamed else counted & F.col("doc_id").isNotNull()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", "signature")).alias("m")
    reps = stage_table(
        signed.filter(counted).groupBy(*SETS).agg(first)
        .select(F.monotonically_increasing_id().alias("rep"), *SETS, "m.doc_id", "m.digest", "m.signature"),
        "near-reps",
    )
    labels = near_links(docs, reps, k, percent)
    joined = reps.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    named = joined.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first")
    )
    classes = joined.join(named, "component").select(*SETS, "first.doc_id", "first.digest")
    return signed.drop("signature"), stage_table(
        classes.withColumnsRenamed({"doc_id": "first_id", "digest": "first_digest"}), "near-classes"
    )


def near_decisions(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents link when their sets of ``k``-word shingles have a similarity of at
    least ``percent``; a component is the transitive closure, named by its smallest id.
    """
    rows, classes = _components(docs, k, percent, unnamed=False)
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return rows.join(classes, SETS, "left").select(
        "doc_id", "n_shingles", F.when(linked, F.col("first_id")).otherwise(F.col("doc_id")).alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every component: that of the smallest id.

    A row is known by ``doc_id`` and text.  Rows without words stay.
    """
    def own(name: str) -> str:
        while any(c.lower() == name for c in docs.columns):
            name = "_" + name
        return name

    rows, classes = _components(docs, k, percent, unnamed=True)
    decided = stage_table(
        rows.filter("n_shingles > 0").join(classes, SETS).select("doc_id", "digest", (
            F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
        ).alias("kept")),
        "near-decided",
    )
    mine, its_id, its_digest = own("row_digest"), own("dropped_id"), own("dropped_digest")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(its_id)) & (F.col(mine) == F.col(its_digest))

    def named(found: DataFrame) -> DataFrame:
        return found.select(F.col("doc_id").alias(its_id), F.col("digest").alias(its_digest))

    dropped = named(decided.filter(~F.col("kept")).distinct())
    kept = docs.withColumn(mine, F.unhex(F.sha2(text_of(), 256))).join(dropped, same, "left_anti")
    again = decided.filter("kept").groupBy("doc_id", "digest").count().filter("count > 1")
    if again.isEmpty():
        return kept.select(docs.columns)
    # Only where rows repeat: one of each stays.
    once = kept.join(named(again), same, "left_semi").dropDuplicates(["doc_id", mine])
    return kept.join(named(again), same, "left_anti").unionByName(once).select(docs.columns)
