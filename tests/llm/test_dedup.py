"""Exact, near and substring dedup, fingerprints and mixing against brute force."""

from __future__ import annotations

import hashlib
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm import fingerprints, minhash, mixing, suffix_dedup
from eventloom.llm.components import components
from eventloom.llm.exact_dedup import dedup_decisions, exact_dedup, rice_decode, rice_encode

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=50), st.integers(0, 41))
def test_rice_round_trip(values, k):
    steps = np.diff(np.unique(np.array(values, dtype=np.uint64)), prepend=np.uint64(0))
    k = max(k, int(steps.max()).bit_length() - 12)
    assert (rice_decode(rice_encode(steps, k), len(steps), k) == steps).all()


def check_exact(df):
    rows = pairs_of(df)
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOW)].append(i)
    want = []
    for i, t in rows:
        text = (t or "").translate(LOW)
        ids = [x for x in groups[text] if x is not None]
        keep = max(ids) if ids else None
        want.append((i, keep, len(groups[text]), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in dedup_decisions(df).collect()]
    assert Counter(got) == Counter(want)


def test_exact_decisions(edge, sample, empty):
    check_exact(edge)
    check_exact(sample)
    assert dedup_decisions(empty).count() == 0


def by_length(raw: bytes) -> bytes:
    """A digest that all texts of a length share."""
    return len(raw).to_bytes(32, "big")


def test_exact_groups_are_told_by_bytes(spark):
    rows = [(1, "ab"), (2, "AB"), (3, "cd"), (None, "cd"), (5, "ef"), (6, "xyz"), (7, "XYZ"), (8, "alone"), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dedup_decisions(docs, digest=by_length).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert Counter(map(tuple, got)) == Counter([
        (1, 2, 2, False), (2, 2, 2, True), (3, 3, 2, True), (None, 3, 2, False), (5, 5, 1, True), (6, 7, 2, False),
        (7, 7, 2, True), (8, 8, 1, True), (9, 9, 2, True), (9, 9, 2, True),
    ])


def test_exact_copies_that_are_no_utf8(spark):
    docs = spark.sql(
        "SELECT id AS doc_id, CAST(unhex(CASE WHEN id < 2 THEN 'FF41' WHEN id = 2 THEN 'FF61' ELSE 'FE61' END) AS STRING) AS text"
        " FROM range(4)"
    )
    got = dedup_decisions(docs).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(tuple, got)) == [(0, 2, 3), (1, 2, 3), (2, 2, 3), (3, 3, 1)]


def test_exact_filter_keeps_columns_and_one_row_each(edge):
    kept = exact_dedup(edge)
    assert kept.columns == edge.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 0 and ids[2] == 1 and ids[12] == 1


def test_exact_filter_knows_rows_by_id_and_text(spark):
    rows = [(5, "A"), (9, "a"), (5, "B"), (5, "B"), (None, "C"), (None, "c"), (None, "B"), (None, "D"), (7, None), (8, "")]
    kept = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in kept)
    assert got == [("5", "b"), ("8", ""), ("9", "a"), ("None", "c"), ("None", "d")]


def near_brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    top[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_components(sample, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_decisions(sample, k, percent).collect()}
    assert got == near_brute(pairs_of(sample), k, percent)


def test_near_edge_cases(edge, empty):
    rows = minhash.near_decisions(edge, 3, 85).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[2]["component_id"] == 1 and by[9]["component_id"] == 8
    assert all(by[i]["kept"] and by[i]["n_shingles"] == 0 for i in (3, 4, 5))
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert len(rows) == edge.count()
    assert minhash.near_decisions(empty).count() == 0
    assert minhash.near_dedup(edge, 3, 85).columns == edge.columns


def test_crowded_group_of_near_copies(spark):
    """A base and copies with ever more words changed: many stay unlinked to each other."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        words = list(base)
        for j in rng.choice(150, size=i // 6, replace=False):
            words[j] = f"c{i}x{j}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_decisions(df, 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)


def test_slices_of_a_bucket_cover_all_pairs(sample, monkeypatch):
    monkeypatch.setattr(minhash, "SLICE", 2)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_decisions(sample, 3, 85).collect()}
    assert got == {i: c for i, (_, c) in near_brute(pairs_of(sample), 3, 85).items()}


def test_every_pair_within_the_bound_shares_a_key():
    rng = np.random.default_rng(1)
    bound = minhash.distance_bound(85)
    sets = minhash.key_sets(bound)
    for _ in range(300):
        changed = set(rng.choice(minhash.HASHES, size=bound, replace=False).tolist())
        assert any(not changed & set(kept) for kept in sets)


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40, 60: 40}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats_brute(rows):
    """Rows in order of id; rows of one id stand at the same place."""
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if seen.setdefault(b[s:s + 100], (i, s)) != (i, s):
                gone[s:s + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_repeats(sample, edge, empty, spark):
    short = spark.createDataFrame([(1, "ab" * 120), (2, "a" * 250), (3, "b" + "ab" * 60), (4, "a" * 99), (5, "é" * 80)], "doc_id long, text string")
    for df in (sample, edge.filter("doc_id is null or doc_id not in (8, 9)"), short):
        got = suffix_dedup.repeat_digest(suffix_dedup.without_repeats(df)).collect()
        assert Counter(tuple(r) for r in got) == repeats_brute(pairs_of(df))
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_repeats_of_several_texts_of_one_id(spark):
    """Spans belong to a row's text: what one text of an id repeats is no matter of the other's."""
    rng = np.random.default_rng(4)
    words = lambda n: " ".join(f"{x:06x}" for x in rng.integers(0, 1 << 24, n))
    shared = words(40)
    rows = [
        (1, shared), (5, shared + words(30)), (5, words(80)), (5, words(20) + shared), (None, words(60)), (None, shared),
        (None, shared), (9, words(30) + shared),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    at = {row: n for n, row in enumerate(order)}
    brute = repeats_brute([(at[r], r[1]) for r in rows])
    want = Counter()
    for (n, *rest), times in brute.items():
        want[(order[n][0], *rest)] += times
    assert Counter(tuple(r) for r in suffix_dedup.repeat_digest(suffix_dedup.without_repeats(df)).collect()) == want


def test_owners_work_follows_the_grams_not_the_messages():
    """Each message lists its own documents only, and an owner looks once at what is repeated."""
    rng = np.random.default_rng(6)
    grams = rng.integers(0, 1 << 40, 4000).astype(np.uint64)
    one = np.ones(4000, dtype=np.int64)
    part = (grams, rng.integers(0, 1000, 4000), one, one, one)
    messages = suffix_dedup._messages(np.arange(1000), [part], 400, 0).to_pandas()
    assert sum(len(suffix_dedup.unpack_wide(b)) for b in messages["docs"]) <= 4000

    known = np.arange(300_000) * 8
    rows = [{
        "owner": 0, "docs": suffix_dedup.pack_wide(np.array([m])), "grams": suffix_dedup.pack_wide(np.array([8 * m, 8 * m + 1])),
        **dict.fromkeys(("doc", "place", "first"), suffix_dedup.pack(np.zeros(2))), "n": suffix_dedup.pack(np.ones(2)),
        "known": suffix_dedup.pack_wide(known if m == 0 else known[:0]), "sure": False,
    } for m in range(1000)]
    began = time.process_time()
    found = suffix_dedup._repeated(pd.DataFrame(rows))
    assert found["id"].tolist() == list(range(1000))
    assert time.process_time() - began < 2


def test_strings_of_a_gram_are_sorted_in_parts(monkeypatch):
    """All of a run of equal strings but its first place is repeated, however many are sorted at a time."""
    rng = np.random.default_rng(8)
    pool = rng.integers(97, 99, (6, 160)).astype(np.uint8)
    phrases = []
    for _ in range(200):
        gram, at, n = int(rng.integers(0, 3)), int(rng.integers(0, 30)), int(rng.integers(1, 20))
        text = pool[rng.integers(6), at:at + n + 99].tobytes()
        phrases.append((gram, int(rng.integers(0, 90)), int(rng.integers(0, 5000)), n, text))
    names = [c.split()[0] for c in suffix_dedup.PHRASE.split(", ")]
    rows = pa.RecordBatch.from_pydict(dict(zip(names, zip(*sorted(phrases)))))
    least, want = {}, set()
    for gram, id_, first, n, text in phrases:
        for j in range(n):
            key = (gram, text[j:j + 100])
            least[key] = min(least.get(key, (id_, first + j)), (id_, first + j))
    for gram, id_, first, n, text in phrases:
        want.update((id_, first + j) for j in range(n) if least[gram, text[j:j + 100]] != (id_, first + j))
    for strings in (suffix_dedup.STRINGS, 50, 1):
        monkeypatch.setattr(suffix_dedup, "STRINGS", strings)
        found = [r for b in suffix_dedup._sorted_runs(iter([rows.slice(0, 70), rows.slice(70)])) for r in b.to_pylist()]
        got = {(r["id"], s) for r in found for s in range(r["start"], r["stop"] - 99)}
        assert got == want


def test_long_repeat_is_removed_whole(edge):
    rows = {r["doc_id"]: r for r in suffix_dedup.without_repeats(edge).collect()}
    assert rows[9]["n_bytes"] - len(rows[9]["kept"]) > 0.99 * rows[9]["n_bytes"] - 200


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_fingerprints_equal_brute_force(sample, edge, spark, reuse):
    """Both fingerprints and the likeness of each row, also if no exchange is reused."""
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    for df in (sample.repartition(5), edge):
        rows = sorted(pairs_of(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        of = lambda t: fingerprints.vectors(pa.array([t or ""]))
        want = []
        for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
            t, f = t or "", f or ""
            changed = t[:len(t) - len(t) // 4] + f[:len(t) // 4]
            want.append((
                str(i), fingerprints.pack(*of(t))[0], fingerprints.pack(*of(changed))[0],
                round(float(fingerprints.likeness(of(t), of(changed))[0]), 9), round(float(fingerprints.likeness(of(t), of(f))[0]), 9),
            ))
        got = [
            (str(r["doc_id"]), r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
            for r in fingerprints.edited_fingerprints(df).collect()
        ]
        assert sorted(got) == sorted(want)
    spark.conf.set("spark.sql.exchange.reuse", "true")


def test_fingerprints_match_edits(sample, edge, empty, spark):
    for df in (sample, edge):
        rows = sorted(pairs_of(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want = []
        for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
            t, f = t or "", f or ""
            edited = t[:len(t) - len(t) // 4] + f[:len(t) // 4]
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
        got = fingerprints.edited_fingerprints(df).collect()
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == Counter(want)
        assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert fingerprints.edited_fingerprints(empty).count() == 0
    alone = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0


def test_fingerprints_are_homomorphic():
    def of(text):
        return fingerprints.pack(*fingerprints.vectors(pa.array([text])))[0]

    a, b = "one two three four\nfive six", "seven\neight nine ten"
    assert of(f"{a}\n{b}") == of(f"{b}\n\n{a}") == fingerprints.merge(of(a), of(b))
    assert fingerprints.merge(of(f"{a}\n{b}"), of(b), delete=True) == of(a)
    assert of(a) != of(b) and of("x\nx") != of("x")


def test_mixing(sample, edge, empty):
    for df in (sample, edge):
        rows = mixing.mix_counts(df).collect()
        assert len(rows) == df.count()
        sources = {r["source"]: (r["source_size"], r["target"]) for r in rows}
        order = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        level, total = 0.0, 1.5 * sum(n for n, _ in sources.values())
        for _ in order:  # raise the level until nothing is above its cap
            full = {s for s in order if 2 * sources[s][0] <= weights[s] * level}
            rest = sum(weights[s] for s in order if s not in full)
            level = (total - sum(2 * sources[s][0] for s in full)) / rest if rest else level
        for s, (size, target) in sources.items():
            assert target == pytest.approx(min(2 * size, weights[s] * level))
        assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in rows)
        mixed = mixing.mix_sources(df)
        assert mixed.columns == df.columns
        assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix_counts(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0


def test_mix_comes_near_its_targets(sample):
    rows = mixing.mix_counts(sample).groupBy("source", "target").sum("taken").collect()
    assert sum(abs(r["sum(taken)"] - r["target"]) for r in rows) < 0.1 * sum(r["target"] for r in rows)


def test_first_shared_key_equals_a_search():
    rng = np.random.default_rng(2)
    bound = minhash.distance_bound(80)
    sets = minhash.key_sets(bound)
    assert len(sets) == minhash.HASHES
    one = rng.integers(0, 3, (200, minhash.HASHES), dtype=np.uint8)
    two = one.copy()
    for row in two:
        at = rng.choice(minhash.HASHES, size=rng.integers(0, 90), replace=False)
        row[at] = 7
    got = minhash.first_shared_key(one, two, bound)
    for a, b, first in zip(one, two, got):
        want = [n for n, kept in enumerate(sets) if all(a[i] == b[i] for i in kept)]
        assert first == (want[0] if want else minhash.HASHES)


def test_near_filter_knows_rows_by_id_and_text(spark):
    words = [f"w{i}" for i in range(60)]
    a, near_a, b = " ".join(words), " ".join(words[:-1] + ["z"]), " ".join(f"b{i}" for i in range(60))
    rows = [
        (1, a), (2, near_a), (2, b), (3, b), (3, b), (None, a), (None, "x y z u v w"), (None, "X Y Z U V W"), (None, None),
        (7, ""), (8, "only one"), (8, "only one"),
    ]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, row_digest int, Dropped_ID string")
    kept = minhash.near_dedup(docs.repartition(4))
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in kept.collect())
    assert got == [("1", a), ("2", b), ("7", ""), ("8", "only one"), ("None", ""), ("None", "x y z u v w")]


def test_links_across_slices_join_nothing_twice(spark, monkeypatch):
    """Chains of near copies: every task may only give links that join something."""
    monkeypatch.setattr(minhash, "SLICE_BYTES", 4096)
    rng, rows = np.random.default_rng(11), []
    for c in range(4):
        words = [f"{c}w{i}" for i in range(120)]
        for i in range(40):
            words[int(rng.integers(120))] = f"{c}n{i}"
            rows.append((c * 100 + i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_decisions(df, 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)


def test_last_links_find_every_near_copy():
    """Sets that meet in a bucket are compared whole, wherever their hashes lie."""
    rng, texts = np.random.default_rng(3), []
    base = [f"w{i}" for i in range(200)]
    for i in range(60):
        words = list(base)
        for j in rng.choice(200, size=1 + i // 6, replace=False):
            words[j] = f"c{i}x{j}"
        texts.append(" ".join(words))
    texts.insert(0, " ".join(base))
    shingles, sizes = minhash.shingle_sets(pa.array(texts), 3)
    symbols, sets = minhash.signatures(shingles, sizes), np.split(shingles.view(np.int64), np.cumsum(sizes)[:-1])
    bound = minhash.distance_bound(85)
    keys = minhash.first_shared_key(np.repeat(symbols[:1], 60, axis=0), symbols[1:], bound)
    # A bucket for the base and each copy, named by the first key that the two share.
    rows = [(int(key) + 128 * n, r, r, 0, 0, True, True, int(sizes[r]), symbols[r].tobytes(), sets[r].tolist())
            for n, key in enumerate(keys, 1) for r in (0, n)]
    names = [c.split()[0] for c in minhash.MEMBER.split(", ")] + ["shingles"]
    batches = [pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows[i:i + 2])))) for i in range(0, len(rows), 2)]
    got = {tuple(r.values()) for b in minhash._linking(bound, 85)(iter(batches)) for r in b.to_pylist()}
    want = {i: c for i, (_, c) in near_brute(list(enumerate(texts)), 3, 85).items()}
    assert got == {(0, n) for n in range(1, 61) if want[n] == 0}
    assert 20 < len(got) < 60
