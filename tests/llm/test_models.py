"""Chat, classifier, BPE, language model, extraction and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import bpe, chat, extract, lattice, quality
from eventloom.llm.common import whole_groups
from tests.llm.conftest import SF
from tests.llm.test_dedup import LOW, WORD, near_brute, pairs_of

VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def encoder():
    with open(VOCAB, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(sample, edge, empty):
    own = encoder()
    for df in (sample, edge):
        ids = bpe.encode_documents(df, VOCAB, public_tokenizers.PATTERN)
        got = [(r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in bpe.decode_documents(ids, VOCAB).collect()]
        want = [(i, tuple(own.encode_ordinary(t or "")), (t or "").encode()) for i, t in pairs_of(df)]
        assert Counter(got) == Counter(want)
    ids = bpe.encode_documents(edge, VOCAB, public_tokenizers.PATTERN)
    apart = bpe.token_digest(bpe.decode_documents(ids, VOCAB)).collect()
    assert sorted(map(str, bpe.decoded_digest(ids, VOCAB).collect())) == sorted(map(str, apart))
    at_once = bpe.encode_digest(edge, VOCAB, public_tokenizers.PATTERN).collect()
    assert sorted(map(str, at_once)) == sorted(map(str, apart))
    assert bpe.encode_digest(empty, VOCAB, public_tokenizers.PATTERN).count() == 0
    assert bpe.token_digest(bpe.decode_documents(bpe.encode_documents(empty, VOCAB, public_tokenizers.PATTERN), VOCAB)).count() == 0


def test_pre_tokens_follow_unicode_white_space():
    text = "a\x1c b\x85c d᠎e　　f  \n\n g"
    own = encoder()
    ids = [i for word in bpe.pattern_of(public_tokenizers.PATTERN).findall(text) for i in own._encode_single_piece(word.encode())]
    assert ids == own.encode_ordinary(text)


def test_packing_round_trip():
    for values in ([], [0], [255, 256, 1 << 20], list(range(1000))):
        assert bpe.unpack(bpe.pack(np.array(values))).tolist() == values


ROWS = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_reads_back(spark):
    nasty = r"a <| b <\| c <\\| <|im_end|>" + "\n<|im_start|>user\nx<"
    rows = [
        (1, 2, "assistant", nasty, ""), (1, 1, "user", "hi", ""), (1, 3, "assistant", None, ""), (1, None, "system", nasty, ""),
        (2, 1, "user", "", ""), (2, 1, "user", "", ""), (3, 1, None, "x\n", ""), (None, 1, "assistant", "<|part|>", ""),
        (4, 1, "ro\nle<|", "t", ""),
    ]
    formatted = chat.format_chats(spark.createDataFrame(rows, ROWS).repartition(4))
    got = {r["conv_id"]: r for r in formatted.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.under_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r[2] or "", r[3] or "") for r in mine]
        assert got[conv]["loss"] == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    assert got[1]["formatted"].count("<|im_start|>assistant") == 1
    assert chat.chat_digest(chat.format_chats(spark.createDataFrame([], ROWS))).count() == 0


def test_rules_are_paths_of_trees():
    text = "Tree 0\n  If (feature 0 <= 1.5)\n   If (feature 0 <= 0.5)\n    Predict: 1.0\n   Else (feature 0 > 0.5)\n    Predict: 0.0\n  Else (feature 0 > 1.5)\n   Predict: 0.0\n"
    chars = quality.STATS[0]
    assert quality.tree_rules(text) == [
        ((chars, False, 1.5),), ((chars, False, 0.5),), ((chars, False, 1.5), (chars, True, 0.5)), ((chars, True, 1.5),)
    ]


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum((r["predicted"] == 1) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 40 and right / len(rows) > 0.93


def test_quality_edge_cases(edge, empty, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (99, 0)], "doc_id long, quality int")
    rows = quality.quality_scores(edge, labels).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.quality_scores(empty, labels).count() == 0
    none = labels.filter("doc_id is null")
    assert {r["score"] for r in quality.quality_scores(edge, none).collect()} == {0.5}
    assert quality.quality_filter(edge, none).columns == edge.columns


def segmentations(word, weights):
    if not word:
        return 1.0
    return sum(weights[word[:n]] * segmentations(word[n:], weights) for n in range(1, len(word) + 1) if word[:n] in weights)


def test_lattice_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", "▁", "▁a"] + [f"<0x{i:02X}>" for i in range(256)]
    byte_ids = np.arange(7, 263)
    log = np.log(np.full(len(pieces), 1 / 263))
    model = lattice.Lattice(pieces, byte_ids)
    weights = {p: 1 / 263 for p in pieces[:7]}
    words = [b"abab", b"aaab", b"b"]
    for at, codes in lattice.by_length(words):
        for i, score in zip(at, model.log10(codes, log)):
            assert score == pytest.approx(math.log10(segmentations("▁" + words[i].decode(), weights)))
        for i, codes_i in zip(at, codes):
            uses = model.expected(codes_i[None], np.ones(1), log)
            assert sum(u * len(p) for u, p in zip(uses, pieces)) == pytest.approx(len(words[i]) + 1)
    (_, codes), = lattice.by_length(["é".encode()])
    assert model.log10(codes, log)[0] == pytest.approx(3 * math.log10(1 / 263))


def test_lattice_base_scores(sample, edge, empty):
    for df in (sample, edge):
        rows = pairs_of(df)
        tokens = [WORD.findall((t or "").translate(LOW)) + [None] for _, t in rows]
        train = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0 for i, _ in rows]
        count = Counter(w for words, t in zip(tokens, train) if t for w in words)
        n, v = sum(count.values()), len(count)
        want = Counter((
            i, not t, len(words), sum(count[w] > 0 for w in words), n,
            round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), 4),
        ) for (i, _), words, t in zip(rows, tokens, train))
        got = lattice.lattice_scores(df, PIECES, rounds=1).collect()
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
        assert all(r["score"] < 0 for r in got)
    assert lattice.lattice_scores(empty, PIECES).count() == 0


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header>Site</header>
<nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<article><header><h1>Head &amp; title</h1></header><p>One<br>two <b>three<p>Four&nbsp;&lt; five
 six</p><form><input>no</form><ul><li>x<li>y</ul><aside>no</aside><section id="comments"><p>no</p></section></article>
<footer>no</footer></body></html>"""


def test_main_text_of_a_page():
    assert extract.page_text(PAGE) == "Head & title\nOne two three\nFour < five six\nx\ny"
    assert extract.page_text("") == "" and extract.page_text("plain < text") == "plain < text"
    assert extract.page_text("<p>a<p>b</div></p>") == "a\nb"


def test_style_tree_removes_what_a_host_repeats(spark):
    pages = [
        (i, f"https://h.example/{i}", f"<body><div><p>welcome here</p></div><div class=text><p>own text {i}</p></div></body>", "x")
        for i in range(8)
    ] + [(20, None, "<p>a</p>", "x"), (21, "https://h.example/x", None, "x"), (None, "nonsense", "", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in extract.main_texts(df).collect()}
    assert got == {**{i: f"own text {i}" for i in range(8)}, 20: "a", 21: "", None: ""}
    assert extract.main_texts(df.limit(0)).count() == 0


def test_copies_of_an_article_keep_their_text(spark):
    rows = [(i, f"https://h.example/{i}", "<body><article><p>same</p></article></body>") for i in range(9)]
    got = extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"same"}


def texts_of(spark, pages, host="h.example"):
    rows = [(i, f"https://{host}/{i}", page) for i, page in enumerate(pages)]
    got = extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_protected_text_weighs_for_the_nodes_above(spark):
    plain = [[f"text {i} {j}" for j in range(9)] for i in range(8)]
    for lead in ("lead", "lead-%d"):
        got = texts_of(spark, [
            f"<html><body><div>fixed one</div><div>fixed two</div><article><p class={lead.replace('%d', str(i))}>lead {i}"
            f"{''.join(f'<p>{t}' for t in texts)}</article></body></html>" for i, texts in enumerate(plain)
        ])
        assert got == ["\n".join([f"lead {i}", *texts]) for i, texts in enumerate(plain)]


def test_marked_menus_do_not_pull_down_the_text_beside_them(spark):
    menu = "<nav>" + "".join(f"<li>item {j}" for j in range(30)) + "</nav>"
    got = texts_of(spark, [
        f"<body>{menu}own {i}<div class=c><p>text {i}</p><p class=x{i}>rare {i}</p></div><ul><li>fixed</li></ul></body>"
        for i in range(8)
    ])
    assert got == [f"own {i}\ntext {i}\nrare {i}" for i in range(8)]


def test_style_tree_counts_all_text(spark):
    pages = [f"<body><nav>menu</nav><article><p>same<p>own {i}</article>tail {i % 2}</body>" for i in range(8)]
    rows = [(f"https://h.example/{i}", page) for i, page in enumerate(pages)]
    got = {r["path"]: r for r in extract.style_tree(spark.createDataFrame(rows, "url string, html string")).collect()}
    # Two texts of all 8 pages, two of 4 pages, eight of one page; one presentation.
    spread = (16 * math.log(8) + 8 * math.log(4)) / 32 / math.log(8)
    want = {"/body": 0.8 * (1 - spread), "/body/article": 0.4, "/body/article/p": 0.5, "/body/nav": 0.0,
            "/body/": 1 - math.log(4) / math.log(8)}
    assert set(got) == set(map(extract.code, want)) and {r["pages"] for r in got.values()} == {8}
    assert all(abs(got[extract.code(p)]["importance"] - v) < 1e-9 for p, v in want.items())


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><article><p>a<p>b</article><footer>no</footer></body>",
    "<body class=menu><p>a<p>b<div class=menu>no</div></body>",
    "<div class='menu-open'><div><article><p>a<p>b</article></div><div class='cookie-notice'>no</div></div>",
    "<div id='search-results'><article><p>a</article><article><p>b</article></div>",
    "<div class=search><main><p>a<p>b</main></div><p>no",
    "<article class='post comment-open'><p>a<div class=entry-header>b</div><div class=comment-list>no</div></article>",
    "<article><p>a<p>b<section class=comments><article>no</article></section></article>",
    "<form><div>no<article><p>a<p>b</article></div></form>",
    "<nav><article>no</article></nav><p>a<form>no</form><p>b<div id=ad-3>no</div><div role=search>no</div>",
])
def test_words_hide_only_leaf_side_branches(page):
    assert extract.page_text(page) == "a\nb"


@pytest.mark.parametrize("page", [
    "<article><section id='login'><h2>a</h2><p>b</p></section></article>",
    "<article><h2 id='related'>a</h2><h2 id=comments>b</h2></article>",
    "<div class='post comments-open'><p>a<p>b</div>", "<main><div class='ad-hoc'><p>a<p>b</div></main>",
    "<form><nav>no</nav><div><h1>a</h1><p>b</div><footer>no</footer></form>",
    "<p>a <!-- x --><script>no</script><style>no</style>\n<h2>b<svg><text>no</text><svg>no</svg></svg></h2>",
    "<div class='comment-list'>no</div><p>a<p>b<ul class='related items'><li>no</ul>",
    "<p>a<p><button>no</button>b<select><option>no</select>",
])
def test_anchors_and_styles_hide_nothing(page):
    assert extract.page_text(page) == "a\nb"


def test_controls_stand_in_their_line():
    assert extract.page_text("<p>a <button>b</button> c</p>") == "a c"
    assert extract.page_text("<p>a<svg><path d='M0 0>1'/></svg>b</p>") == "ab"
    assert extract.page_text("<p>a <button>b <select> c") == "a b c"


def test_wrapped_copies_and_common_headings_keep_their_text(spark):
    page = "<body><div class='entry-content'><p class=t>one<p class=t>two</div></body>"
    assert texts_of(spark, [page] * 6) == ["one\ntwo"] * 6
    pages = [f"<body><article><h2 class='sec'>Ingredients</h2><p>text {i}</article></body>" for i in range(6)]
    assert texts_of(spark, pages) == [f"Ingredients\ntext {i}" for i in range(6)]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_small_hosts_have_a_tree(spark, n):
    """One page tells nothing about its site; two do."""
    pages = [f"<body><div class=bar><p>Share this page now</div><div class=c><p>own {i}</p></div></body>" for i in range(n)]
    shared = "Share this page now\n" if n == 1 else ""
    assert texts_of(spark, pages) == [f"{shared}own {i}" for i in range(n)]


BROKEN = [
    "<a " * 300_000, "<div>x" * 170_000, "<a \">\"" * 150_000 + "'", "<svg>" * 200_000, "<p>" * 300_000, "<!--" * 250_000,
    "<" * 1_000_000, "<a '" * 250_000 + ">", "<script>" * 120_000, "<a b=\"" * 140_000, "&amp;" * 200_000, "<li>x" * 200_000,
    "<div class=\"a'\">x</div>" * 40_000, "</div>" * 160_000, "x" * 1_000_000,
]


@pytest.mark.parametrize("number", range(len(BROKEN)))
def test_broken_megabytes_are_read_in_one_pass(number):
    started = time.time()
    extract.page_text(BROKEN[number])
    assert time.time() - started < 20


def test_deep_pages_keep_their_text():
    page = "<div>" * 2000 + "deep <p>text" + "</div>" * 2000 + "<p>end"
    assert extract.page_text(page) == "deep\ntext\nend"


def brute_tree(pages):
    """Importance of each node of one host, computed from the pages' own lists."""
    parsed = [extract.parse(p) for p in pages]
    nodes = {}
    for n, (found, shapes) in enumerate(parsed):
        for block in found:
            for path in block.paths:
                node = nodes.setdefault(path, {"pages": set(), "texts": [], "shapes": []})
                node["pages"].add(n)
                node["texts"].append((n, block.text))
        for path, shape in shapes:
            if path in nodes:
                nodes[path]["shapes"].append(shape)
    out = {}
    for path, node in nodes.items():
        base = math.log(max(2, len(node["pages"])))
        on = {t: len({n for n, u in node["texts"] if u == t}) for _, t in node["texts"]}
        content = sum(1 - math.log(on[t]) / base for _, t in node["texts"]) / len(node["texts"])
        total, shown = len(node["shapes"]), content
        if total:
            shown = min(1.0, -sum(c / total * math.log(c / total) for c in Counter(node["shapes"]).values()) / base)
        out[path] = (len(node["pages"]), 0.8 * content + 0.2 * shown)
    return out


def test_style_tree_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    words = ["menu", "text", "new", "old", "more"]
    part = lambda d: words[rng.integers(5)] + (str(rng.integers(3)) if d else "")

    def made(depth=0):
        if depth > 3 or rng.random() < 0.3:
            return f"<p>{part(1)}</p>"
        return f"<div class={part(0)}>{''.join(made(depth + 1) for _ in range(rng.integers(1, 4)))}{part(1)}</div>"

    pages = [f"<body>{made()}{made()}</body>" for _ in range(12)]
    rows = [(f"https://h.example/{i}", page) for i, page in enumerate(pages)]
    tree = extract.style_tree(spark.createDataFrame(rows, "url string, html string").repartition(4))
    got = {r["path"]: (r["pages"], r["importance"]) for r in tree.collect()}
    want = brute_tree(pages)
    assert set(got) == set(want)
    assert all(got[p][0] == want[p][0] and got[p][1] == pytest.approx(want[p][1], abs=1e-9) for p in want)


def test_the_host_confirms_ambiguous_words(spark):
    got = texts_of(spark, [
        f"<body><div class=menu-open><p>text {i}</p></div><div class=main-menu><p>home</p></div></body>" for i in range(8)
    ])
    assert got == [f"text {i}" for i in range(8)]


def test_whole_groups_join_batches():
    import pyarrow as pa

    parts = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64())], names=["k"]) for x in ([1, 1], [1, 2], [], [2], [3])]
    assert [b.column(0).to_pylist() for b in whole_groups(iter(parts), ["k"])] == [[1, 1, 1], [2, 2], [3]]


def test_pipeline_stages(spark, sample):
    """Every stage against its own input: decisions take effect and columns stay."""
    docs, frames = sample, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        frames.append(docs)
    scored, exact, near, mixed = (pairs_of(f) for f in frames)
    last = {}
    for i, t in scored:
        key = t.translate(LOW)
        last[key] = max(i, last.get(key, i))
    assert Counter(exact) == Counter((i, t) for i, t in scored if last[t.translate(LOW)] == i)
    assert {i for i, _ in near} == {c for _, c in near_brute(exact, 5, 80).values()}
    assert set(mixed) <= set(near) and max(Counter(mixed).values()) <= 2
    own = encoder()
    want = Counter((i, hashlib.sha256(np.array(own.encode_ordinary(t), "<u4").tobytes()).hexdigest()) for i, t in mixed)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in got) == want
    assert re.fullmatch(r"[0-9a-f]{64}", got[0]["decoded_sha256"])
