"""Personal data: plain patterns in Python against the Spark expressions."""

from __future__ import annotations

import hashlib
import re
import time

from eventloom.llm import pii

ROW = "doc_id long, text string, pii string, found string, Whole_Text string"


def luhn(digits):
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_brute(text):
    """The contract's spans: leftmost matches of the plain patterns, checked."""
    def digits(s):
        return re.sub("[^0-9]", "", s)

    passes = {
        "email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 9 <= len(digits(s)) <= 15,
    }
    return [
        (kind.name, m.start(), m.end()) for kind in pii.KINDS if kind.name in passes
        for m in re.finditer(kind.plain, text or "") if passes[kind.name](m.group())
    ]


def spans(df):
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii"]] for r in pii.find_pii(df).collect()}


NASTY = [
    "mail a.b@c.de_x@y.org, +1 (743) 555-3824, 1.2.3.4.5.6.7.8 and 300.1.1.1 000001.2.3.255 0000000000000000000001.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 and 12 4111 1111 1111 1111", "@a.b a@b a@b. a@-.- %@x.y.z..w",
    "+1+2 345 678 90 () +12345678 +1234567890123456 +1 2", "é😀 a@b.c 😀 1.1.1.1 中文 +49 (0)30 123456", "1.2.3 1.2.3. 1..2.3.4", "",
    None, "a@b.c@d.e@f.g", "\u0000 x@y.z \u0000",
]


def test_base_spans_equal_plain_patterns(spark, sample):
    made = spark.createDataFrame([(i, t, "p", "f", "w") for i, t in enumerate(NASTY)], ROW).repartition(3)
    for df in (made, sample):
        got = spans(df)
        for r in df.collect():
            want = base_brute(r["text"])
            assert [s for s in got[r["doc_id"]] if s[0] in pii.BASE] == want, r["text"][:200]
    digest = {r["doc_id"]: r for r in pii.pii_digest(pii.find_pii(sample)).collect()}
    for r in sample.collect():
        want, row = base_brute(r["text"]), digest[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]


def test_added_kinds_need_check_or_context(spark):
    texts = {
        "pay to GB82 WEST 1234 5698 7654 32 THE bank": [("iban", 7, 34)],
        "DE89370400440532013000, DE89370400440532013001": [("iban", 0, 22)],
        "xDE89370400440532013000 DE89370400440532013000x": [],
        "call 743-555-3824 now": [("local_phone", 5, 17)], "number 743-555-3824 now": [], "phone 1743-555-38245": [],
        "his SSN is 123-45-6789.": [("ssn", 11, 22)], "see 123-45-6789": [], "ssn 000-45-6789 666-45-6789": [],
        "+1 (743) 555-3824 call": [("phone", 0, 17)],
    }
    got = spans(spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], ROW))
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_context_moves_the_score(spark):
    df = spark.createDataFrame([(1, "card 4111111111111111", "", "", ""), (2, "pear 4111111111111111", "", "", "")], ROW)
    score = {r["doc_id"]: r["pii"][0] for r in pii.find_pii(df).collect()}
    assert score[1]["score"] > score[2]["score"] and score[1]["text"] == "4111111111111111"


def test_rows_pass_through(edge, empty, edge_rows):
    found = pii.find_pii(edge, into="spans")
    assert found.columns == [*edge.columns, "spans"]
    assert sorted(map(str, found.drop("spans").collect())) == sorted(map(str, edge.collect()))
    assert pii.pii_digest(pii.find_pii(empty)).count() == 0


def test_long_runs_are_linear(spark):
    n = 200_000
    rows = ["9" * n, "a." * n + "@", "1 " * n, "+1" + "(" * n, "a@b" + ".c" * n, "a" * n, "A1" * n, "1.2.3.4 " * n, "é a@b.c " * n]
    started = time.time()
    got = spans(spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(rows)], ROW).repartition(9))
    assert time.time() - started < 60
    assert [len(got[i]) for i in range(9)] == [0, 0, 0, 0, 1, 0, 0, n, n]
    assert got[8][-1] == ("email", 8 * (n - 1) + 2, 8 * (n - 1) + 7)


def test_stays_in_the_jvm(sample):
    plan = pii.pii_digest(pii.find_pii(sample))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
