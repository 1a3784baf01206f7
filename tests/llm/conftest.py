from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, block long, rep long, id long, label int"
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}" for i in range(40_000))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, control strings."""
    shared = "the same passage of more than one hundred bytes " * 4
    rows = [
        (1, "A first text.\nWith two lines, é and 中文 too."), (2, "a FIRST text.\nwith two lines, é and 中文 too."),
        (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "one two"), (8, LONG), (9, LONG + " more"),
        (10, shared + "end"), (11, "start " + shared), (12, shared), (12, shared), (None, shared), (None, None),
        (13, "x y z \u0000 \U0001f600"), (14, "ÀÉ <|im_start|> <\\| İ"),
    ]
    return [(i, t, None, None if n % 5 == 0 else f"s{n % 3}", 1, 1, 2, 3, 4, 5) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
