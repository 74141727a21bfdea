"""Rows with every odd case, and the small tables."""

import pytest

D = "/root/testdata/sf0.001"
BASE = " ".join(f"word{i % 37}x{i}" for i in range(120))
LONG = " ".join(f"l{i}" for i in range(60_000))
ODD = [
    (1, None, "a"), (2, "", None), (3, "  \n\t ", "a"), (4, "one two", "b"), (5, "one two", "b"), (5, "one two", "b"), (None, "one two", "b"),
    (6, BASE, "a"), (7, BASE.replace("word5x5", "zzz"), "a"), (8, BASE.upper(), None), (9, "x " * 3000, "c"), (10, LONG, "c"), (11, LONG[:-3] + " ünï 漢字 💡", "c"),
    (12, "aaaa" * 200, "a"), (13, BASE + "\n" + BASE, "a"), (14, "Same line of words here in this text again now\nSame line of words there in this text again now\n\nshort", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "k", None) for r in ODD], "doc_id long, text string, source string, n long, key string, node string").cache()


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet")
