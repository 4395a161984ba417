from __future__ import annotations

import os

import pytest
from llm_words import words

SMALL = "/root/testdata/sf0.001"

WIDE = "doc_id long, text string, lang string, source string, n_chars long, ids string, size int, n_lines int, __row int, cid string"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, odd white space, signs of many scripts."""
    base = words(1, 120)
    near = " ".join(base.split()[:-2] + ["other", "end"])
    passage = words(2, 70)
    texts = [
        (1, base), (1, base), (2, near), (3, None), (4, ""), (5, " \t\n\x0b "), (None, words(3, 60)), (None, None),
        (6, f"{words(4, 30)}\n{passage}\n{words(5, 30)}"), (7, f"{words(6, 20)}\n{passage}\n\n{words(7, 12)}"),
        (8, "a b c"), (9, "A B C"), (10, words(8, 60) + "    x y \x1c z\x85"),
        (11, "don't 'tis Été 日本語 \U0001f642 é İI <|endoftext|> ~ a~b 12３"),
        (12, words(9, 40_000)), (13, "x" * 100_000), (14, "\n".join([words(10, 4)] * 300)), (15, base.upper()),
        (16, "spam spam spam " * 40), (17, "### *** " * 60), (2, words(11, 55)),
    ]
    sources = ["b", "a", None, "c", "é", ""]
    return [
        (d, t, None if i % 5 == 0 else "en", sources[i % len(sources)], None if t is None else len(t), "ids", i, None, i, "x")
        for i, (d, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, WIDE).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], WIDE)


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("tables not present")
    return SMALL


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
