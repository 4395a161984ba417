"""Ranked search against scoring every document, and how little of a shard it visits."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import edge, edge_rows, nothing  # noqa: F401

from adtally.llm import ranked as R

TERM = re.compile(R.TERM)
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def plain(docs, queries, k=10):
    """(item, rank, doc, score) by the formula."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    items: dict = {}
    for item, text in queries:
        items.setdefault(item, set()).update(terms(text))
    out = []
    for item, asked in items.items():
        scored = []
        for d, c in counted:
            norm = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * norm))
                for t in asked if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def answers(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard_terms, block_bytes", [(1 << 21, 1 << 18), (300, 40)])
def test_edge_rows(spark, edge, edge_rows, shard_terms, block_bytes):
    docs = [(d, t) for d, t, *_ in edge_rows]
    queries = [(n, t) for n, (_, t) in enumerate(docs) if t is None or len(t) < 2000]
    queries += [(1, "spam A b"), (None, "spam c"), (None, "x y"), (70, ""), (71, "!! ??"), (72, "nowhere12")]
    asked = spark.createDataFrame([(i, t, 1, "z") for i, t in queries], "item_id long, text string, shard long, term string")
    index = R.build_index(edge, shard_terms)
    assert answers(R.search(index, asked, block_bytes=block_bytes)) == plain(docs, queries)


def test_empty_tables(spark, edge, nothing):
    asked = spark.createDataFrame([(1, "spam")], "item_id long, text string")
    assert R.search(R.build_index(nothing), asked).collect() == []
    got = R.search(R.build_index(edge), asked.where("false"))
    assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]
    textless = spark.createDataFrame([(1, None), (2, " .,- ")], "doc_id long, text string")
    assert R.search(R.build_index(textless), asked).collect() == []


def test_random_corpora(spark):
    """Few words and many copies: ties everywhere, also across shards."""
    rng = random.Random(7)
    docs = [(rng.randrange(400), " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 2, 3, 8, 40])))) for _ in range(500)]
    docs += [(1000 + n, "a b c") for n in range(40)]
    queries = [(n, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))) for n in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    for shard_terms in (1 << 21, 500):
        assert answers(R.search(R.build_index(frame, shard_terms), asked)) == plain(docs, queries)
    assert answers(R.search(R.build_index(frame), asked, k=3)) == plain(docs, queries, 3)


def shard_of(n_docs, seed=1):
    """Posting lists of random documents over words of very different frequency."""
    rng = np.random.default_rng(seed)
    n_words = 300
    chance = 0.6 / np.arange(1, n_words + 1) ** 0.9
    length = rng.integers(20, 400, n_docs)
    order = np.argsort(length, kind="stable")
    length = length[order]
    docs, counts, bounds = [], [], [0]
    for p in chance:
        hit = np.flatnonzero(rng.random(n_docs) < p)
        docs.append(hit)
        counts.append(1 + rng.poisson(p * length[hit] / 40))
        bounds.append(bounds[-1] + len(hit))
    docs, counts = np.concatenate(docs), np.concatenate(counts)
    return R.Lists(docs, R.impacts(counts, length[docs], n_docs, int(length.sum())), np.array(bounds), n_docs), bounds


def test_intervals_are_skipped():
    """The search of a production-sized shard visits a part of its documents, and misses none."""
    n_docs = 5000
    built, bounds = shard_of(n_docs)
    rng = np.random.default_rng(5)
    df = np.diff(bounds)
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    tie = np.arange(n_docs)
    shares = []
    for _ in range(30):
        asked = np.sort(rng.choice(len(df), 12, replace=False))
        scores = np.zeros(n_docs, dtype=np.int64)
        for t in asked:
            part = slice(bounds[t], bounds[t + 1])
            scores[built.docs[part]] += weight[t] * built.impacts[part]
        best = np.lexsort((tie, -scores))[:10]
        visited: list = []
        docs, points = built.best(asked, weight[asked], 10, tie, visited)
        assert docs.tolist() == best.tolist() and points.tolist() == scores[best].tolist()
        shares.append(sum(visited) / n_docs)
    assert np.mean(shares) < 0.5


def test_greatest_of_every_range():
    rng = np.random.default_rng(2)
    impacts = rng.integers(0, 9, 60)
    built = R.Lists(np.arange(60), impacts, np.array([0, 60]), 60)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(61), np.arange(61)))
    at, some = built.greatest(a, b)
    assert (some == (b > a)).all()
    for i, j, place in zip(a[some], b[some], at[some]):
        assert i <= place < j and impacts[place] == impacts[i:j].max()
