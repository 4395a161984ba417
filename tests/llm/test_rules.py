"""Quality rules against plain counting, and the learner on rules it should find."""

import random
import re
from collections import Counter

from llm_fixtures import documents, edge, edge_rows, nothing, small  # noqa: F401

from adtally.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    found = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if found[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_statistics(spark, edge, edge_rows, nothing):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (99, 0)], "doc_id long, quality int")
    got = rules.score(edge, labels).select("doc_id", *rules.BASE, "base_failed", "kept").collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    want = [(d, *plain(t), not plain(t)[-1]) for d, t, *_ in edge_rows]  # labels of one kind: no rules
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert rules.score(nothing, labels).collect() == []
    kept = rules.keep_good(edge, labels)
    assert kept.columns == edge.columns
    assert sorted(r.size for r in kept.collect()) == sorted(r[6] for r in edge_rows if not plain(r[1])[-1])


def made(n, seed):
    """Base statistics: bad ones have many symbols, or short words in long texts."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = rng.randint(60, 900)
        kind = rng.random()
        mean = rng.uniform(4.5, 6)
        symbols = rng.randint(0, words // 20)
        if kind < 0.15:
            symbols = rng.randint(words // 2, words)
        elif kind < 0.3:
            mean, words = rng.uniform(2, 3), rng.randint(700, 900)
        rows.append((i, words, int(words * mean), symbols, 0, rng.randint(0, words // 10)))
        labels.append((i, int(kind >= 0.3)))
    return rows, labels


def test_learner_finds_the_rules(spark):
    rows, labels = made(900, 1)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    statistics = spark.createDataFrame(rows, schema)
    found = rules.learn(statistics, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert 1 <= len(found) <= rules.MAX_RULES
    assert found == rules.learn(statistics.repartition(5), spark.createDataFrame(labels[::-1], "doc_id long, quality int"))
    rows, labels = made(500, 2)
    judged = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(rows, schema), found).collect()}
    assert sum(judged[i] == bool(q) for i, q in labels) >= 0.97 * len(labels)


def test_documents(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = {r.doc_id: r for r in rules.score(documents, labels).collect()}
    for doc_id, text in ((r.doc_id, r.text) for r in documents.collect()):
        assert tuple(judged[doc_id])[1:7] == plain(text)
    marked = [(r.quality, judged[r.doc_id].kept) for r in labels.collect() if r.doc_id in judged and not judged[r.doc_id].base_failed]
    assert sum(k for q, k in marked if q) >= 0.95 * sum(q for q, _ in marked)
