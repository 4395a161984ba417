"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from llm_fixtures import documents, edge, edge_rows, nothing, small  # noqa: F401
from llm_words import words

from adtally.llm import runs as R
from adtally.llm.queries import op12_periodic_runs


def plain(seq, exponent=4, least=6):
    n, out = len(seq), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if seq[i] != seq[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and seq[i] == seq[i + q]:
                i += 1
            length = i - start + q
            smaller = any(all(seq[start + t] == seq[start + t + p] for t in range(length - p)) for p in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts, **options):
    symbols = [d * 1000 + x for d, seq in enumerate(texts) for x in seq]
    return [tuple(map(int, r)) for r in R.find_runs(np.array(symbols, dtype=np.int64), np.array([len(s) for s in texts]), **options)]


def expected(texts, **options):
    out, base = [], 0
    for seq in texts:
        out += [(s + base, n, q) for s, n, q in plain(seq, **options)]
        base += len(seq)
    return out


def random_text(rng):
    n, alphabet = rng.choice([0, 1, 5, 6, 7, 20, 50, 130]), rng.choice([1, 2, 2, 3, 20])
    seq = [rng.randrange(alphabet) for _ in range(n)]
    if n and rng.random() < 0.6:
        start = rng.randrange(n)
        period = 1 + rng.randrange(max(1, (n - start) // rng.randint(3, 10) + 1))
        for i in range(start, n):
            seq[i] = seq[start + (i - start) % period]
        for _ in range(rng.choice([0, 0, 1, 2])):
            seq[rng.randrange(n)] = rng.randrange(alphabet)
    return seq


def test_random_texts():
    rng = random.Random(1)
    for _ in range(400):
        texts = [random_text(rng) for _ in range(rng.randint(1, 4))]
        assert found(texts) == expected(texts)


def test_nested_repeats():
    """Periods that hold shorter repeats: blocks then occur many times in their window."""
    rng = random.Random(2)
    for _ in range(60):
        seq = [rng.randrange(2)]
        while len(seq) < 200:
            unit = seq[-rng.randint(1, len(seq)):]
            seq = seq + unit * rng.randint(1, 5) + [rng.randrange(2)] * rng.randint(0, 3)
        seq = seq[rng.randrange(20): 240]
        assert found([seq, seq[::-1]]) == expected([seq, seq[::-1]])


def test_other_limits():
    rng = random.Random(4)
    for exponent, least in ((3, 3), (5, 20)):
        for _ in range(100):
            texts = [random_text(rng)]
            assert found(texts, exponent=exponent, least=least) == expected(texts, exponent=exponent, least=least)


def test_long_periods_and_whole_texts():
    unit = list(range(500))
    for seq in ([7] * 3000, unit * 4, unit * 4 + [1], (unit * 5)[3:2400], list(range(900)) + [1, 2] * 300):
        assert found([seq]) == expected([seq])


def digests(text):
    seq = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    listed = plain(seq)
    gone = {i for s, n, q in listed for i in range(s + q, s + n)}
    return listed, " ".join(w for i, w in enumerate(seq) if i not in gone), len(seq)


def test_edge_rows(edge, edge_rows, nothing):
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in R.periodic_runs(edge).collect()), key=repr)
    assert [g for g in got if g[3] < 20_000] == sorted(
        ((d, *digests(t)) for d, t, *_ in edge_rows if len((t or "").split()) < 20_000), key=repr
    )
    assert len(got) == len(edge_rows)
    assert R.periodic_runs(nothing).collect() == []
    assert R.with_repeats(nothing).collect() == []


def test_a_very_long_text(spark):
    text = words(5, 30_000) + " la" * 400 + "\n" + words(6, 20_000) + " " + " ".join([words(7, 900)] * 5)
    row = R.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(r.start, r.length, r.period) for r in row.runs] == [(30_000, 400, 1), (50_400, 4500, 900)]
    assert row.collapsed == " ".join([words(5, 30_000), "la", words(6, 20_000), words(7, 900)])


def repeated(doc_id, text):
    seq = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not seq:
        return text
    n, g = len(seq), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(seq[i] if i < a else seq[a + (i - a) % p] for i in range(n))


def test_query_digests(spark, small, documents, edge, edge_rows):
    texts = {r.doc_id: repeated(r.doc_id, r.text) for r in documents.collect()}
    assert sorted(map(tuple, R.with_repeats(edge).collect()), key=repr) == sorted(
        ((d, repeated(d, t)) for d, t, *_ in edge_rows), key=repr
    )
    seen = 0
    for r in op12_periodic_runs(spark, small).collect():
        if len((texts[r.doc_id] or "").split()) > 1000:
            continue
        listed, collapsed, _ = digests(texts[r.doc_id])
        best = min(listed, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if listed else None
        seen += bool(listed)
        assert r.n_runs == len(listed)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in listed).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
    assert seen > 5
