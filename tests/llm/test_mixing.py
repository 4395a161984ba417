"""Mixing against the rules of its contract, and the flight against its invariants."""

import random
import re

import pytest

from llm_fixtures import documents, edge, edge_rows, nothing, small  # noqa: F401

from adtally.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Reshare by weight until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s] + 1e-9]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def check_plan(rows, result, slack):
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    wanted = plain_targets(sizes)
    taken: dict = {}
    for r in result:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(result) == len(rows)
    for s, n in taken.items():
        assert abs(n - wanted[s]) <= slack(s)


def test_documents(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    largest: dict = {}
    for _, t, s in rows:
        largest[s] = max(largest.get(s, 0), len(WORD.findall(t or "")))
    one = mixing.plan(documents).collect()
    check_plan(rows, one, lambda s: largest[s] / 2 + 1)
    again = mixing.plan(documents.repartition(7)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))


def test_many_blocks_come_near(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    blocks = mixing.plan(documents, block_rows=3).collect()
    largest = max(len(WORD.findall(t or "")) for _, t, _ in rows)
    check_plan(rows, blocks, lambda s: largest / 2 + 1)


def test_edges(edge, edge_rows, nothing):
    plan = mixing.plan(edge).collect()
    check_plan([(r[0], r[1], r[3]) for r in edge_rows], plan, lambda s: 1e9)
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns
    assert mixed.count() == sum(r.copies for r in plan)
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in edge.collect()}
    assert mixing.plan(nothing).collect() == [] and mixing.mix(nothing).collect() == []


def test_flight_keeps_totals():
    rng = random.Random(3)
    rows = sorted((rng.randint(0, 900), rng.random(), rng.random()) for _ in range(500))[::-1]
    flight, ends = mixing.Flight(), {}
    for i, (size, pi, draw) in enumerate(rows):
        ends |= dict(flight.add(pi, size, i))
    moving = {u[2]: u[0] for u in flight.moving}
    assert len(moving) <= 2 and set(ends.values()) <= {0, 1}
    now = ends | moving
    assert sum(now[i] * s for i, (s, _, _) in enumerate(rows)) == pytest.approx(sum(p * s for s, p, _ in rows))
    assert sum(now.values()) == pytest.approx(sum(p for _, p, _ in rows))


def test_flight_keeps_probabilities():
    sizes, pis = [50, 40, 40, 30, 10, 5], [0.2, 0.5, 0.9, 0.4, 0.5, 0.3]
    hits, n = [0] * 6, 4000
    rng = random.Random(11)
    for _ in range(n):
        flight, ends = mixing.Flight(rng.random()), {}
        for i, (s, p) in enumerate(zip(sizes, pis)):
            ends |= dict(flight.add(p, s, i))
        for u in flight.moving:
            ends[u[2]] = u[0]
        hits = [h + ends[i] for i, h in enumerate(hits)]
    assert all(abs(h / n - p) < 0.03 for h, p in zip(hits, pis))
