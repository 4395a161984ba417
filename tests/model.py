"""Plain Python answers for small inputs, written from the definitions."""

from __future__ import annotations

from collections import Counter


def first_writes(rows):
    """``rows`` are (seq, kind, bid_id, campaign, minute)."""
    seen = {}
    for row in sorted(rows):
        seen.setdefault((row[1], row[2]), row)
    bids = {r[2]: r for (kind, _), r in seen.items() if kind == "bid"}
    imps = {r[2]: r for (kind, _), r in seen.items() if kind == "impression"}
    return bids, imps


def ledger(rows):
    """Replay the records one by one; (seq, campaign, minute, b, d, u) as a multiset."""
    out, bids, marks, billed = Counter(), {}, {}, set()
    for seq, kind, bid_id, campaign, minute in sorted(rows):
        if kind == "bid":
            if bid_id in bids:
                continue
            bids[bid_id] = campaign
            out[(seq, campaign, minute, 1, 0, 0)] += 1
            if bid_id in marks:
                at = marks.pop(bid_id)
                out[(seq, "UNKNOWN", at, 0, 0, -1)] += 1
                out[(seq, campaign, at, 0, 1, 0)] += 1
        elif bid_id not in billed:
            billed.add(bid_id)
            if bid_id in bids:
                out[(seq, bids[bid_id], minute, 0, 1, 0)] += 1
            else:
                marks[bid_id] = minute
                out[(seq, "UNKNOWN", minute, 0, 0, 1)] += 1
    return out


def minutes(rows):
    """(campaign, minute) -> counters, all-zero ones left out."""
    totals = {}
    for (_, campaign, minute, b, d, u), n in ledger(rows).items():
        old = totals.get((campaign, minute), (0, 0, 0))
        totals[(campaign, minute)] = (old[0] + n * b, old[1] + n * d, old[2] + n * u)
    return {k: v for k, v in totals.items() if any(v)}


def greedy(times, width):
    """Accepted positions of (time, order) pairs."""
    accepted, last = set(), None
    for when, order in sorted(times):
        if last is None or when >= last + width:
            accepted.add(order)
            last = when
    return accepted


def longest_gap(points):
    """``points`` are (micros, responded): stage ends count as points."""
    start, end = min(p for p, _ in points), max(p for p, _ in points)
    marks = sorted([start, end] + [p for p, ok in points if ok])
    return max((b - a for a, b in zip(marks, marks[1:])), default=0)
