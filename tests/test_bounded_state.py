"""Keyed state that expires: bounded rows, and the same ledger as with state for good."""

import random
from datetime import timedelta

import model
import pytest
from conftest import CHANGES, utc

from adtally.sources.topics import file_stream
from adtally.streaming import projector
from adtally.streaming import store as S

T0 = utc(2024, 1, 1)
DAY = timedelta(days=1)


def rows_as_changes(rows):
    """Rows ``(hour, kind, bid_id, campaign)``: seq and arrival are the hour, the event is at that minute."""
    return [(h, kind, i, c, T0 + timedelta(minutes=h), T0 + timedelta(hours=h)) for h, kind, i, c in rows]


def as_model(rows):
    return [(h, kind, i, c, h) for h, kind, i, c in rows]


def ledger_of(store):
    out = {}
    for r in store.read(S.LEDGER).collect():
        minute = (r.event_ts - T0.replace(tzinfo=None)) // timedelta(minutes=1)
        key = (r.seq, r.campaign_id, minute, r.bid_requests, r.deduped_impressions, r.unknown_impressions)
        out[key] = out.get(key, 0) + 1
    return out


@pytest.fixture
def projected(spark, tmp_path):
    def run(batches, tick=DAY, **options):
        for rows in batches:
            spark.createDataFrame(rows_as_changes(rows), CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], CHANGES).schema, 1)
        query = projector.start(stream, str(tmp_path / "out"), str(tmp_path / "state"), **options)
        query.awaitTermination()
        rows = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
        return S.BatchStore(spark, str(tmp_path / "out")), rows

    return run


def random_log(seed, days, per_day):
    """Bids and impressions of new ids, some of which come back days or weeks later."""
    rng, seen, rows = random.Random(seed), [], []
    for hour in range(days * 24):
        for _ in range(per_day // 24):
            old = seen and rng.random() < 0.3
            bid_id = rng.choice(seen) if old else f"n{len(seen)}"
            if not old:
                seen.append(bid_id)
            kind = rng.choice(["bid", "impression"])
            rows.append((hour, kind, bid_id, rng.choice(["c1", "c2"]) if kind == "bid" else None))
    # one record an hour and id, so seq orders them
    return list({(h, i): (h, k, i, c) for h, k, i, c in rows}.values())


def test_sixty_days_keep_the_state_bounded_and_the_dedup_exact(projected):
    rows = random_log(1, 60, 48)
    batches = [[r for r in rows if r[0] // 24 // 5 == n] for n in range(12)]
    store, state = projected(batches, keep=5 * DAY, late=DAY, compact_every=4)
    assert ledger_of(store) == model.ledger(as_model(rows))
    per_batch = max(len({i for _, _, i, _ in b}) for b in batches)
    # two windows of ten days: at most the ids of three batches of five days, twice
    assert max(state) <= 2 * 3 * per_batch
    assert state[-1] <= max(state[2:6]) * 1.5
    assert len({i for _, _, i, _ in rows}) > max(state[6:]) / 2


def test_records_on_both_sides_of_a_window_edge(projected):
    """Windows of four days begin every two: pairs and repeats across each edge, in one batch and in two."""
    edge = 24 * 2
    pairs = []
    for n, (first, second) in enumerate([("bid", "impression"), ("impression", "bid"), ("bid", "bid")]):
        for k in (0, 1, 2):
            at = edge * (k + 1)
            pairs += [(at - 1, first, f"p{n}{k}", "c1"), (at + 1, second, f"p{n}{k}", "c2"), (at + 3 * edge, first, f"p{n}{k}", "c1")]
    rows = sorted(((h, k, i, c if k == "bid" else None) for h, k, i, c in pairs), key=lambda r: (r[0], r[2]))
    whole, _ = projected([rows], keep=2 * DAY, late=DAY)
    assert ledger_of(whole) == model.ledger(as_model(rows))


def test_edges_between_batches(projected):
    rows = [
        (47, "impression", "a", None), (47, "bid", "b", "c1"), (47, "bid", "d", "c1"),
        (49, "bid", "a", "c1"), (49, "impression", "b", None), (49, "bid", "d", "c2"),
        (300, "bid", "a", "c2"), (300, "impression", "d", None), (301, "impression", "b", None), (302, "impression", "e", None),
        (700, "bid", "e", "c1"), (701, "bid", "e", "c2"), (701, "impression", "d", None),
    ]
    batches = [[r for r in rows if r[0] < 48], [r for r in rows if 48 <= r[0] < 100], [r for r in rows if 100 <= r[0] < 500], [r for r in rows if r[0] > 500]]
    store, _ = projected(batches, keep=2 * DAY, late=DAY)
    assert ledger_of(store) == model.ledger(as_model(rows))


def test_a_topic_that_lags_behind_the_other(projected):
    """The bid arrived before the window edge but is read a batch after its impression, which arrived behind the edge."""
    first = [(49, "impression", "a", None), (50, "impression", "x", None)]
    second = [(47, "bid", "a", "c1"), (46, "bid", "x", "c2")]
    store, _ = projected([first, second], keep=2 * DAY, late=5 * DAY)
    got = ledger_of(store)
    assert got == {
        (49, "UNKNOWN", 49, 0, 0, 1): 1, (50, "UNKNOWN", 50, 0, 0, 1): 1,
        (47, "c1", 47, 1, 0, 0): 1, (47, "UNKNOWN", 49, 0, 0, -1): 1, (47, "c1", 49, 0, 1, 0): 1,
        (46, "c2", 46, 1, 0, 0): 1, (46, "UNKNOWN", 50, 0, 0, -1): 1, (46, "c2", 50, 0, 1, 0): 1,
    }


def test_facts_are_written_once_with_bounded_state(projected, spark):
    rows = [(1, "bid", "a", "c1"), (2, "impression", "a", None), (400, "bid", "a", "c2"), (401, "impression", "b", None), (900, "bid", "b", "c1")]
    full = [(*r, "r", "u", "p", "{}") for r in rows_as_changes(rows)]
    schema = CHANGES + ", request_id STRING, user_idfv STRING, placement_id STRING, raw_json STRING"
    import tempfile

    base = tempfile.mkdtemp(prefix="run-facts-")
    for part in (full[:2], full[2:4], full[4:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = file_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema, 1)
    store = projector.run_to_end(stream, f"{base}/out", f"{base}/state", with_facts=True, keep=2 * DAY, late=DAY)
    assert sorted((r.bid_id, r.campaign_id) for r in store.read(S.BID_FACTS).collect()) == [("a", "c1"), ("b", "c1")]
    assert sorted(r.bid_id for r in store.read(S.IMPRESSION_FACTS).collect()) == ["a", "b"]
    assert store.read(S.CHANGE_LOG).count() == 4
