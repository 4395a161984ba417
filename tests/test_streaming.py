"""The projection stream against the record-by-record replay, over any batch split."""

from datetime import timedelta

import model
import pytest
from conftest import utc
from hypothesis import HealthCheck, given, settings
from test_lifecycle import LATE_BID, LATE_BID_LEDGER, as_counter, as_minutes, records

from adtally.operators import decode
from adtally.plans import metrics, rollup
from adtally.plans.serving import Serving
from adtally.schemas import BID_TOPIC, IMPRESSION_TOPIC, RECORD
from adtally.sources.topics import file_stream
from adtally.streaming import projector
from adtally.streaming import store as S
from adtally.streaming.windows import accepted_so_far, dedup_within, finalise_stream, suppress_into

CHANGES = "seq BIGINT, kind STRING, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP, arrival_ts TIMESTAMP"


@pytest.fixture
def stream_of(spark, changes_of, tmp_path_factory):
    """Each list of rows becomes one file and one micro-batch."""

    def project(batches, **options):
        base = str(tmp_path_factory.mktemp("stream"))
        for rows in batches:
            changes_of(rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = file_stream(spark, f"{base}/in", changes_of(LATE_BID).schema, files_per_trigger=1)
        return projector.run_to_end(stream, f"{base}/out", f"{base}/state", **options), base

    return project


@pytest.mark.parametrize("split", [[2, 4], [6], [1, 2, 3, 4, 5]])
def test_late_bid_over_any_split(stream_of, split):
    edges = [0, *[s for s in split if s < 6], 6]
    store, _ = stream_of([LATE_BID[a:b] for a, b in zip(edges, edges[1:])])
    assert as_counter(store.read(S.LEDGER)) == LATE_BID_LEDGER
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID)


@given(records)
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
def test_stream_equals_replay(stream_of, rows):
    thirds = [rows[: len(rows) // 3], rows[len(rows) // 3 : len(rows) // 2], rows[len(rows) // 2 :]]
    batches = [b for b in thirds if b]
    if not batches:
        return
    store, _ = stream_of(batches)
    assert as_counter(store.read(S.LEDGER)) == model.ledger(rows)
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)


def test_restart_continues_and_a_replayed_batch_changes_nothing(spark, changes_of, tmp_path):
    source, root, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def feed(rows):
        changes_of(rows).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = file_stream(spark, source, changes_of(LATE_BID).schema, files_per_trigger=1)
        return projector.run_to_end(stream, root, state)

    feed(LATE_BID[:2])
    store = run()
    assert store.last_complete() == 0
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID[:2])
    feed(LATE_BID[2:4])
    feed(LATE_BID[4:])
    store = run()
    assert as_counter(store.read(S.LEDGER)) == LATE_BID_LEDGER

    # A crash after the sink wrote but before the commit: the batch runs again.
    for marker in (tmp_path / "state" / "commits").glob("*2*"):
        marker.unlink()
    store = run()
    assert as_counter(store.read(S.LEDGER)) == LATE_BID_LEDGER
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID)
    assert run().last_complete() == 2


def test_compaction_changes_no_answer(stream_of):
    rows = LATE_BID + [(7, "bid", "z", "c1", 70), (8, "impression", "z", None, 75)]
    store, _ = stream_of([rows[:2], rows[2:5], rows[5:]], compact_every=2)
    assert store.compacted_upto() == 1
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)
    assert store.compact() == 2 == store.compact()
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)
    assert (store.vacuum(), store.vacuum()) == (2, 0)
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)


def test_incomplete_batches_are_not_read(stream_of):
    import pathlib

    store, base = stream_of([LATE_BID[:2], LATE_BID[2:]])
    for marker in pathlib.Path(base, "out", S.PROGRESS, "batch_id=1").glob("*_SUCCESS*"):
        marker.unlink()
    assert store.last_complete() == 0
    assert as_minutes(store.minute_campaign()) == model.minutes(LATE_BID[:2])


def test_empty_store_answers_zero(spark, tmp_path):
    store = S.BatchStore(spark, str(tmp_path / "none"))
    assert store.minute_campaign().count() == 0
    assert store.freshness().first().last_projected_at is None


def test_raw_records_to_facts_rollups_and_answers(spark, tmp_path):
    """Requests of the end-to-end check: +3 bids, +3 impressions, 2 matched, 1 unknown."""
    at = utc(2024, 6, 1, 12)
    epoch = int(at.timestamp())

    def bid(bid_id, campaign):
        return (
            f'{{"request_id":"r","bid_id":"{bid_id}","user_idfv":"u","campaign_id":"{campaign}",'
            f'"placement_id":"p","timestamp":{epoch}}}'
        )

    def imp(bid_id):
        return f'{{"bid_id":"{bid_id}","campaign_id":"","user_idfv":"","timestamp":{epoch + 60}}}'

    values = [
        (BID_TOPIC, bid("a", "campaign1")),
        (IMPRESSION_TOPIC, imp("b")),
        (BID_TOPIC, bid("b", "campaign2")),
        (BID_TOPIC, bid("c", "campaign_default")),
        (IMPRESSION_TOPIC, imp("a")),
        (IMPRESSION_TOPIC, imp("a")),
        (IMPRESSION_TOPIC, imp("random")),
        (IMPRESSION_TOPIC, '{"timestamp":1}'),
        (IMPRESSION_TOPIC, '{"bid_id":"broken"'),
    ]
    rows = [(topic, 0, n, n, None, value, at) for n, (topic, value) in enumerate(values)]
    for part in (rows[:2], rows[2:6], rows[6:]):
        spark.createDataFrame(part, RECORD).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    changes = decode.changes(decode.decode(stream))
    store = projector.run_to_end(changes, str(tmp_path / "out"), str(tmp_path / "state"), with_facts=True)

    bids, imps = store.read(S.BID_FACTS), store.read(S.IMPRESSION_FACTS)
    assert (bids.count(), imps.count()) == (3, 3)
    assert {r.event_type for r in store.read(S.CHANGE_LOG).collect()} == {"bid_seen", "impression_seen"}
    assert store.read(S.CHANGE_LOG).count() == 6
    assert bids.where("bid_id = 'a'").first().raw_json == values[0][1]

    minutes = store.minute_campaign()
    answers = Serving(None, minutes, at - timedelta(days=1), freshness=store.freshness())
    row = answers.summary(at, at + timedelta(hours=1)).first()
    assert (row.source, row.bid_requests, row.deduped_impressions, row.unknown_impressions) == ("rollup", 3, 2, 1)
    assert row.last_projected_at is not None
    campaigns = {r.campaign_id: tuple(r)[1:4] for r in answers.by_campaign(at, at + timedelta(hours=1)).collect()}
    assert campaigns == {
        "campaign1": (1, 1, 0),
        "campaign2": (1, 1, 0),
        "campaign_default": (1, 0, 0),
        "UNKNOWN": (0, 0, 1),
    }
    # Rebuilt from facts, and replayed from the change log: the same minutes.
    rebuilt = rollup.rebuild(bids, imps, at + timedelta(days=1))
    assert as_minutes(rebuilt) == as_minutes(minutes)
    from adtally.operators.lifecycle import deltas, lifecycle

    replayed = rollup.minute_campaign(deltas(lifecycle(decode.changes_from_log(store.read(S.CHANGE_LOG)))))
    assert as_minutes(replayed) == as_minutes(minutes)


def test_remember_in_the_stream(spark, tmp_path):
    day, t0 = timedelta(days=1), utc(2024, 1, 1)
    rows = [
        (1, "bid", "a", "c", t0, t0),
        (2, "impression", "b", None, t0, t0),
        (3, "impression", "a", None, t0, t0 + 40 * day),
        (4, "bid", "b", "c", t0, t0 + 40 * day),
        (5, "bid", "a", "c", t0, t0 + 80 * day),
    ]
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], CHANGES).schema, 1)
    store = projector.run_to_end(stream, str(tmp_path / "o"), str(tmp_path / "s"), remember=31 * day)
    assert list(metrics.totals(store.read(S.LEDGER)).first()) == [2, 0, 2]


def test_suppression_stream(spark, tmp_path):
    t0 = utc(2024, 1, 1)
    hours = [0, 10, 23, 24, 30, 47, 48, 49]
    rows = [("a", n, t0 + timedelta(hours=h)) for n, h in enumerate(hours)] + [("b", 50, t0)]
    schema = "bid_id STRING, seq BIGINT, arrival_ts TIMESTAMP"
    for part in (rows[:3], rows[3:5], rows[5:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, 1)
    root, state = str(tmp_path / "out"), str(tmp_path / "state")
    suppress_into(stream, root, state).awaitTermination()
    got = accepted_so_far(spark, root).collect()
    assert len({r.batch for r in got}) > 1
    assert {(r.bid_id, r.seq) for r in got} == {("a", 0), ("a", 3), ("a", 6), ("b", 50)}
    assert {r.arrival_ts.hour for r in got} == {0}


def test_finalise_stream_says_each_answer_once(spark, tmp_path):
    """Unknown comes out only after the wait has passed; late bids no longer change it."""
    t0, minute = utc(2024, 1, 1), timedelta(minutes=1)
    schema = "kind STRING, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP"
    batches = [
        [("impression", "early", None, t0), ("impression", "never", None, t0), ("bid", "ok", "c", t0)],
        [("bid", "early", "c", t0 + 5 * minute), ("impression", "ok", None, t0 + 6 * minute), ("impression", "ok", None, t0 + 6 * minute)],
        [("bid", "clock", "c", t0 + 300 * minute), ("impression", "clock", None, t0 + 300 * minute)],
        # The watermark of a batch applies from the next one on.
        [("bid", "clock1", "c", t0 + 301 * minute), ("impression", "clock1", None, t0 + 301 * minute)],
        [("bid", "never", "c", t0 + 1 * minute), ("bid", "clock2", "c", t0 + 600 * minute), ("impression", "clock2", None, t0 + 600 * minute)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, 1)
    keep = timedelta(minutes=10)
    bids = dedup_within(stream.where("kind = 'bid'"), keep)
    imps = dedup_within(stream.where("kind = 'impression'"), keep)
    answers = finalise_stream(bids, imps, timedelta(minutes=30), timedelta(hours=1))
    (
        answers.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
        .awaitTermination()
    )
    got = [(r.bid_id, r.campaign_id, r.outcome) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(g for g in got if not g[0].startswith("clock")) == [
        ("early", "c", "matched"),
        ("never", "UNKNOWN", "unknown"),
        ("ok", "c", "matched"),
    ]


def test_the_streaming_fold_combines_before_its_shuffle(changes_of):
    """The plan of one micro-batch: one exchange by id, with a partial minimum below it."""
    plan = projector.touched_lives(changes_of(LATE_BID))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bid_id") == 1
    below = plan.split("Exchange hashpartitioning(bid_id")[1]
    assert "partial_min" in below


def test_one_id_with_most_records_of_a_stream(stream_of):
    rows = [(n, "bid" if n % 2 else "impression", "hot" if n % 3 else f"k{n}", "c" if n % 2 else None, n % 90) for n in range(600)]
    store, _ = stream_of([rows[:250], rows[250:]])
    assert as_counter(store.read(S.LEDGER)) == model.ledger(rows)
    assert as_minutes(store.minute_campaign()) == model.minutes(rows)
