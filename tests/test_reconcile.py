import pytest

from adtally.operators import reconcile

OFFSETS = "topic STRING, partition INT, earliest BIGINT, latest BIGINT"


def test_topic_counts_skip_negative_spans(spark):
    rows = [("bid-requests", 0, 5, 10), ("bid-requests", 1, 7, 3), ("impressions", 0, 0, 20000)]
    counts = reconcile.topic_counts(spark.createDataFrame(rows, OFFSETS))
    assert {r.topic: r.messages for r in counts.collect()} == {"bid-requests": 5, "impressions": 20000}
    status = {r.topic: (r.threshold, r.status) for r in reconcile.thresholds(counts).collect()}
    assert status == {"bid-requests": (10001, "FAIL"), "impressions": (10001, "PASS")}
    own = reconcile.thresholds(counts, {"bid-requests": 5}).collect()
    assert {r.topic: r.status for r in own} == {"bid-requests": "PASS", "impressions": "PASS"}


def test_missing_offset_fails(spark):
    df = spark.createDataFrame([("t", 3, None, 5)], OFFSETS)
    with pytest.raises(Exception, match="missing offsets for partition 3"):
        reconcile.topic_counts(df).collect()


def test_snapshot_diff_is_a_multiset_difference(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("c", 3)], "k STRING, n INT")
    right = spark.createDataFrame([("a", 1), (None, 2), ("d", 4)], "k STRING, n INT")
    got = {(r.k, r.n, r.side, r.copies) for r in reconcile.snapshot_diff(left, right).collect()}
    assert got == {("a", 1, "left_only", 1), ("c", 3, "left_only", 1), ("d", 4, "right_only", 1)}
    assert reconcile.snapshot_diff(left, left).count() == 0


SNAP = "campaign_id STRING, bid_requests BIGINT, deduped_impressions BIGINT, unknown_impressions BIGINT"


def test_snapshot_delta(spark):
    before = spark.createDataFrame([("c1", 1, 1, 0), ("UNKNOWN", 0, 0, 2)], SNAP)
    after = spark.createDataFrame([("c1", 4, 3, 0), ("UNKNOWN", 0, 0, 1), ("c2", 1, 0, 0)], SNAP)
    got = {
        r.campaign_id: (r.bid_requests_delta, r.deduped_impressions_delta, r.unknown_impressions_delta)
        for r in reconcile.snapshot_delta(before, after).collect()
    }
    assert got == {"c1": (3, 2, 0), "UNKNOWN": (0, 0, -1), "c2": (1, 0, 0)}


def test_reconcile_reports_what_is_off(spark):
    changes = spark.createDataFrame(
        [("bid", "a"), ("bid", "a"), ("impression", "a"), ("impression", "b")], "kind STRING, bid_id STRING"
    )
    bids = spark.createDataFrame([("a",)], "bid_id STRING")
    imps = spark.createDataFrame([("a",), ("b",)], "bid_id STRING")
    pending = spark.createDataFrame([(0,)], "pending BIGINT")
    good = spark.createDataFrame([("c", 1, 1, 0), ("UNKNOWN", 0, 0, 1)], SNAP)
    rows = reconcile.reconcile(changes, bids, imps, pending, good, good).collect()
    assert len(rows) == 10 and all(r.ok for r in rows)
    bad = spark.createDataFrame([("c", 1, 1, 0)], SNAP)
    late = spark.createDataFrame([(7,)], "pending BIGINT")
    off = {r.check for r in reconcile.reconcile(changes, bids, imps, late, bad, good).collect() if not r.ok}
    assert off == {
        "backlog is empty",
        "matched + unknown = impression facts",
        "summary unknown_impressions = roll-up",
    }
