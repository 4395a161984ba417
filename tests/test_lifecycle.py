"""First writes, attribution, corrections: against a record-by-record replay."""

from collections import Counter
from datetime import timedelta

import model
from conftest import utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adtally.operators import attribution, dedup, lifecycle
from adtally.plans import metrics, rollup
from adtally.schemas import COUNTERS

# Golden fixture: late bid x, ordinary y, then duplicates of both kinds.
LATE_BID = [
    (1, "impression", "x", None, 1),
    (2, "bid", "y", "c1", 2),
    (3, "bid", "x", "c2", 3),
    (4, "impression", "y", None, 4),
    (5, "bid", "x", "c9", 5),
    (6, "impression", "x", None, 6),
]
LATE_BID_LEDGER = {
    (1, "UNKNOWN", 1, 0, 0, 1): 1,
    (2, "c1", 2, 1, 0, 0): 1,
    (3, "c2", 3, 1, 0, 0): 1,
    (3, "UNKNOWN", 1, 0, 0, -1): 1,
    (3, "c2", 1, 0, 1, 0): 1,
    (4, "c1", 4, 0, 1, 0): 1,
}


def minute_of(ts):
    return ts.hour * 60 + ts.minute


def as_counter(df):
    return Counter(
        (r.seq, r.campaign_id, minute_of(r.event_ts), r.bid_requests, r.deduped_impressions, r.unknown_impressions)
        for r in df.collect()
    )


def as_minutes(df):
    return {
        (r.campaign_id, minute_of(r.minute_ts)): (r.bid_requests, r.deduped_impressions, r.unknown_impressions)
        for r in df.collect()
    }


records = st.lists(
    st.tuples(
        st.sampled_from(["bid", "impression"]),
        st.sampled_from("abcdef"),
        st.sampled_from(["c1", "c2", "UNKNOWN"]),
        st.integers(0, 120),
    ),
    max_size=40,
).map(
    lambda rows: [
        (seq, kind, bid_id, campaign if kind == "bid" else None, minute)
        for seq, (kind, bid_id, campaign, minute) in enumerate(rows)
    ]
)
relaxed = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def test_late_bid_fixture(changes_of):
    assert model.ledger(LATE_BID) == LATE_BID_LEDGER
    lives = lifecycle.lifecycle(changes_of(LATE_BID))
    assert as_counter(lifecycle.correction_ledger(lives)) == LATE_BID_LEDGER


@given(records)
@relaxed
def test_ledger_and_rollups_match_a_replay(changes_of, rows):
    lives = lifecycle.lifecycle(changes_of(rows))
    ledger = lifecycle.correction_ledger(lives)
    assert as_counter(ledger) == model.ledger(rows)
    expected = model.minutes(rows)
    assert as_minutes(rollup.minute_campaign(ledger)) == expected
    assert as_minutes(rollup.minute_campaign(lifecycle.deltas(lives))) == expected


@given(records)
@relaxed
def test_facts_and_fold_agree(changes_of, rows):
    changes = changes_of(rows)
    bids = dedup.first_write(changes.where("kind = 'bid'"))
    imps = dedup.first_write(changes.where("kind = 'impression'"))
    model_bids, model_imps = model.first_writes(rows)
    assert {r.bid_id: r.seq for r in bids.collect()} == {k: v[0] for k, v in model_bids.items()}
    assert {r.bid_id: r.seq for r in imps.collect()} == {k: v[0] for k, v in model_imps.items()}

    expected = model.minutes(rows)
    assert as_minutes(rollup.minute_campaign(attribution.deltas_from_facts(bids, imps))) == expected
    from_facts = lifecycle.deltas(lifecycle.lifecycle_from_facts(bids, imps))
    assert as_minutes(rollup.minute_campaign(from_facts)) == expected

    totals = metrics.totals(from_facts).first()
    # Every impression fact is matched or unknown, and campaigns add up to the summary.
    assert totals.deduped_impressions + totals.unknown_impressions == len(model_imps)
    campaigns = metrics.by_campaign(from_facts).collect()
    for name in COUNTERS:
        assert sum(r[name] for r in campaigns) == totals[name]


def test_as_of_every_change(changes_of):
    ledger = lifecycle.correction_ledger(lifecycle.lifecycle(changes_of(LATE_BID))).cache()
    for seq in range(0, 7):
        got = metrics.totals(lifecycle.as_of(ledger, seq)).first()
        expected = [0, 0, 0]
        for row, n in model.ledger([r for r in LATE_BID if r[0] <= seq]).items():
            expected = [a + n * b for a, b in zip(expected, row[3:])]
        assert list(got) == expected
    ledger.unpersist()


def test_remember_limits_attribution_but_not_dedup(spark):
    day = timedelta(days=1)
    t0 = utc(2024, 1, 1)
    rows = [
        (1, "bid", "a", "c", t0, t0),
        (2, "impression", "a", None, t0, t0 + 40 * day),  # the bid is forgotten
        (3, "impression", "b", None, t0, t0),
        (4, "bid", "b", "c", t0, t0 + 31 * day),  # the mark is forgotten exactly now
        (5, "impression", "d", None, t0, t0),
        (6, "bid", "d", "c", t0, t0 + 30 * day),  # in time
        (7, "bid", "a", "c", t0, t0 + 80 * day),  # still a duplicate
    ]
    changes = spark.createDataFrame(
        rows, "seq BIGINT, kind STRING, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP, arrival_ts TIMESTAMP"
    )
    lives = lifecycle.lifecycle(
        changes, bid_carry=("campaign_id", "event_ts", "arrival_ts"), impression_carry=("event_ts", "arrival_ts")
    )
    got = metrics.totals(lifecycle.correction_ledger(lives, remember=31 * day)).first()
    assert list(got) == [3, 1, 2]
    assert list(metrics.totals(lifecycle.correction_ledger(lives)).first()) == [3, 3, 0]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """One id with most of the rows sends at most one row per task to the reducers."""
    rows = spark.range(0, 30000, 1, 6).selectExpr(
        "id AS seq",
        "IF(id % 2 = 0, 'bid', 'impression') AS kind",
        "IF(id % 3 < 2, 'hot', CAST(id AS STRING)) AS bid_id",
        "IF(id % 2 = 0, 'c', NULL) AS campaign_id",
        "timestamp_seconds(id) AS event_ts",
    )
    lives = lifecycle.lifecycle(rows)
    text = lives._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(bid_id") == 1
    assert "partial_min" in text
    hot = lives.where("bid_id = 'hot'").first()
    assert (hot.bid.seq, hot.impression.seq) == (0, 1)
    first = dedup.first_write(rows.where("kind = 'bid'"))
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert first.where("bid_id = 'hot'").first().seq == 0


def test_unknown_after_wait(spark):
    t0 = utc(2024, 1, 10)
    hour = timedelta(hours=1)
    rows = []
    for n, offset in enumerate([-900, -1, 0, 24, 25]):
        rows.append((2 * n, "impression", str(n), None, t0))
        rows.append((2 * n + 1, "bid", str(n), "c", t0 + offset * hour))
    rows.append((99, "impression", "none", None, t0))
    changes = spark.createDataFrame(
        rows, "seq BIGINT, kind STRING, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP"
    )
    lives = lifecycle.lifecycle(changes)
    got = {r.bid_id: r.outcome for r in lifecycle.unknown_after_wait(lives, 24 * hour, 31 * 24 * hour).collect()}
    assert got == {"0": "unknown", "1": "matched", "2": "matched", "3": "matched", "4": "unknown", "none": "unknown"}
    unbounded = lifecycle.unknown_after_wait(lives, 24 * hour)
    assert unbounded.where("outcome = 'matched'").count() == 4


def test_unmatched_and_matched_ids(changes_of):
    changes = changes_of(LATE_BID + [(7, "bid", "q", "c1", 9), (8, "bid", "p", "c1", 9), (9, "impression", "z", None, 9)])
    bids = dedup.first_write(changes.where("kind = 'bid'"))
    imps = dedup.first_write(changes.where("kind = 'impression'"))
    assert [r.bid_id for r in attribution.unmatched_bids(bids, imps, 5).collect()] == ["q", "p"]
    assert [r.bid_id for r in attribution.unmatched_bids(bids, imps, 1).collect()] == ["q"]
    assert attribution.unmatched_bids(bids, imps, 0).count() == 0
    assert {r.bid_id for r in attribution.matched_bid_ids(bids, imps).collect()} == {"x", "y"}
    assert {r.bid_id for r in attribution.unknown_impressions(imps, bids).collect()} == {"z"}


def test_offsets_order_a_topic_whatever_the_clocks_say(spark):
    """Producers' clocks may run backwards; within a topic the offset is the order."""
    t0 = utc(2024, 1, 1)
    rows = [
        (7, 900, "bid", "a", "first", t0),
        (8, 100, "bid", "a", "second", t0),
        (3, 500, "impression", "a", None, t0),
        (9, 500, "bid", "b", "tie", t0),
        (10, 500, "bid", "b", "a-later-name", t0),
    ]
    changes = spark.createDataFrame(
        rows, "offset BIGINT, seq BIGINT, kind STRING, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP"
    )
    got = {r.bid_id: r.bid.campaign_id for r in lifecycle.lifecycle(changes).collect()}
    assert got == {"a": "first", "b": "tie"}
    firsts = dedup.first_write(changes.where("kind = 'bid'")).collect()
    assert {r.bid_id: r.campaign_id for r in firsts} == got
