from datetime import timedelta

import pytest
from conftest import utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adtally.operators import dedup
from adtally.plans import metrics, rollup
from adtally.plans.serving import Serving
from adtally.schemas import COUNTERS
from adtally.sources import facts as fact_tables

DELTAS = "campaign_id STRING, event_ts TIMESTAMP, bid_requests BIGINT, deduped_impressions BIGINT, unknown_impressions BIGINT"
DAY = timedelta(days=1)
START = utc(2024, 1, 10)


def deltas(spark, rows):
    return spark.createDataFrame(rows, DELTAS)


def test_empty_range(spark):
    none = deltas(spark, [])
    rows = metrics.summary(none, START, START + DAY, "facts").collect()
    assert len(rows) == 1
    assert [rows[0][c] for c in COUNTERS] == [0, 0, 0] and rows[0].view_rate == 0.0
    assert metrics.by_campaign(none).count() == 0
    points = metrics.series(none, START, START + DAY, "hour").collect()
    assert len(points) == 24 and all(p[c] == 0 for p in points for c in COUNTERS)


@pytest.mark.parametrize("bids, matched, rate", [(0, 3, 0.0), (2, 3, 1.5), (4, 1, 0.25)])
def test_view_rate(spark, bids, matched, rate):
    df = deltas(spark, [("c", START, bids, matched, 0)])
    assert metrics.summary(df, START, START + DAY, "facts").first().view_rate == rate


def test_campaign_order_and_the_unknown_row(spark):
    rows = [("b", START, 2, 0, 0), ("B", START, 2, 0, 0), ("a", START, 2, 0, 0), ("z", START, 5, 0, 0)]
    rows += [("UNKNOWN", START, 0, 0, 1), ("UNKNOWN", START, 0, 0, -1), ("é", START, 2, 0, 0)]
    assert [r.campaign_id for r in metrics.by_campaign(deltas(spark, rows)).collect()] == ["z", "B", "a", "b", "é"]
    # A real campaign of that name is one row with the synthetic one.
    rows += [("UNKNOWN", START, 1, 0, 0), ("UNKNOWN", START, 0, 0, 3)]
    row = metrics.by_campaign(deltas(spark, rows)).where("campaign_id = 'UNKNOWN'").collect()
    assert [(r.bid_requests, r.unknown_impressions) for r in row] == [(1, 3)]


def test_top_campaigns_need_bids(spark):
    rows = [(f"c{n}", START, n, 0, 0) for n in range(12)] + [("UNKNOWN", START, 0, 0, 99)]
    top = metrics.top_campaigns(metrics.by_campaign(deltas(spark, rows))).collect()
    assert [r.campaign_id for r in top] == [f"c{n}" for n in range(11, 3, -1)]


def test_range_is_half_open(spark):
    df = deltas(spark, [("c", START, 1, 0, 0), ("c", START + DAY, 1, 0, 0)])
    assert metrics.totals(metrics.in_range(df, START, START + DAY)).first().bid_requests == 1


moments = st.lists(
    st.tuples(st.sampled_from(["c1", "c2", "UNKNOWN"]), st.integers(0, 4 * 3600)), min_size=1, max_size=30
)


def serving(spark, rows, cutoff, overlap=False):
    df = deltas(
        spark,
        [(c, START + timedelta(seconds=s), int(c != "UNKNOWN"), 0, int(c == "UNKNOWN")) for c, s in rows],
    )
    return Serving(df, rollup.minute_campaign(df), cutoff, rollup.minute_global(df), overlap)


@given(moments, st.integers(0, 4 * 3600), st.integers(0, 3 * 3600), st.integers(1, 3600))
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_cutoff_counts_every_event_once(spark, rows, cut, begin, width):
    """However a range is split, events of its whole minutes are counted once."""
    start, end = START + timedelta(seconds=begin), START + timedelta(seconds=begin + width)
    cutoff = START + timedelta(seconds=cut, microseconds=500000)
    answers = serving(spark, rows, cutoff)
    source = answers.summary(start, end).first().source
    low, high = begin, begin + width
    if source == "rollup":
        low = begin - begin % 60
    if source in ("rollup", "mixed"):
        high = high if high % 60 == 0 else high - high % 60 + 60
        if source == "mixed" and cut - cut % 60 <= begin and begin - begin % 60 + 60 >= begin + width:
            high = begin + width  # all of it lies in the cutoff's minute, which facts answer
    inside = [c for c, s in rows if low <= s < high]
    row = answers.summary(start, end).first()
    assert row.bid_requests + row.unknown_impressions == len(inside)
    campaigns = answers.by_campaign(start, end).collect()
    assert {r.campaign_id: r.bid_requests + r.unknown_impressions for r in campaigns} == {
        c: inside.count(c) for c in set(inside)
    }
    series = answers.series(start, end, "minute").collect()
    assert sum(p.bid_requests + p.unknown_impressions for p in series) == len(inside)
    assert [p.ts for p in series] == sorted(p.ts for p in series)


def test_overlap_counts_the_cutoff_minute_twice(spark):
    rows = [("c1", 30), ("c1", 100), ("c1", 200)]
    cutoff = START + timedelta(seconds=110)
    end = START + timedelta(minutes=10)
    assert serving(spark, rows, cutoff).summary(START, end).first().bid_requests == 3
    assert serving(spark, rows, cutoff, overlap=True).summary(START, end).first().bid_requests == 4
    point = serving(spark, rows, cutoff, overlap=True).series(START, end, "minute").collect()[1]
    assert point.bid_requests == 2


def test_dashboard_shares_one_relation(spark):
    rows = [("c1", START + timedelta(seconds=s), 1, 0, 0) for s in (1, 61, 4000)]
    board = metrics.dashboard(deltas(spark, rows), START, START + timedelta(hours=3))
    assert board.resolution == "minute"
    assert board.summary.first().bid_requests == 3
    assert board.campaigns.first().bid_requests == 3
    assert board.series.count() == 180
    board.close()


def test_multi_resolution_levels_agree(spark):
    rows = [("c1", START + timedelta(seconds=s * 47), 1, s % 2, 0) for s in range(200)]
    df = rollup.multi_resolution(deltas(spark, rows))
    sums = {r[0]: (r[1], r[2]) for r in df.groupBy("resolution").sum("bid_requests", "deduped_impressions").collect()}
    assert sums == {r: (200, 100) for r in ("second", "minute", "hour", "day")}
    assert df.where("resolution = 'hour'").count() == 3


BIDS = "seq BIGINT, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP"
IMPS = "seq BIGINT, bid_id STRING, event_ts TIMESTAMP"


def test_rebuild_window(spark):
    now = START + 40 * DAY
    bids = spark.createDataFrame([(1, "a", "c", START), (2, "b", "c", now - DAY)], BIDS)
    imps = spark.createDataFrame([(3, "a", now - DAY), (4, "old", START)], IMPS)
    totals = rollup.lifetime_campaign(rollup.rebuild(bids, imps, now)).collect()
    assert [tuple(r) for r in totals] == [("c", 1, 1, 0)]
    recent = rollup.lifetime_campaign(rollup.rebuild(bids, imps, now, recent_bids_only=True))
    assert sorted(tuple(r) for r in recent.collect()) == [("UNKNOWN", 0, 0, 1), ("c", 1, 0, 0)]


def test_stored_facts_prune_and_push_down(spark, tmp_path):
    rows = [(n, str(n), "c", START + timedelta(hours=n), None, None, None, None, START) for n in range(72)]
    schema = BIDS + ", request_id STRING, user_idfv STRING, placement_id STRING, raw_json STRING, arrival_ts TIMESTAMP"
    facts = dedup.bid_facts(spark.createDataFrame(rows, schema))
    path = str(tmp_path / "bids")
    fact_tables.write_facts(facts, path)
    stored = fact_tables.read_facts(spark, path)
    day = fact_tables.range_scan(stored, START + DAY, START + 2 * DAY)
    assert day.count() == 24
    plan = day.select("bid_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in plan
    assert "event_date#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<bid_id:string,event_ts:timestamp>" in plan
    assert fact_tables.retained(stored, START + 33 * DAY).count() == 24
    replayed = fact_tables.replay_scan(stored.withColumn("raw_json", stored.bid_id), START + DAY, "bid")
    assert replayed.count() == 48


def test_bucketed_facts_join_without_a_shuffle(spark, tmp_path):
    from adtally.operators.attribution import deltas_from_facts

    bids = spark.createDataFrame([(n, str(n), "c", START) for n in range(50)], BIDS)
    imps = spark.createDataFrame([(n, str(n), START) for n in range(25, 75)], IMPS)
    fact_tables.write_bucketed(bids, "b_bids", 4, str(tmp_path / "b"))
    fact_tables.write_bucketed(imps, "b_imps", 4, str(tmp_path / "i"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = deltas_from_facts(spark.table("b_bids"), spark.table("b_imps"))
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        totals = metrics.totals(rows).first()
        assert list(totals) == [50, 25, 25]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE b_bids")
        spark.sql("DROP TABLE b_imps")
