"""Every registered query against its SQL twin, and the published expectations."""

import os

import pytest

from __spark_entry__ import entry
from adtally.catalogue.oracle import ORACLE
from adtally.catalogue.queries import QUERIES
from check import compare, connect

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, ORACLE[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", ["read_model_as_of", "backlog", "snapshot_diff", "series_spine", "burst_slo"])
def test_no_job_before_an_action(spark, name):
    tracker, group = spark.sparkContext.statusTracker(), f"plan-{name}"
    spark.sparkContext.setJobGroup(group, name)
    QUERIES[name](spark, SMALL)
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_entry(spark):
    assert entry(spark).count() > 0


def counters(row):
    return (row.bid_requests, row.deduped_impressions, row.unknown_impressions)


def test_expected_values(spark):
    run = lambda name: QUERIES[name](spark, MEDIUM).collect()
    assert counters(run("summary_exact")[0]) == (93, 30, 76)
    assert counters(run("summary_rollup")[0]) == (94, 31, 76)
    assert counters(run("summary_mixed")[0]) == (1489, 357, 851)
    assert counters(run("summary_mixed_compat")[0]) == (1490, 358, 851)
    assert [(r.campaign_id, *counters(r)) for r in run("by_campaign_exact")] == [
        ("campaign1", 505, 109, 0),
        ("campaign2", 363, 83, 0),
        ("campaign_default", 243, 57, 0),
        ("UNKNOWN", 0, 0, 615),
    ]
    assert len(run("correction_ledger")) == 8958
    assert counters(run("lifetime_global")[0]) == (4458, 1018, 2502)
    assert [r.bid_id for r in run("unmatched_bids")[:3]] == ["16-26", "121-96", "11-84"]
    attempts: dict = {}
    for r in run("stage_counters"):
        attempts[r.stage] = attempts.get(r.stage, 0) + r.attempts
    assert attempts == {
        "steady": 2660,
        "burst1": 2325,
        "burst2": 2350,
        "recovery": 2665,
    }
    assert {r.topic: r.messages for r in run("topic_counts")} == {"bid-requests": 5398, "impressions": 4020}
