"""Impressions of a range from the ledger alone, against the join with all bids."""

import random

from conftest import utc
from hypothesis import HealthCheck, given, settings
from test_lifecycle import records

from adtally.operators.attribution import attributed_from_ledger, attributed_impressions
from adtally.operators.dedup import first_write
from adtally.operators.lifecycle import correction_ledger, lifecycle
from adtally.plans import metrics
from adtally.streaming import store as S

START, END = utc(2024, 1, 1, 0, 20), utc(2024, 1, 1, 1, 10)


def joined(changes):
    bids = first_write(changes.where("kind = 'bid'")).select("bid_id", "campaign_id")
    imps = first_write(changes.where("kind = 'impression'")).select("bid_id", "event_ts")
    return attributed_impressions(metrics.in_range(imps, START, END), bids)


@given(records)
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_equals_the_join(changes_of, rows):
    changes = changes_of(rows)
    got = attributed_from_ledger(correction_ledger(lifecycle(changes)), START, END)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined(changes).collect()))


def test_a_merged_ledger_is_skipped_by_time_and_no_bid_is_read(spark, changes_of, tmp_path):
    rng = random.Random(1)
    rows = [(n, rng.choice(["bid", "impression"]), f"k{rng.randrange(300)}", "c", rng.randrange(600)) for n in range(1200)]
    rows = [(n, kind, i, c if kind == "bid" else None, m) for n, kind, i, c, m in rows]
    store = S.BatchStore(spark, str(tmp_path))
    changes = changes_of(rows)
    carried = lifecycle(changes, bid_carry=("campaign_id", "event_ts", "arrival_ts"), impression_carry=("event_ts", "arrival_ts"))
    ledger = correction_ledger(carried)
    store.write(S.LEDGER, 0, ledger)
    store.write(S.PROGRESS, 0, ledger.selectExpr("current_timestamp() AS projected_at", "seq AS last_seq", "1L AS changes").limit(1))
    assert store.merge(S.LEDGER) == 0
    got = attributed_from_ledger(store.read(S.LEDGER), START, END)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined(changes).collect()))
    assert "MergeJoin" not in plan and "HashJoin" not in plan and plan.count("Scan parquet") == 1 and "GreaterThanOrEqual(event_ts" in plan
