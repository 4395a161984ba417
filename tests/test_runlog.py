from datetime import timedelta

import model
import pytest
from conftest import utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adtally.operators import runlog

SCHEMA = (
    "run_id STRING, stage STRING, op STRING, ts TIMESTAMP, status_code INT, network_error BOOLEAN, "
    "timeout BOOLEAN, retries BIGINT, bid_id STRING, delayed BOOLEAN"
)
T0 = utc(2024, 1, 1)


def row(stage="steady", op="bid", micros=0, status=200, net=False, timeout=False, retries=0, bid="b", delayed=False):
    return ("r", stage, op, T0 + timedelta(microseconds=micros), status, net, timeout, retries, bid, delayed)


def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_counters_and_classes(spark):
    rows = [row(status=s) for s in (200, 204, 302, 404, 500)] + [row(status=0, net=True, timeout=True, retries=2)]
    rows += [row(op="billing_matched", micros=5_000_000), row(stage="", op="billing_invalid", status=400)]
    got = {r.stage: r for r in runlog.stage_counters(log(spark, rows)).collect()}
    s = got["steady"]
    assert (s.attempts, s.http_2xx, s.http_4xx, s.http_5xx, s.network_errors, s.timeout_errors) == (7, 3, 1, 1, 1, 1)
    assert (s.bid_attempts, s.bid_success, s.nofill_count, s.billing_attempts, s.billing_success_2xx) == (6, 1, 1, 1, 1)
    assert s.retries_total == 2 and s.duration_ms == 5000
    assert s.success_rate == 3 / 7 and s.error_rate == 3 / 7 and s.network_error_rate == 1 / 7
    assert got["default"].invalid_attempts == 1


def test_two_runs_stay_apart(spark):
    one = [row(op="billing_matched", micros=m, bid="a") for m in (0, 2_000_000)]
    one += [row("recovery", micros=0), row("recovery", micros=1, status=500)]
    two = [("s", *r[1:3], r[3] + timedelta(days=1), *r[4:]) for r in one]
    both, alone = log(spark, one + two), log(spark, one)
    for report in (runlog.stage_counters, runlog.response_gaps, runlog.first_minute_error_rate, runlog.load_totals):
        got = [r for r in report(both).collect() if r.run_id == "r"]
        assert sorted(map(str, got)) == sorted(map(str, report(alone).collect()))
    assert len(runlog.burst_slo(runlog.stage_report(both)).collect()) == 2


def test_stage_order(spark):
    names = ["zeta", "recovery", "steady", "alpha", "burst2", "burst1"]
    stages = [r.stage for r in runlog.stage_counters(log(spark, [row(stage=n) for n in names])).collect()]
    assert stages == ["steady", "burst1", "burst2", "recovery", "alpha", "zeta"]


def test_first_minute(spark):
    second = 1_000_000
    rows = [row("recovery", micros=0), row("recovery", micros=60 * second, status=500)]
    rows += [row("recovery", micros=60 * second + 1, status=500), row("steady", status=500)]
    got = runlog.first_minute_error_rate(log(spark, rows)).first()
    assert (got.attempts, got.errors, got.first_minute_error_rate) == (2, 1, 0.5)
    assert runlog.first_minute_error_rate(log(spark, [row("steady")])).first().first_minute_error_rate == 0.0


points = st.lists(
    st.tuples(
        st.sampled_from([1, 1500, 700_000, 13_000_000, 4_000_000_000]),
        st.integers(0, 40),
        st.sampled_from(["ok", "ok", "client", "server", "redirect", "net"]),
    ),
    min_size=1,
    max_size=40,
)
STATUS = {"ok": 200, "client": 404, "server": 503, "redirect": 302, "net": 0}


@given(points)
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_gaps_match_a_full_sort(spark, raw):
    marks = [(unit * count, what) for unit, count, what in raw]
    df = log(spark, [row(micros=at, status=STATUS[what], net=what == "net") for at, what in marks])
    got = runlog.response_gaps(df).first()
    gap = model.longest_gap([(at, what in ("ok", "client", "server")) for at, what in marks])
    assert got.max_no_response_gap_ms == gap // 1000
    assert got.long_no_response_gt_10s == (gap > 10_000_000)


def test_gap_sorts_never_see_a_whole_stage(spark):
    plan = runlog.response_gaps(log(spark, [row()]))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3
    assert sum("second#" in line for line in windows) >= 1


REPORT = (
    "run_id STRING, stage STRING, success_rate DOUBLE, error_rate DOUBLE, network_error_rate DOUBLE, "
    "first_minute_error_rate DOUBLE, long_no_response_gt_10s BOOLEAN"
)


@pytest.mark.parametrize(
    "success, network, long_gap, early, overall, met",
    [
        (0.98, 0.0099, False, 0.012, 0.5, True),
        (0.979, 0.0, False, 0.012, 0.5, False),
        (0.99, 0.01, False, 0.012, 0.5, False),
        (0.99, 0.0, True, 0.012, 0.5, False),
        (0.99, 0.0, False, 0.02, 0.01, False),
        (0.99, 0.0, False, 0.0, 0.012, True),
        (0.99, 0.0, False, 0.0, 0.5, False),
    ],
)
def test_service_levels(spark, success, network, long_gap, early, overall, met):
    rows = [
        ("r", "steady", 0.99, 0.01, 0.0, 0.0, False),
        ("r", "burst1", 0.99, 0.01, 0.0, 0.0, False),
        ("r", "burst2", success, 0.01, network, 0.0, long_gap),
        ("r", "recovery", 0.99, overall, 0.0, early, False),
    ]
    assert runlog.burst_slo(spark.createDataFrame(rows, REPORT)).first().burst_slo_met is met


def test_missing_burst_fails(spark):
    rows = [("r", "steady", 0.99, 0.01, 0.0, 0.0, False)]
    assert runlog.burst_slo(spark.createDataFrame(rows, REPORT)).first().burst_slo_met is False


def test_totals_count_ids_once(spark):
    rows = [row(op="billing_matched", bid="a", delayed=True), row(op="billing_matched", bid="a", delayed=True)]
    rows += [row(op="billing_matched", bid="b", status=500), row(op="billing_unknown", bid="a"), row(bid="")]
    rows += [row(op="billing_matched", bid=""), row(op="billing_duplicate", bid="a"), row(status=204, bid="")]
    got = runlog.load_totals(log(spark, rows), {"matched_unique": 1, "unknown_unique": 1}).first()
    assert (got.matched_unique, got.unknown_unique, got.delayed_billing_count) == (1, 1, 2)
    assert (got.bid_success, got.nofill_count, got.duplicate_attempts) == (0, 1, 1)
    assert got.targets_met is True
    assert runlog.load_totals(log(spark, rows)).first().targets_met is False
