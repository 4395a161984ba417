"""The calendar cover of a range, against the minutes themselves."""

from datetime import timedelta

import pytest
from conftest import utc
from hypothesis import given, settings
from hypothesis import strategies as st

from adtally.plans import cover as C
from adtally.plans import metrics
from adtally.plans.serving import Serving

T0 = utc(2024, 1, 1)
MINUTES = "campaign_id STRING, minute_ts TIMESTAMP, bid_requests BIGINT, deduped_impressions BIGINT, unknown_impressions BIGINT"
WIDTH = {"minute": timedelta(minutes=1), "hour": timedelta(hours=1), "day": timedelta(days=1)}


@given(st.integers(0, 40 * 86400), st.integers(0, 40 * 86400), st.sampled_from(C.LEVELS))
@settings(max_examples=300, deadline=None)
def test_segments_part_the_range(first, width, coarsest):
    start, end = T0 + timedelta(seconds=first), T0 + timedelta(seconds=first + width)
    segments = C.cover(start, end, coarsest)
    if not width:
        assert not segments or segments[-1][2] - segments[0][1] <= timedelta(minutes=1)
        return
    assert segments[0][1] <= start < segments[0][1] + timedelta(minutes=1)
    assert segments[-1][2] - timedelta(minutes=1) < end <= segments[-1][2]
    assert all(a[2] == b[1] for a, b in zip(segments, segments[1:]))
    count = {level: 0 for level in C.LEVELS}
    for level, a, b in segments:
        assert a < b and (a - T0) % WIDTH[level] == timedelta(0) == (b - T0) % WIDTH[level]
        count[level] += (b - a) // WIDTH[level]
    if coarsest == "day":
        assert count["minute"] <= 118 and count["hour"] <= 46
    if coarsest != "minute":
        assert count["minute"] <= 118


@pytest.fixture(scope="module")
def minutes(spark):
    rows = [
        (f"c{n % 3}", T0 + timedelta(minutes=(n * 37) % (40 * 1440)), n % 5 - 1, n % 2, -(n % 3)) for n in range(6000)
    ]
    return spark.createDataFrame(rows, MINUTES).groupBy("campaign_id", "minute_ts").agg(*metrics.sums()).cache()


@pytest.mark.parametrize(
    "start, end",
    [
        (T0 + timedelta(hours=5, seconds=30), T0 + timedelta(days=33, hours=7, minutes=3, seconds=1)),
        (T0 + timedelta(minutes=3), T0 + timedelta(minutes=59)),
        (T0 + timedelta(minutes=3), T0 + timedelta(hours=2)),
        (T0, T0 + timedelta(days=40)),
    ],
)
def test_answers_equal_those_of_minutes(minutes, start, end):
    plain = Serving(None, minutes, utc(2023, 1, 1))
    by_cover = Serving(None, minutes, utc(2023, 1, 1), levels=C.levels_of(minutes))
    assert plain.summary(start, end).collect() == by_cover.summary(start, end).collect()
    assert plain.by_campaign(start, end).collect() == by_cover.by_campaign(start, end).collect()
    for resolution in ("hour", "day"):
        assert plain.series(start, end, resolution).collect() == by_cover.series(start, end, resolution).collect()


def test_buckets_read(spark, tmp_path):
    """A month and a bit: a thousand buckets of hours and days fewer than minutes, and only they leave the scan."""
    every = spark.range(35 * 1440).selectExpr(
        "'c' AS campaign_id", f"timestamp'{T0:%Y-%m-%d}' + make_dt_interval(0, 0, id) AS minute_ts",
        "1L AS bid_requests", "0L AS deduped_impressions", "0L AS unknown_impressions",
    )
    path = str(tmp_path / "levels")
    C.levels_of(every).write.partitionBy("level").parquet(path)
    levels = spark.read.parquet(path)
    start, end = T0 + timedelta(hours=1, minutes=7), T0 + timedelta(days=34, hours=20, minutes=50)
    rows = C.covered(levels, start, end)
    # 53 + 50 minutes, 22 + 20 hours, 33 days stand for some 50,000 minutes
    assert rows.count() == 53 + 50 + 22 + 20 + 33
    assert rows.agg({"bid_requests": "sum"}).first()[0] == (end - start) // timedelta(minutes=1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "level" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(minute_ts" in plan
