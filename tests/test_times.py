from datetime import timedelta

import pytest
from conftest import utc

from adtally.functions.rates import counter
from adtally.functions.times import (
    ceil_to,
    choose_resolution,
    floor_to,
    parse_instant,
    parse_range,
    preset_range,
    spine,
)
from adtally.plans.serving import choose_source, cutoff_at


@pytest.mark.parametrize(
    "width, wanted, resolution",
    [
        (timedelta(hours=6), "", "minute"),
        (timedelta(hours=6, seconds=1), "auto", "hour"),
        (timedelta(days=7), None, "hour"),
        (timedelta(days=7, seconds=1), "auto", "day"),
        (timedelta(days=99), "week", "minute"),
        (timedelta(days=99), " hour ", "hour"),
        (timedelta(minutes=1), "day", "day"),
    ],
)
def test_resolution(width, wanted, resolution):
    start = utc(2024, 1, 1)
    assert choose_resolution(wanted, start, start + width) == resolution


@pytest.mark.parametrize(
    "start, end",
    [
        (None, "2024-01-01T00:00:00Z"),
        ("2024-01-01T00:00:00Z", " "),
        ("2024-01-01", "2024-01-02T00:00:00Z"),
        ("2024-01-01T00:00:00", "2024-01-02T00:00:00Z"),
        ("2024-01-02T00:00:00Z", "2024-01-02T00:00:00Z"),
        ("2024-01-02T00:00:00Z", "2024-01-02T01:00:00+02:00"),
        ("2024-13-02T00:00:00Z", "2025-01-02T01:00:00Z"),
    ],
)
def test_bad_ranges(start, end):
    with pytest.raises(ValueError):
        parse_range(start, end)


def test_ranges_are_utc():
    start, end = parse_range("2024-01-01T02:00:00+02:00", "2024-01-01T00:00:01.5Z")
    assert start == utc(2024, 1, 1) and end - start == timedelta(seconds=1.5)
    assert parse_instant(" 2024-01-01T00:00:00Z ") == utc(2024, 1, 1)


def test_rounding():
    odd = utc(2024, 1, 16, 6, 6, 59).replace(microsecond=900000)
    assert floor_to(odd, "minute") == utc(2024, 1, 16, 6, 6)
    assert ceil_to(odd, "minute") == utc(2024, 1, 16, 6, 7)
    assert ceil_to(utc(2024, 1, 16), "day") == utc(2024, 1, 16)
    assert ceil_to(odd, "day") == utc(2024, 1, 17)
    assert floor_to(odd, "hour") == utc(2024, 1, 16, 6)


def test_presets_end_now_on_the_minute():
    assert preset_range("6h", utc(2024, 1, 2, 3, 4, 5)) == (utc(2024, 1, 1, 21, 4), utc(2024, 1, 2, 3, 4))
    start, end = preset_range("30d", utc(2024, 3, 1, 0, 0, 30))
    # The preset starts below the exact cutoff, so it is a mixed query.
    assert choose_source(start, end, cutoff_at(utc(2024, 3, 1, 0, 0, 30))) == "mixed"


def test_source_choice_at_the_cutoff():
    cutoff, hour = utc(2024, 1, 10), timedelta(hours=1)
    assert choose_source(cutoff - hour, cutoff, cutoff) == "facts"
    assert choose_source(cutoff, cutoff + hour, cutoff) == "rollup"
    assert choose_source(cutoff - hour, cutoff + hour, cutoff) == "mixed"


def test_spine_covers_the_range(spark):
    points = [r.ts for r in spine(spark, utc(2024, 2, 28, 23, 59, 30), utc(2024, 3, 1), "day").orderBy("ts").collect()]
    assert [p.day for p in points] == [28, 29]
    assert spine(spark, utc(2024, 1, 5, 10, 0, 30), utc(2024, 1, 5, 14, 20, 15), "minute").count() == 261
    assert spine(spark, utc(2024, 1, 5), utc(2024, 1, 12), "hour").count() == 168


def test_counter_text(spark):
    texts = ["12", "-3", "+4", "", None, "x", "1.5", " 7", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in df.select(counter(df.t)).collect()] == [12, -3, 4, 0, 0, 0, 0, 0, 0]
