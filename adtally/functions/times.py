"""Time arithmetic: epochs, buckets, ranges and the zero-fill spine. All UTC."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESOLUTIONS = ("minute", "hour", "day")

# Bucket widths in seconds.
WIDTH_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

# The dashboard's preset windows.
PRESETS = {
    "1h": timedelta(hours=1),
    "6h": timedelta(hours=6),
    "24h": timedelta(hours=24),
    "7d": timedelta(days=7),
    "30d": timedelta(days=30),
}

_RFC3339 = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})")


# ---- column expressions -------------------------------------------------


# The years 1 and 9999, between which every reader can hold a timestamp.
FIRST_EPOCH, LAST_EPOCH = -62135596800, 253402300799


def is_storable(epoch_seconds: Column) -> Column:
    """Whether an epoch is a time; milli-, micro- and nanoseconds taken for seconds are not."""
    return F.coalesce(epoch_seconds.between(FIRST_EPOCH, LAST_EPOCH), F.lit(True))


def event_time(epoch_seconds: Column, arrival_ts: Column) -> Column:
    """Epoch seconds to a timestamp; 0 or missing means the arrival time, one that is no time is NULL."""
    seconds = F.when(is_storable(epoch_seconds), epoch_seconds)
    return F.when(F.coalesce(epoch_seconds, F.lit(0)) == 0, arrival_ts).otherwise(F.timestamp_seconds(seconds))


def bucket(ts: Column, resolution: str) -> Column:
    return F.date_trunc(resolution, ts)


def minute_key(ts: Column) -> Column:
    return F.date_format(F.date_trunc("minute", ts), "yyyyMMddHHmm")


def event_date(ts: Column) -> Column:
    return F.to_date(ts)


# ---- range arguments (plain Python, before any plan exists) -------------


def parse_instant(text: str) -> datetime:
    text = text.strip()
    if not _RFC3339.fullmatch(text):
        raise ValueError(f"not an RFC 3339 instant: {text!r}")
    return datetime.fromisoformat(text).astimezone(timezone.utc)


def as_utc(value: datetime | str) -> datetime:
    """RFC 3339 text or a datetime; a naive datetime is taken as UTC."""
    if isinstance(value, str):
        return parse_instant(value)
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def parse_range(start: datetime | str | None, end: datetime | str | None) -> tuple[datetime, datetime]:
    if not start or not end or not str(start).strip() or not str(end).strip():
        raise ValueError("from and to are required")
    start, end = as_utc(start), as_utc(end)
    if not start < end:
        raise ValueError("from must be before to")
    return start, end


def choose_resolution(wanted: str | None, start: datetime, end: datetime) -> str:
    """``auto`` or empty picks by width; unknown words fall back to minute."""
    wanted = (wanted or "").strip()
    if wanted in RESOLUTIONS:
        return wanted
    if wanted not in ("", "auto"):
        return "minute"
    width = end - start
    if width <= timedelta(hours=6):
        return "minute"
    if width <= timedelta(days=7):
        return "hour"
    return "day"


def floor_to(value: datetime, resolution: str) -> datetime:
    width = WIDTH_SECONDS[resolution]
    epoch = int(value.replace(microsecond=0).timestamp())
    return datetime.fromtimestamp(epoch - epoch % width, timezone.utc)


def ceil_to(value: datetime, resolution: str) -> datetime:
    floor = floor_to(value, resolution)
    if floor == value:
        return floor
    return floor + timedelta(seconds=WIDTH_SECONDS[resolution])


def preset_range(name: str, now: datetime) -> tuple[datetime, datetime]:
    """A preset window that ends at ``now``; both ends are cut to the minute."""
    now = as_utc(now)
    return floor_to(now - PRESETS[name], "minute"), floor_to(now, "minute")


# ---- spine --------------------------------------------------------------


def spine_of(bounds: DataFrame, resolution: str) -> DataFrame:
    """Every bucket from the one of ``first`` up to ``last``, from a relation of one row with these two columns.

    Days are made first and then spread, so no driver job and no array of all buckets is needed.
    """
    width = F.expr(f"INTERVAL {WIDTH_SECONDS[resolution]} SECONDS")
    day = F.expr("INTERVAL 1 DAY")
    days = bounds.where("first <= last").select(
        "first", "last", F.explode(F.sequence(F.date_trunc("day", "first"), F.date_trunc("day", "last"), day)).alias("day")
    )
    buckets = days.repartition("day").select("first", "last", F.explode(F.sequence("day", F.col("day") + day - width, width)).alias("ts"))
    return buckets.where((F.col("ts") >= F.date_trunc(resolution, "first")) & (F.col("ts") < F.col("last"))).select("ts")


def spine(spark: SparkSession, start: datetime, end: datetime, resolution: str) -> DataFrame:
    """Every bucket of ``[floor(start), ceil(end))`` as column ``ts``.

    A distributed ``range`` rather than one exploded array, so a spine of many
    years of minutes is built by many tasks.
    """
    first = int(floor_to(start, resolution).timestamp())
    last = int(ceil_to(end, resolution).timestamp())
    return spark.range(first, last, WIDTH_SECONDS[resolution]).select(
        F.timestamp_seconds("id").alias("ts")
    )
