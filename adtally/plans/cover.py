"""Calendar cover: a range as few days, hours and minutes as it can be, over roll-ups of all three widths.

The reads of a long range stop growing with its minutes: a year and a bit is some 365 days, at most 46 hours and
118 minutes per campaign. Levels are sums of the same signed counter rows, so a late correction is one more row in the
minute, the hour and the day of its impression.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.times import as_utc, bucket, ceil_to, floor_to
from adtally.plans.metrics import any_count, sums
from adtally.schemas import COUNTERS

#: Roll-up levels, fine to coarse.
LEVELS = ("minute", "hour", "day")
#: Minute rows that are in no coarser level yet; they count wherever they lie in the range.
LOOSE = "loose"


def levels_of(minutes: DataFrame) -> DataFrame:
    """``(level, campaign_id, minute_ts, counters)``: the minutes, and their sums by hour and by day.

    Hours come from minutes and days from hours by one grouping: rows go to all levels after the minutes have been
    summed, so what is shuffled is at most three times the minutes.
    """
    spread = F.array(*[F.struct(F.lit(name).alias("level"), bucket(F.col("minute_ts"), name).alias("ts")) for name in LEVELS])
    return (
        minutes.select("campaign_id", *COUNTERS, F.inline(spread))
        .groupBy("level", "campaign_id", F.col("ts").alias("minute_ts"))
        .agg(*sums())
        .where(any_count())
    )


def cover(start: datetime, end: datetime, coarsest: str = "day") -> list[tuple[str, datetime, datetime]]:
    """Segments ``(level, from, to)`` in order of time, which part the whole minutes of ``[start, end)``.

    No segment could be taken by a coarser level (up to ``coarsest``), so each level but the coarsest has at most two.
    """
    start, end = floor_to(as_utc(start), "minute"), ceil_to(as_utc(end), "minute")
    before, after = [], []
    for finer, level in zip(LEVELS, LEVELS[1 : LEVELS.index(coarsest) + 1]):
        first, last = ceil_to(start, level), floor_to(end, level)
        if first >= last:
            return [*before, *([(finer, start, end)] if start < end else []), *after]
        before += [(finer, start, first)] if start < first else []
        after = ([(finer, last, end)] if last < end else []) + after
        start, end = first, last
    return [*before, *([(coarsest, start, end)] if start < end else []), *after]


def _within(first: datetime, last: datetime) -> Column:
    return (F.col("minute_ts") >= F.lit(first)) & (F.col("minute_ts") < F.lit(last))


def covered(levels: DataFrame, start: datetime, end: datetime, coarsest: str = "day") -> DataFrame:
    """The rows of ``levels`` that make up ``[start, end)``, each counted once. Filters reach the scan."""
    segments = cover(start, end, coarsest)
    if not segments:
        return levels.where(F.lit(False))
    wanted = (F.col("level") == LOOSE) & _within(segments[0][1], segments[-1][2])
    for level, first, last in segments:
        wanted = wanted | ((F.col("level") == level) & _within(first, last))
    return levels.where(wanted)
