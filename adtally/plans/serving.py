"""Where a range query reads: facts before the cutoff, roll-ups after it, or both."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.times import as_utc, choose_resolution, floor_to, parse_range
from adtally.plans import metrics
from adtally.plans.cover import LEVELS, covered
from adtally.plans.rollup import aligned_range, minute_global_from
from adtally.schemas import COUNTERS

FACTS, ROLLUP, MIXED = "facts", "rollup", "mixed"

HOT_DAYS = 30


def cutoff_at(now: datetime) -> datetime:
    return as_utc(now) - timedelta(days=HOT_DAYS)


def choose_source(start: datetime, end: datetime, cutoff: datetime) -> str:
    if end <= cutoff:
        return FACTS
    if start >= cutoff:
        return ROLLUP
    return MIXED


@dataclass(frozen=True)
class Serving:
    """Range queries over exact counter rows and minute roll-ups.

    ``exact`` has ``event_ts`` and answers ``[from, to)`` exactly. ``minutes`` has
    ``minute_ts`` and answers whole minutes, rounded outward. A mixed query is one
    plan: both halves are united before a single aggregation.

    ``levels`` (see ``adtally.plans.cover``) answers in place of ``minutes`` where given: by the
    fewest buckets that make up the range, none wider than the answer's own resolution.

    An unaligned cutoff is floored to the minute, so the halves are disjoint.
    ``overlap=True`` keeps it as it is; events between the floored and the real
    cutoff are then counted by both halves.
    """

    exact: DataFrame
    minutes: DataFrame
    cutoff: datetime
    minutes_global: DataFrame | None = None
    overlap: bool = False
    freshness: DataFrame | None = None
    levels: DataFrame | None = None

    def _cold(self, start: datetime, end: datetime) -> DataFrame:
        return metrics.in_range(self.exact, start, end).select("campaign_id", "event_ts", *COUNTERS)

    def _hot(self, start: datetime, end: datetime, by_campaign: bool, coarsest: str = LEVELS[-1]) -> DataFrame:
        if self.levels is not None:
            rows = covered(self.levels, start, end, coarsest)
            return rows.select("campaign_id", F.col("minute_ts").alias("event_ts"), *COUNTERS)
        if by_campaign:
            minutes = self.minutes
        else:
            minutes = self.minutes_global
            if minutes is None:
                minutes = minute_global_from(aligned_range(self.minutes, start, end))
            minutes = minutes.withColumn("campaign_id", F.lit(None).cast("string"))
        return aligned_range(minutes, start, end).select(
            "campaign_id", F.col("minute_ts").alias("event_ts"), *COUNTERS
        )

    def relation(
        self, start: datetime, end: datetime, by_campaign: bool = True, coarsest: str = LEVELS[-1]
    ) -> tuple[DataFrame, str]:
        source = choose_source(start, end, as_utc(self.cutoff))
        if source == FACTS:
            return self._cold(start, end), source
        if source == ROLLUP:
            return self._hot(start, end, by_campaign, coarsest), source
        cutoff = as_utc(self.cutoff)
        if not self.overlap:
            cutoff = floor_to(cutoff, "minute")
        hot = self._hot(cutoff, end, by_campaign, coarsest)
        if cutoff <= start:
            # The floored cutoff may fall before the start; then only part of the
            # first minute is wanted and facts answer it.
            edge = floor_to(start, "minute") + timedelta(minutes=1)
            if edge >= end:
                return self._cold(start, end), source
            return self._cold(start, edge).unionByName(self._hot(edge, end, by_campaign, coarsest)), source
        return self._cold(start, cutoff).unionByName(hot), source

    def summary(self, start, end) -> DataFrame:
        start, end = parse_range(start, end)
        relation, source = self.relation(start, end, by_campaign=False)
        result = metrics.summary(relation, start, end, source)
        if self.freshness is not None and source != FACTS:
            return result.withColumn("last_projected_at", self.freshness.scalar())
        return result

    def by_campaign(self, start, end) -> DataFrame:
        start, end = parse_range(start, end)
        relation, _ = self.relation(start, end)
        return metrics.by_campaign(relation)

    def series(self, start, end, resolution: str = "auto") -> DataFrame:
        """The resolution is chosen for the whole range, before any split."""
        start, end = parse_range(start, end)
        resolution = choose_resolution(resolution, start, end)
        relation, _ = self.relation(start, end, by_campaign=False, coarsest=resolution)
        return metrics.series(relation, start, end, resolution)
