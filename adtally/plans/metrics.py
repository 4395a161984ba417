"""Range queries. Each is one aggregation over a counter relation.

A counter relation has ``campaign_id``, a time column and the three counters. It
may come from raw changes, stored facts, a ledger or roll-ups; the queries do not
care. Aggregation keys are few and the partial aggregation runs before the
shuffle, so a campaign with most of the rows costs one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.rates import view_rate
from adtally.functions.times import as_utc, bucket, choose_resolution, parse_range, spine
from adtally.schemas import COUNTERS


def in_range(relation: DataFrame, start: datetime, end: datetime, ts: str = "event_ts") -> DataFrame:
    """Half-open ``[start, end)`` on exact timestamps."""
    return relation.where((F.col(ts) >= F.lit(as_utc(start))) & (F.col(ts) < F.lit(as_utc(end))))


def sums() -> list:
    return [F.sum(name).cast("bigint").alias(name) for name in COUNTERS]


def any_count():
    """True unless all three counters are 0."""
    return (F.col(COUNTERS[0]) != 0) | (F.col(COUNTERS[1]) != 0) | (F.col(COUNTERS[2]) != 0)


def totals(relation: DataFrame) -> DataFrame:
    """One row always; zeros for an empty relation."""
    row = relation.agg(*sums())
    return row.select(*[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in COUNTERS])


def summary(relation: DataFrame, start: datetime, end: datetime, source: str) -> DataFrame:
    return totals(relation).select(
        F.lit(as_utc(start)).alias("from_ts"),
        F.lit(as_utc(end)).alias("to_ts"),
        F.lit(source).alias("source"),
        *COUNTERS,
        view_rate(),
    )


def by_campaign(relation: DataFrame) -> DataFrame:
    """Most bids first, then campaign id; campaigns without any count are left out."""
    return (
        relation.groupBy("campaign_id")
        .agg(*sums())
        .where(any_count())
        .select("campaign_id", *COUNTERS, view_rate())
        .orderBy(F.desc("bid_requests"), F.asc("campaign_id"))
    )


def top_campaigns(campaigns: DataFrame, limit: int = 8) -> DataFrame:
    return (
        campaigns.where(F.col("bid_requests") > 0)
        .orderBy(F.desc("bid_requests"), F.asc("campaign_id"))
        .limit(limit)
    )


def bucketed_counts(relation: DataFrame, resolution: str, ts: str = "event_ts") -> DataFrame:
    """Counters per non-empty bucket."""
    return relation.groupBy(bucket(F.col(ts), resolution).alias("ts")).agg(*sums())


def series(
    relation: DataFrame, start: datetime, end: datetime, resolution: str, ts: str = "event_ts"
) -> DataFrame:
    """Every bucket of the range, zero-filled, ascending.

    The spine joins as rows of zeros in the same aggregation, so zero-filling needs
    neither a join nor a broadcast.
    """
    zeros = spine(relation.sparkSession, start, end, resolution).select(
        "ts", *[F.lit(0).cast("bigint").alias(name) for name in COUNTERS]
    )
    return (
        relation.select(bucket(F.col(ts), resolution).alias("ts"), *COUNTERS)
        .unionByName(zeros)
        .groupBy("ts")
        .agg(*sums())
        .select("ts", *COUNTERS, view_rate())
        .orderBy("ts")
    )


@dataclass(frozen=True)
class Dashboard:
    summary: DataFrame
    campaigns: DataFrame
    series: DataFrame
    resolution: str
    shared: DataFrame

    def close(self) -> None:
        self.shared.unpersist()


def dashboard(relation: DataFrame, start, end, resolution: str = "auto", source: str = "facts") -> Dashboard:
    """The three results of one page load over one shared, minute-reduced relation."""
    start, end = parse_range(start, end)
    resolution = choose_resolution(resolution, start, end)
    shared = (
        in_range(relation, start, end)
        .groupBy("campaign_id", bucket(F.col("event_ts"), "minute").alias("event_ts"))
        .agg(*sums())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    return Dashboard(
        summary(shared, start, end, source),
        by_campaign(shared),
        series(shared, start, end, resolution),
        resolution,
        shared,
    )
