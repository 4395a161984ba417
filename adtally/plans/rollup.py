"""Minute roll-ups, lifetime totals, rebuild and multi-resolution roll-ups."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.times import as_utc, bucket, ceil_to, floor_to
from adtally.operators.attribution import deltas_from_facts
from adtally.plans.metrics import any_count, sums
from adtally.schemas import COUNTERS
from adtally.sources.facts import since


def minute_campaign(deltas: DataFrame) -> DataFrame:
    """Counters per campaign and minute. Buckets corrected down to nothing are left out."""
    return (
        deltas.groupBy("campaign_id", bucket(F.col("event_ts"), "minute").alias("minute_ts"))
        .agg(*sums())
        .where(any_count())
    )


def minute_global(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(bucket(F.col("event_ts"), "minute").alias("minute_ts")).agg(*sums()).where(any_count())


def minute_global_from(minutes: DataFrame) -> DataFrame:
    """The global roll-up from the per-campaign one."""
    return minutes.groupBy("minute_ts").agg(*sums()).where(any_count())


def lifetime_campaign(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("campaign_id").agg(*sums())


def campaign_registry(ledger: DataFrame) -> DataFrame:
    """Every campaign ever counted, UNKNOWN included, sorted. Takes the ledger, which
    remembers that something was unknown even after it was corrected."""
    return ledger.select("campaign_id").distinct().orderBy("campaign_id")


def aligned_range(minutes: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Whole minutes that cover ``[start, end)``: floor of start to ceiling of end."""
    start, end = floor_to(as_utc(start), "minute"), ceil_to(as_utc(end), "minute")
    return minutes.where((F.col("minute_ts") >= F.lit(start)) & (F.col("minute_ts") < F.lit(end)))


def rebuild(
    bids: DataFrame, impressions: DataFrame, now: datetime, days: int = 30, recent_bids_only: bool = False
) -> DataFrame:
    """The per-campaign minutes of the last ``days`` days, recomputed from facts.

    Impressions are attributed against bids of any age. ``recent_bids_only`` looks
    at recent bids alone, so an impression of an older bid comes out as UNKNOWN.
    """
    horizon = as_utc(now) - timedelta(days=days)
    recent_bids, recent_impressions = since(bids, horizon), since(impressions, horizon)
    if recent_bids_only:
        return minute_campaign(deltas_from_facts(recent_bids, recent_impressions))
    return minute_campaign(deltas_from_facts(recent_bids, recent_impressions, join_bids=bids))


def multi_resolution(deltas: DataFrame, resolutions: tuple[str, ...] = ("second", "minute", "hour", "day")) -> DataFrame:
    """One table with several bucket widths.

    Rows are first reduced to the finest width; only those are fanned out.
    """
    finest = (
        deltas.groupBy("campaign_id", bucket(F.col("event_ts"), resolutions[0]).alias("ts")).agg(*sums())
    )
    levels = F.array(
        *[
            F.struct(F.lit(name).alias("resolution"), bucket(F.col("ts"), name).alias("bucket_ts"))
            for name in resolutions
        ]
    )
    return (
        finest.select("campaign_id", *COUNTERS, F.inline(levels))
        .groupBy("resolution", "campaign_id", "bucket_ts")
        .agg(*sums())
        .where(any_count())
    )


def growth(ledger: DataFrame, resolution: str = "day") -> DataFrame:
    """Totals as known after each arrival bucket: a running sum over the ledger.

    Needs ``known_ts``, the time a change became known. The running window sees one
    row per hour or day, not the ledger.
    """
    if resolution not in ("hour", "day"):
        raise ValueError("growth is per hour or per day")
    per_bucket = ledger.groupBy(bucket(F.col("known_ts"), resolution).alias("known_ts")).agg(*sums())
    upto = Window.orderBy("known_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_bucket.select(
        "known_ts", *[F.sum(name).over(upto).cast("bigint").alias(name) for name in COUNTERS]
    )
