"""Joins between bid and impression facts. Both sides are unique per bid id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.times import as_utc
from adtally.schemas import COUNTERS, UNKNOWN
from adtally.sources.facts import range_scan


def _bid_side(bids: DataFrame) -> DataFrame:
    return bids.select("bid_id", "campaign_id")


def matched_impressions(impressions: DataFrame, bids: DataFrame) -> DataFrame:
    return impressions.select("bid_id", "event_ts").join(_bid_side(bids), "bid_id")


def unknown_impressions(impressions: DataFrame, bids: DataFrame) -> DataFrame:
    return impressions.select("bid_id", "event_ts").join(bids.select("bid_id"), "bid_id", "left_anti")


def attributed_impressions(impressions: DataFrame, bids: DataFrame) -> DataFrame:
    """Every impression with its bid's campaign, or UNKNOWN."""
    return (
        impressions.select("bid_id", "event_ts")
        .join(_bid_side(bids).withColumn("_found", F.lit(True)), "bid_id", "left")
        .select(
            "bid_id",
            "event_ts",
            F.coalesce("campaign_id", F.lit(UNKNOWN)).alias("campaign_id"),
            F.coalesce("_found", F.lit(False)).alias("matched"),
        )
    )


def attributed_from_ledger(ledger: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """The impressions of ``[start, end)`` as :func:`attributed_impressions` gives them, from stored ledger rows.

    The ledger has settled each impression's campaign already, under the impression's own time. So a range reads the
    ledger's rows of that range and no bid, however old; a correction cancels the row it corrects.
    """
    start, end = as_utc(start), as_utc(end)
    rows = ledger.where((F.col("event_ts") >= F.lit(start)) & (F.col("event_ts") < F.lit(end)))
    matched, unknown = F.sum(COUNTERS[1]), F.sum(COUNTERS[2])
    return (
        rows.where((F.col(COUNTERS[1]) != 0) | (F.col(COUNTERS[2]) != 0))
        .groupBy("bid_id", "event_ts", "campaign_id")
        .agg((matched + unknown).alias("_n"), (matched > 0).alias("matched"))
        .where("_n != 0")
        .select("bid_id", "event_ts", "campaign_id", "matched")
    )


def deltas_from_facts(
    bids: DataFrame,
    impressions: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    join_bids: DataFrame | None = None,
) -> DataFrame:
    """Counter rows of ``[start, end)`` from stored fact tables.

    The range filters reach both scans (and prune ``event_date`` partitions). The
    bid side of the join has no time bound: a bid of any age matches. ``join_bids``
    is that side when it is not ``bids`` itself. With tables bucketed by bid id the
    join needs no shuffle.
    """
    join_bids = bids if join_bids is None else join_bids
    in_bids, in_imps = bids, impressions
    if start is not None:
        in_bids, in_imps = range_scan(bids, start, end), range_scan(impressions, start, end)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    bid_rows = in_bids.select(
        "campaign_id",
        "event_ts",
        one.alias("bid_requests"),
        zero.alias("deduped_impressions"),
        zero.alias("unknown_impressions"),
    )
    matched = F.col("matched").cast("bigint")
    impression_rows = attributed_impressions(in_imps, join_bids).select(
        "campaign_id",
        "event_ts",
        zero.alias("bid_requests"),
        matched.alias("deduped_impressions"),
        (one - matched).alias("unknown_impressions"),
    )
    return bid_rows.unionByName(impression_rows)


def unmatched_bids(bids: DataFrame, impressions: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` bids without an impression, in first-seen order."""
    return (
        bids.select("bid_id", "seq")
        .join(impressions.select("bid_id"), "bid_id", "left_anti")
        .orderBy("seq")
        .limit(max(limit, 0))
    )


def matched_bid_ids(bids: DataFrame, impressions: DataFrame) -> DataFrame:
    return bids.select("bid_id").join(impressions.select("bid_id"), "bid_id", "left_semi")
