"""Do stored layers hold the same rows? Order-free digests per layer, date and bucket.

A digest is a count and two sums of hashes, each row with its sign or counter as weight. So it does not depend on
order, digests of batches add up, and a correction in the ledger takes its hash back. Layers of one subject agree
in a cell (date and bucket of the key) when count and sums are equal; only cells that differ have to be read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.times import bucket, event_date
from adtally.schemas import BID_SEEN, COUNTERS, IMPRESSION_SEEN

#: Parts of a date; a cell that differs is one of them.
BUCKETS = 64
SUMS = ("rows", "low", "high")
_PART = (1 << 31) - 1


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _entry(subject: str, layer: str, key: str, ts: Column, weight: Column) -> Column:
    """What a row adds to its cell; null if that is nothing."""
    # two halves of 31 bits: sums of two thousand million rows stay within 64 bits
    digest = F.xxhash64(F.col(key), ts)
    parts = (F.lit(1), digest.bitwiseAND(F.lit(_PART)), F.shiftrightunsigned(digest, 33))
    sums = [(weight * part).cast("bigint").alias(name) for name, part in zip(SUMS, parts)]
    cell = [event_date(ts).alias("event_date"), bucket_of(key).alias("bucket")]
    return F.when(weight != 0, F.struct(F.lit(subject).alias("subject"), F.lit(layer).alias("layer"), *cell, *sums))


def _entries(rows: DataFrame, *entries: Column) -> DataFrame:
    return rows.select(F.inline(F.filter(F.array(*entries), lambda entry: entry.isNotNull())))


def of_facts(bids: DataFrame, impressions: DataFrame) -> DataFrame:
    """Entries of fact tables; these and those below are digests of single rows, to be :func:`added` up."""
    at, one = F.col("event_ts"), F.lit(1)
    return _entries(bids, _entry("bids", "facts", "bid_id", at, one)).unionByName(
        _entries(impressions, _entry("impressions", "facts", "bid_id", at, one))
    )


def of_change_log(log: DataFrame) -> DataFrame:
    return _entries(
        log,
        *[
            _entry(subject, "change log", "entity_id", F.col("event_ts"), (F.col("event_type") == kind).cast("int"))
            for subject, kind in (("bids", BID_SEEN), ("impressions", IMPRESSION_SEEN))
        ],
    )


def of_ledger(ledger: DataFrame) -> DataFrame:
    """An impression's rows sum to one; its correction takes the first one back."""
    bids, matched, unknown = (F.col(name) for name in COUNTERS)
    at = F.col("event_ts")
    return _entries(
        ledger,
        _entry("bids", "ledger", "bid_id", at, bids),
        _entry("impressions", "ledger", "bid_id", at, matched + unknown),
        *_counters("event_ts", "ledger"),
    )


def of_minutes(minutes: DataFrame) -> DataFrame:
    return _entries(minutes, *_counters("minute_ts", "minutes"))


def _counters(ts: str, layer: str) -> list[Column]:
    return [_entry(name, layer, "campaign_id", bucket(F.col(ts), "minute"), F.col(name)) for name in COUNTERS]


def added(digests: DataFrame) -> DataFrame:
    """Digests of many rows or batches, added up, partly before the shuffle."""
    return digests.groupBy("subject", "layer", "event_date", "bucket").agg(
        *[F.sum(name).cast("bigint").alias(name) for name in SUMS]
    )


def compare(digests: DataFrame) -> DataFrame:
    """``subject, event_date, bucket, rows, ok``: a layer without a cell has nothing there."""
    total = added(digests)
    layers = total.groupBy("subject").agg(F.countDistinct("layer").alias("layers"))
    whole = F.struct(*SUMS)
    nothing = F.struct(*[F.lit(0).cast("bigint").alias(name) for name in SUMS])
    cells = total.groupBy("subject", "event_date", "bucket").agg(
        F.count("*").alias("present"), F.min(whole).alias("least"), F.max(whole).alias("most")
    )
    same = (F.col("least") == F.col("most")) & ((F.col("present") == F.col("layers")) | (F.col("most") == nothing))
    return cells.join(layers, "subject").select(
        "subject", "event_date", "bucket", F.greatest("least.rows", "most.rows").alias("rows"), same.alias("ok")
    )
