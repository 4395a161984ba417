"""Fact tables on storage: Parquet by event date, optionally bucketed by bid id."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.times import as_utc
from adtally.schemas import BID_EVENT, IMPRESSION_EVENT

#: Rows per fact file; keeps a large date in many files and a small one in few.
ROWS_PER_FILE = 5_000_000


def write_facts(facts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Partitioned by ``event_date``, sorted by time within files for tight statistics.

    The rebalance gathers small dates into few files and splits a date that holds
    most of the rows over many tasks.
    """
    (
        facts.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_ts")
        .write.mode(mode)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("event_date")
        .parquet(path)
    )


def write_bucketed(facts: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """As a table bucketed and sorted by bid id: joins and folds on it do not shuffle."""
    writer = (
        facts.repartition(buckets, "bid_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "bid_id")
        .sortBy("bid_id")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def range_scan(facts: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Facts of ``[start, end)``; adds the derived date predicate that prunes partitions."""
    start, end = as_utc(start), as_utc(end)
    rows = facts.where((F.col("event_ts") >= F.lit(start)) & (F.col("event_ts") < F.lit(end)))
    if "event_date" in facts.columns:
        # end is exclusive, so its date holds rows only if end is not midnight.
        last = (end - timedelta(microseconds=1)).date()
        rows = rows.where(F.col("event_date").between(F.lit(start.date()), F.lit(last)))
    return rows


def since(facts: DataFrame, instant: datetime) -> DataFrame:
    instant = as_utc(instant)
    rows = facts.where(F.col("event_ts") >= F.lit(instant))
    if "event_date" in facts.columns:
        rows = rows.where(F.col("event_date") >= F.lit(instant.date()))
    return rows


def replay_scan(facts: DataFrame, instant: datetime, kind: str) -> DataFrame:
    """Stored facts since an instant, decoded again from their raw JSON.

    Unordered: what a replay builds from them does not depend on the order.
    """
    schema = BID_EVENT if kind == "bid" else IMPRESSION_EVENT
    return since(facts, instant).select("event_ts", F.from_json("raw_json", schema).alias("e")).select(
        "event_ts", "e.*"
    )


def retained(rows: DataFrame, now: datetime, days: int = 31, ts: str = "event_ts") -> DataFrame:
    """Rows not yet expired: what remains when older data is dropped."""
    horizon = as_utc(now) - timedelta(days=days)
    kept = rows.where(F.col(ts) >= F.lit(horizon))
    if "event_date" in rows.columns:
        kept = kept.where(F.col("event_date") >= F.lit(horizon.date()))
    return kept
