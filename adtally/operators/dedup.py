"""First write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.functions.times import event_date
from adtally.schemas import BID, BID_SEEN, IMPRESSION_SEEN


def arrival_order(rows: DataFrame) -> list[str]:
    """The columns that order records of one topic and one key.

    Topics are keyed by bid id, so all records of an id share a partition and their
    offsets are the order of writing, whatever the producers' clocks say. Relations
    without offsets are ordered by ``seq``.
    """
    return ["offset", "seq"] if "offset" in rows.columns else ["seq"]


def first_write(rows: DataFrame, key: str = "bid_id", order: list[str] | None = None) -> DataFrame:
    """The first row per key of one topic's rows.

    Ranking with a limit of one is also applied before the shuffle, so a key with
    very many copies sends one row per map task, not all of them.
    """
    window = Window.partitionBy(key).orderBy(*(order or arrival_order(rows)))
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def bid_facts(bid_events: DataFrame) -> DataFrame:
    return first_write(bid_events).select(
        "bid_id",
        "request_id",
        "campaign_id",
        "user_idfv",
        "placement_id",
        "event_ts",
        "raw_json",
        F.col("arrival_ts").alias("ingested_at"),
        "seq",
        event_date(F.col("event_ts")).alias("event_date"),
    )


def impression_facts(impression_events: DataFrame) -> DataFrame:
    return first_write(impression_events).select(
        "bid_id",
        "event_ts",
        "raw_json",
        F.col("arrival_ts").alias("ingested_at"),
        "seq",
        event_date(F.col("event_ts")).alias("event_date"),
    )


def change_log(changes: DataFrame) -> DataFrame:
    """One row per first insert of a bid or an impression, numbered by ``seq``.

    One ranking over (kind, bid_id) serves both fact tables.
    """
    window = Window.partitionBy("bid_id", "kind").orderBy(*arrival_order(changes))
    return (
        changes.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .select(
            "seq",
            F.when(F.col("kind") == BID, F.lit(BID_SEEN))
            .otherwise(F.lit(IMPRESSION_SEEN))
            .alias("event_type"),
            F.col("bid_id").alias("entity_id"),
            "event_ts",
            F.col("raw_json").alias("payload"),
        )
    )
