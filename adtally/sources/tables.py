"""The given tables as topics, changes, request logs and offsets.

One mapping per function; FIXTURES.md section 2 has the same rules as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.operators.requests import campaign_for
from adtally.schemas import BID, BID_TOPIC, IMPRESSION, IMPRESSION_TOPIC

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema is given, so no job has to read a footer first."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _bucket_number() -> Column:
    """The ``k`` in ``props``."""
    return F.get_json_object("props", "$.k")


def _user_idfv() -> Column:
    user = F.col("user_id")
    return (
        F.when(user % 10 <= 3, F.lit("123"))
        .when(user % 10 <= 6, F.lit("456"))
        .when(user % 10 == 7, F.lit("789"))
        .otherwise(F.concat(F.lit("u-"), user.cast("string")))
    )


def _bid_id() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), _bucket_number())


# Which events ask for a bid, and which bill one.
ASKS = ["view", "signup", "purchase"]
BILLS = ["click", "error"]


def _place() -> list[Column]:
    """Where a record lies in its log, and when it came."""
    return [
        F.col("event_id").alias("seq"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
    ]


def _placement() -> Column:
    return F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string"))


def requests(rows: DataFrame) -> DataFrame:
    """Bid requests, no-fill ones included, with their place in the log."""
    return rows.where(F.col("event_type").isin(ASKS)).select(
        F.lit("requests").alias("topic"),
        *_place(),
        F.col("event_id").alias("offset"),
        _user_idfv().alias("user_idfv"),
        _placement().alias("placement_id"),
    )


def request_bodies(rows: DataFrame) -> DataFrame:
    """Bid requests as JSON bodies, some of them cut off and some with a number for a name."""
    epoch = F.unix_seconds("arrival_ts").alias("timestamp")
    app = F.lit("app").alias("app_bundle")
    value = F.to_json(F.struct("user_idfv", app, "placement_id", epoch))
    number = F.to_json(F.struct(F.col("seq").alias("user_idfv"), app, "placement_id", epoch))
    damaged = F.when(F.col("seq") % 97 == 0, F.lit('{"user_idfv":"broken"')).when(F.col("seq") % 89 == 0, number)
    return requests(rows).select("seq", damaged.otherwise(value).alias("value"))


def changes(rows: DataFrame, kind: str | None = None) -> DataFrame:
    """Valid topic records in arrival order: what the per-bid fold reads.

    ``kind`` keeps one topic. All filters are on stored columns, so they reach the scan.
    """
    filled = F.col("user_id") % 10 != 7
    if kind == BID:
        rows = rows.where(F.col("event_type").isin(ASKS) & filled)
        label = F.lit(BID)
    elif kind == IMPRESSION:
        rows = rows.where(F.col("event_type").isin(BILLS))
        label = F.lit(IMPRESSION)
    else:
        is_bill = F.col("event_type").isin(BILLS)
        rows = rows.where(F.col("event_type").isin(ASKS + BILLS) & (is_bill | filled))
        label = F.when(is_bill, F.lit(IMPRESSION)).otherwise(F.lit(BID))
    user = _user_idfv()
    return rows.select(
        *_place(),
        label.alias("kind"),
        _bid_id().alias("bid_id"),
        F.when(label == BID, campaign_for(user)).alias("campaign_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        user.alias("user_idfv"),
        _placement().alias("placement_id"),
    )


def records(rows: DataFrame, broken: bool = False, kind: str | None = None) -> DataFrame:
    """The two topics as JSON records. ``broken`` damages some of the values."""
    is_bid = F.col("kind") == BID
    epoch = F.unix_seconds("event_ts").alias("timestamp")
    sent = epoch
    if broken:  # microseconds taken for seconds, and the largest number of 64 bits
        sent = (
            F.when(F.col("seq") % 83 == 0, epoch * 1_000_000)
            .when(F.col("seq") % 79 == 0, F.lit((1 << 63) - 1))
            .otherwise(epoch)
            .alias("timestamp")
        )
    bid_value = F.to_json(
        F.struct("request_id", "bid_id", "user_idfv", "campaign_id", "placement_id", sent)
    )
    impression_value = F.to_json(
        F.struct("bid_id", F.lit("").alias("campaign_id"), F.lit("").alias("user_idfv"), sent)
    )
    value = F.when(is_bid, bid_value).otherwise(impression_value)
    if broken:
        value = (
            F.when(F.col("seq") % 97 == 0, F.lit('{"bid_id":"broken"'))
            .when(F.col("seq") % 89 == 0, F.to_json(F.struct(epoch)))
            .otherwise(value)
        )
    return changes(rows, kind).select(
        F.when(is_bid, F.lit(BID_TOPIC)).otherwise(F.lit(IMPRESSION_TOPIC)).alias("topic"),
        "partition",
        F.col("seq").alias("offset"),
        "seq",
        F.col("bid_id").alias("key"),
        value.alias("value"),
        "arrival_ts",
    )


def billing_requests(rows: DataFrame) -> DataFrame:
    """Billing bodies of the impression side, some of them damaged."""
    return records(rows, broken=True, kind=IMPRESSION).select("seq", "value", "arrival_ts")


def topic_offsets(rows: DataFrame) -> DataFrame:
    """Earliest and latest offset per topic partition.

    Offsets count records from 0, so a grouped count gives both ends.
    """
    return (
        changes(rows)
        .groupBy(
            F.when(F.col("kind") == BID, F.lit(BID_TOPIC)).otherwise(F.lit(IMPRESSION_TOPIC)).alias("topic"),
            "partition",
        )
        .agg(F.lit(0).cast("bigint").alias("earliest"), F.count("*").alias("latest"))
    )


def order_changes(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders as bids and line items as impressions; day granularity.

    The first impression is the earliest ship date, so the date is the order.
    """
    bids = orders.where(F.col("o_orderstatus") != "P").select(
        F.lit(0).cast("bigint").alias("seq"),
        F.lit(BID).alias("kind"),
        F.col("o_orderkey").alias("bid_id"),
        F.col("o_orderpriority").alias("campaign_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
    )
    impressions = lineitem.select(
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("seq"),
        F.lit(IMPRESSION).alias("kind"),
        F.col("l_orderkey").alias("bid_id"),
        F.lit(None).cast("string").alias("campaign_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_ts"),
    )
    return bids.unionByName(impressions)


def request_log(rows: DataFrame) -> DataFrame:
    """Events as a load run's request log."""
    k = _bucket_number().cast("int")
    is_error = F.col("event_type") == "error"
    ts = F.col("ts").cast("timestamp")
    stage = (
        F.when(ts < F.lit("2024-01-09").cast("timestamp"), F.lit("steady"))
        .when(ts < F.lit("2024-01-16").cast("timestamp"), F.lit("burst1"))
        .when(ts < F.lit("2024-01-23").cast("timestamp"), F.lit("burst2"))
        .otherwise(F.lit("recovery"))
    )
    op = (
        F.when(F.col("event_type") == "view", F.lit("bid"))
        .when(F.col("event_type") == "click", F.lit("billing_matched"))
        .when(F.col("event_type") == "purchase", F.lit("billing_unknown"))
        .when(F.col("event_type") == "signup", F.lit("billing_duplicate"))
        .otherwise(F.lit("billing_invalid"))
    )
    status = (
        F.when(is_error & (k % 10 == 3), F.lit(0))
        .when(is_error & (k % 10 == 1), F.lit(500))
        .when(is_error & (k % 10 == 5), F.lit(302))
        .when(is_error, F.lit(400))
        .when((F.col("event_type") == "view") & (F.col("user_id") % 10 == 7), F.lit(204))
        .otherwise(F.lit(200))
    )
    return rows.select(
        F.when(F.col("user_id") % 2 == 0, F.lit("run-a")).otherwise(F.lit("run-b")).alias("run_id"),
        stage.alias("stage"),
        op.alias("op"),
        ts.alias("ts"),
        status.alias("status_code"),
        (is_error & (k % 10 == 3)).alias("network_error"),
        (is_error & (k % 20 == 3)).alias("timeout"),
        (k % 3).cast("bigint").alias("retries"),
        _bid_id().alias("bid_id"),
        ((F.col("event_type") == "click") & (k % 10 == 0)).alias("delayed"),
    )
