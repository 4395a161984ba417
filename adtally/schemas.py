"""Column contracts shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

BID_TOPIC = "bid-requests"
IMPRESSION_TOPIC = "impressions"

BID = "bid"
IMPRESSION = "impression"

UNKNOWN = "UNKNOWN"

#: The three counters every metric relation carries.
COUNTERS = ["bid_requests", "deduped_impressions", "unknown_impressions"]

BID_EVENT = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("bid_id", T.StringType()),
        T.StructField("user_idfv", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("placement_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

IMPRESSION_EVENT = T.StructType(
    [
        T.StructField("bid_id", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("user_idfv", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

BID_REQUEST = T.StructType(
    [
        T.StructField("user_idfv", T.StringType()),
        T.StructField("app_bundle", T.StringType()),
        T.StructField("placement_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

BILLING_REQUEST = T.StructType(
    [
        T.StructField("bid_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

#: One consumed topic record. ``seq`` is the arrival order across topics.
RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("arrival_ts", T.TimestampType()),
    ]
)

# Event types of the change log.
BID_SEEN = "bid_seen"
IMPRESSION_SEEN = "impression_seen"

# Which user id gets which campaign. None means no fill.
CAMPAIGN_RULES = {
    "123": "campaign1",
    "456": "campaign2",
    "789": None,
}
DEFAULT_CAMPAIGN = "campaign_default"
CREATIVE_URLS = {
    "campaign1": "https://example.com/creative/campaign1.png",
    "campaign2": "https://example.com/creative/campaign2.png",
    "campaign_default": "https://example.com/creative/campaign_default.png",
}
