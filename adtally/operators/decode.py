"""Topic records to typed events, with a quarantine instead of a log line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions import json_fields as J
from adtally.functions.times import event_time, is_storable
from adtally.schemas import (
    BID,
    BID_EVENT,
    BID_SEEN,
    BID_TOPIC,
    IMPRESSION,
    IMPRESSION_EVENT,
    IMPRESSION_SEEN,
    IMPRESSION_TOPIC,
)

INVALID_JSON = "invalid_json"
MISSING_REQUIRED = "missing_required"
BAD_TIMESTAMP = "bad_timestamp"


def _kind(topic: Column) -> Column:
    return (
        F.when(topic == BID_TOPIC, F.lit(BID))
        .when(topic == IMPRESSION_TOPIC, F.lit(IMPRESSION))
        .otherwise(F.raise_error(F.concat(F.lit("unexpected topic "), F.coalesce(topic, F.lit("null")))))
    )


def decode(records: DataFrame) -> DataFrame:
    """Decode both topics in one projection.

    Adds ``kind``, the event's fields, ``event_ts`` and ``reason``; ``reason`` is
    NULL for an accepted record. Works on static and streaming input alike.
    """
    value, is_bid = F.col("value"), F.col("kind") == BID
    usual = F.when(is_bid, J.encoder_form(value, BID_EVENT)).otherwise(J.encoder_form(value, IMPRESSION_EVENT))
    texts = F.when(is_bid, J.text_fields(BID_EVENT)).otherwise(J.text_fields(IMPRESSION_EVENT))
    odd = F.col("_odd")
    strict_failure = J.is_no_object(value, odd) | J.has_wrong_type(odd, texts)
    rows = (
        records.withColumn("kind", _kind(F.col("topic")))
        .withColumn("_usual", usual)
        .withColumns({"_doc": F.from_json(value, BID_EVENT), "_odd": F.when(~F.col("_usual"), J.parse(value))})
        .withColumn("_invalid", F.when(F.col("_usual"), F.lit(False)).otherwise(strict_failure))
    )
    rows = J.unpack(
        rows,
        **{field.name: J.value_of(F.col("_doc"), field) for field in BID_EVENT},
        invalid=F.col("_invalid"),
    )
    missing = (F.col("bid_id") == "") | (is_bid & (F.col("campaign_id") == ""))
    return (
        rows.withColumn(
            "reason",
            F.when(F.col("invalid"), F.lit(INVALID_JSON))
            .when(missing, F.lit(MISSING_REQUIRED))
            .when(~is_storable(F.col("timestamp")), F.lit(BAD_TIMESTAMP)),
        )
        .withColumn("event_ts", event_time(F.col("timestamp"), F.col("arrival_ts")))
        .drop("invalid")
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason")


def quarantine(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select(
        "topic", "partition", "offset", "seq", "value", "reason"
    )


def bids(decoded: DataFrame) -> DataFrame:
    return accepted(decoded).where(F.col("kind") == BID)


def impressions(decoded: DataFrame) -> DataFrame:
    return accepted(decoded).where(F.col("kind") == IMPRESSION)


def changes(decoded: DataFrame) -> DataFrame:
    """Accepted records in the shape the per-bid fold reads.

    An impression's own campaign field is not used: attribution comes from bids.
    """
    return accepted(decoded).select(
        "offset",
        "seq",
        "kind",
        "bid_id",
        F.when(F.col("kind") == BID, F.col("campaign_id")).alias("campaign_id"),
        "event_ts",
        "arrival_ts",
        "request_id",
        "user_idfv",
        "placement_id",
        F.col("value").alias("raw_json"),
    )


def changes_from_log(change_log: DataFrame) -> DataFrame:
    """Decode change-log rows by event type; any other type is an error.

    ``event_ts`` is the one stored with the change, so a zero timestamp keeps the
    instant it was given at ingest.
    """
    kind = (
        F.when(F.col("event_type") == BID_SEEN, F.lit(BID))
        .when(F.col("event_type") == IMPRESSION_SEEN, F.lit(IMPRESSION))
        .otherwise(
            F.raise_error(F.concat(F.lit("unsupported event type "), F.coalesce("event_type", F.lit("null"))))
        )
    )
    payload = F.from_json("payload", BID_EVENT)
    return change_log.select(
        "seq",
        kind.alias("kind"),
        F.col("entity_id").alias("bid_id"),
        F.when(F.col("event_type") == BID_SEEN, payload["campaign_id"]).alias("campaign_id"),
        "event_ts",
    )
