"""The request side: campaign choice, bid events and billing outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions import json_fields as J
from adtally.operators.suppression import suppress_repeats
from adtally.schemas import (
    BID_REQUEST,
    BILLING_REQUEST,
    CAMPAIGN_RULES,
    CREATIVE_URLS,
    DEFAULT_CAMPAIGN,
)


def campaign_for(user_idfv: Column) -> Column:
    """The campaign of a user; NULL is no fill. The rules are a fixed, tiny list."""
    chosen = F
    for user, campaign in CAMPAIGN_RULES.items():
        chosen = chosen.when(user_idfv == user, F.lit(campaign))
    return chosen.otherwise(F.lit(DEFAULT_CAMPAIGN))


def creative_for(campaign_id: Column) -> Column:
    chosen = F
    for campaign, url in CREATIVE_URLS.items():
        chosen = chosen.when(campaign_id == campaign, F.lit(url))
    return chosen


def select_campaign(requests: DataFrame) -> DataFrame:
    """Adds ``campaign_id`` and ``creative_url``; both NULL for a no-fill request."""
    return requests.withColumn("campaign_id", campaign_for(F.col("user_idfv"))).withColumn(
        "creative_url", creative_for(F.col("campaign_id"))
    )


def decode_requests(bodies: DataFrame) -> DataFrame:
    """Bodies in ``value`` to ``user_idfv``, ``app_bundle``, ``placement_id`` and ``malformed``.

    A malformed body has empty fields; its request is answered with an error and gets no campaign.
    """
    value, odd = F.col("value"), F.col("_odd")
    strict_failure = J.is_no_object(value, odd, only=False) | J.has_wrong_type(
        odd, J.text_fields(BID_REQUEST), only=False
    )
    rows = (
        bodies.withColumn("_usual", J.encoder_form(value, BID_REQUEST))
        .withColumns({"_doc": F.from_json(value, BID_REQUEST), "_odd": F.when(~F.col("_usual"), J.parse(value, only=False))})
        .withColumn("_malformed", F.when(F.col("_usual"), F.lit(False)).otherwise(strict_failure))
    )
    fields = {
        name: F.when(F.col("_malformed"), F.lit("")).otherwise(J.value_of(F.col("_doc"), BID_REQUEST[name]))
        for name in ("user_idfv", "app_bundle", "placement_id")
    }
    return J.unpack(rows, **fields, malformed=F.col("_malformed"))


def fill_counts(requests: DataFrame) -> DataFrame:
    """How many requests were filled and how many were not."""
    return select_campaign(requests).agg(
        F.count_if(F.col("campaign_id").isNotNull()).alias("filled"),
        F.count_if(F.col("campaign_id").isNull()).alias("no_fill"),
    )


def _id(prefix: str) -> Column:
    """An id that a replay reproduces: a digest of the record's place in the log."""
    return F.sha2(
        F.concat_ws("|", F.lit(prefix), F.col("topic"), F.col("partition"), F.col("offset")), 256
    )


def bid_events(requests: DataFrame, base_url: str = "http://localhost:8080") -> DataFrame:
    """Filled requests as bid events, together with the response fields.

    The event time is the server's arrival time, not the client's timestamp.
    """
    return (
        select_campaign(requests)
        .where(F.col("campaign_id").isNotNull())
        .select(
            _id("request").alias("request_id"),
            _id("bid").alias("bid_id"),
            "user_idfv",
            "campaign_id",
            "placement_id",
            F.unix_seconds("arrival_ts").alias("timestamp"),
            "creative_url",
            F.lit(f"{base_url}/v1/billing").alias("billing_url"),
        )
    )


def classify_billing(billing: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``seq, value, arrival_ts`` to one outcome per request.

    Outcomes: ``malformed``, ``missing_id``, ``duplicate`` (within 24 h of an
    accepted request for that bid) and ``accepted``.
    """
    value, odd = F.col("value"), F.col("_odd")
    strict_failure = J.is_no_object(value, odd, only=False) | J.has_wrong_type(
        odd, J.text_fields(BILLING_REQUEST), only=False
    )
    rows = (
        billing.select("seq", "arrival_ts", "value")
        .withColumn("_usual", J.encoder_form(value, BILLING_REQUEST))
        .withColumns(
            {
                "_doc": F.from_json(value, BILLING_REQUEST),
                "_odd": F.when(~F.col("_usual"), J.parse(value, only=False)),
            }
        )
        .withColumn("_malformed", F.when(F.col("_usual"), F.lit(False)).otherwise(strict_failure))
    )
    bid_id = J.value_of(F.col("_doc"), BILLING_REQUEST["bid_id"])
    decoded = (
        J.unpack(
            rows,
            bid_id=F.when(F.col("_malformed"), F.lit("")).otherwise(bid_id),
            malformed=F.col("_malformed"),
        )
        .withColumn(
            "outcome",
            F.when(F.col("malformed"), F.lit("malformed")).when(
                F.col("bid_id") == "", F.lit("missing_id")
            ),
        )
        .drop("value", "malformed")
    )
    rejected = decoded.where(F.col("outcome").isNotNull()).select("seq", "bid_id", "arrival_ts", "outcome")
    options = {} if hot_rows is None else {"hot_rows": hot_rows}
    judged = suppress_repeats(
        decoded.where(F.col("outcome").isNull()), key="bid_id", ts="arrival_ts", order="seq", **options
    ).select(
        "seq",
        "bid_id",
        "arrival_ts",
        F.when(F.col("accepted"), F.lit("accepted")).otherwise(F.lit("duplicate")).alias("outcome"),
    )
    return rejected.unionByName(judged)


def impression_events(outcomes: DataFrame) -> DataFrame:
    """Accepted billing requests as impression events; campaign and user are empty."""
    return outcomes.where(F.col("outcome") == "accepted").select(
        "bid_id",
        F.lit("").alias("campaign_id"),
        F.lit("").alias("user_idfv"),
        F.unix_seconds("arrival_ts").alias("timestamp"),
    )
