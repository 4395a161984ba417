"""Stream operators bounded by time: billing suppression, bounded dedup, delayed finalisation."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.operators.suppression import suppress_repeats
from adtally.schemas import UNKNOWN

ACCEPTED = "bid_id STRING, seq BIGINT, arrival_ts TIMESTAMP, accepted_date DATE, batch BIGINT"
DAY = timedelta(hours=24)


def accepted_so_far(spark: SparkSession, root: str) -> DataFrame:
    """What :func:`suppress_into` has accepted."""
    return spark.read.schema(ACCEPTED).parquet(root)


def suppress_into(
    billing: DataFrame, root: str, checkpoint: str, window: timedelta = DAY, trigger: dict | None = None
) -> StreamingQuery:
    """Accepted billing requests of a stream of ``bid_id, seq, arrival_ts``, as a table at ``root``.

    A micro-batch is judged by the batch rule, after what an event accepted earlier still blocks has left. So the
    only state is the table itself, of which the last ``window`` is read: it is partitioned by date, and older
    dates are not opened. A batch that runs again replaces its own partitions.
    """
    spark = billing.sparkSession
    spark.createDataFrame([], ACCEPTED).write.mode("append").parquet(root)

    def judge(rows: DataFrame, number: int) -> None:
        own = rows.sparkSession
        first = rows.agg(F.min("arrival_ts")).first()[0]
        if first is None:
            return
        since = first - window
        earlier = accepted_so_far(own, root).where(
            (F.col("accepted_date") >= F.lit(since.date()) - F.expr("INTERVAL 1 DAY"))
            & (F.col("arrival_ts") > F.lit(since)) & (F.col("batch") < number)
        )
        last = earlier.groupBy(F.col("bid_id").alias("_id")).agg(F.max("arrival_ts").alias("_last"))
        fresh = rows.select("bid_id", "seq", "arrival_ts").join(last, F.col("bid_id") == F.col("_id"), "left")
        free = fresh.where(F.col("_last").isNull() | (F.col("arrival_ts") >= F.col("_last") + F.lit(window)))
        picked = suppress_repeats(free, "bid_id", "arrival_ts", "seq", window).where("accepted")
        (
            picked.select("bid_id", "seq", "arrival_ts", F.to_date("arrival_ts").alias("accepted_date"), F.lit(number).alias("batch"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("accepted_date", "batch")
            .parquet(root)
        )

    return (
        billing.select("bid_id", "seq", "arrival_ts")
        .writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def dedup_within(events: DataFrame, keep: timedelta, ts: str = "event_ts") -> DataFrame:
    """Bounded first-write dedup: forgets an id ``keep`` after its event time."""
    delay = f"{int(keep.total_seconds())} seconds"
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["bid_id"])


def finalise_stream(
    bids: DataFrame, impressions: DataFrame, wait: timedelta, max_bid_age: timedelta
) -> DataFrame:
    """Matched or unknown, said once: the streaming form of ``unknown_after_wait``.

    A stream-stream left outer join with a time bound; an impression comes out as
    unknown when the watermark has passed its wait. Both inputs carry a watermark on
    ``event_ts`` and are unique per id, as :func:`dedup_within` leaves them.
    """
    left = impressions.select("bid_id", "event_ts")
    right = bids.select(F.col("bid_id").alias("b_id"), "campaign_id", F.col("event_ts").alias("b_ts"))
    in_time = (
        (F.col("bid_id") == F.col("b_id"))
        & (F.col("b_ts") <= F.col("event_ts") + F.expr(f"INTERVAL {int(wait.total_seconds())} SECONDS"))
        & (F.col("b_ts") >= F.col("event_ts") - F.expr(f"INTERVAL {int(max_bid_age.total_seconds())} SECONDS"))
    )
    return left.join(right, in_time, "left_outer").select(
        "bid_id",
        F.coalesce("campaign_id", F.lit(UNKNOWN)).alias("campaign_id"),
        "event_ts",
        F.when(F.col("b_id").isNull(), F.lit("unknown")).otherwise(F.lit("matched")).alias("outcome"),
    )
