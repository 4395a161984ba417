"""Event topics in and out. Kafka in production, files where no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.schemas import BID_EVENT, BID_TOPIC, IMPRESSION_EVENT, IMPRESSION_TOPIC, RECORD


def encode(events: DataFrame, schema: T.StructType, topic: str) -> DataFrame:
    """Events as topic rows: key is the bid id, value is the JSON document."""
    return events.select(
        F.lit(topic).alias("topic"),
        F.col("bid_id").alias("key"),
        F.to_json(F.struct(*schema.names)).alias("value"),
    )


def encode_bids(events: DataFrame) -> DataFrame:
    return encode(events, BID_EVENT, BID_TOPIC)


def encode_impressions(events: DataFrame) -> DataFrame:
    return encode(events, IMPRESSION_EVENT, IMPRESSION_TOPIC)


def write_topics(rows: DataFrame, servers: str) -> None:
    """Append encoded rows to Kafka; the ``topic`` column routes each row."""
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def _kafka_records(raw: DataFrame) -> DataFrame:
    """Kafka columns to the record contract; arrival order is the broker's timestamp."""
    return raw.select(
        "topic",
        "partition",
        "offset",
        F.unix_micros("timestamp").alias("seq"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival_ts"),
    )


def kafka_stream(spark: SparkSession, servers: str, max_per_trigger: int | None = None) -> DataFrame:
    """Both topics as one stream. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", f"{BID_TOPIC},{IMPRESSION_TOPIC}")
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return _kafka_records(reader.load())


def kafka_batch(spark: SparkSession, servers: str) -> DataFrame:
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", f"{BID_TOPIC},{IMPRESSION_TOPIC}")
        .load()
    )
    return _kafka_records(raw)


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RECORD,
    files_per_trigger: int | None = None,
    only: str | None = None,
) -> DataFrame:
    """Parquet files as they appear. ``only`` is a file-name pattern within ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(path)


def topic_sample(records: DataFrame, topics: list[str], limit: int = 100) -> DataFrame:
    """The first ``limit`` values of each topic by (partition, offset)."""
    sample = None
    for topic in topics:
        first = (
            records.where(F.col("topic") == topic)
            .orderBy("partition", "offset")
            .limit(limit)
            .select("topic", "partition", "offset", "value")
        )
        sample = first if sample is None else sample.unionByName(first)
    return sample
