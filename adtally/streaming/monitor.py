"""How far a running stream has come: its progress as a table, and what is still ahead of it.

A log's position is a vector: one end offset per topic and partition. Offsets order the records of a partition whatever
their timestamps say, so the records before a vector, and the number behind it, do not change where timestamps are equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from adtally.session import shared_root

PROGRESS = "query_id STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT, end_offsets STRING, latest_offsets STRING"
#: Offsets as the Kafka source writes them: {"topic": {"partition": end}}.
OFFSETS = "map<string, map<string, bigint>>"


class ProgressLog(StreamingQueryListener):
    """Appends a row per micro-batch and source to the table at ``root``.

    Register it with ``spark.streams.addListener``. It only hears of batches that are committed to the checkpoint, so
    what it counts as done is done.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/adtally/progress"

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (str(p.id), p.batchId, p.timestamp, source.numInputRows, source.endOffset, source.latestOffset) for source in p.sources
        ]
        plain = self.spark.createDataFrame(rows, PROGRESS.replace("at TIMESTAMP", "at STRING"))
        plain.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(self.root)

    def table(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            return self.spark.createDataFrame([], PROGRESS)
        # a batch that ran again after a restart counts once
        return self.spark.read.schema(PROGRESS).parquet(self.root).dropDuplicates(["query_id", "batch_id", "end_offsets"])


def pending_rows(progress: DataFrame, records: DataFrame) -> DataFrame:
    """``pending``: records of the source that no committed batch has read. For sources without offsets, such as files."""
    done = progress.agg(F.coalesce(F.sum("input_rows"), F.lit(0))).scalar()
    return records.agg((F.count("*") - done).alias("pending"))


def vector(offsets: DataFrame, column: str) -> DataFrame:
    """``topic, partition, offset`` of offsets in the Kafka source's notation; the largest of many rows."""
    topics = offsets.select(F.explode(F.from_json(column, OFFSETS)).alias("topic", "ends"))
    places = topics.select("topic", F.explode("ends").alias("partition", "offset"))
    return places.groupBy("topic", F.col("partition").cast("int").alias("partition")).agg(F.max("offset").alias("offset"))


def ends(records: DataFrame) -> DataFrame:
    """The vector behind the last record of each partition."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))


def backlog_by_partition(latest: DataFrame, processed: DataFrame) -> DataFrame:
    """``topic, partition, pending``: end of the log minus end of what is processed; a partition never read is all ahead."""
    done = processed.select("topic", "partition", F.col("offset").alias("_done"))
    return latest.join(done, ["topic", "partition"], "left").select(
        "topic", "partition", F.greatest(F.col("offset") - F.coalesce("_done", F.lit(0)), F.lit(0)).cast("bigint").alias("pending")
    )


def before(records: DataFrame, position: DataFrame) -> DataFrame:
    """The records that lie before a vector: what a stream that stopped there has seen."""
    at = position.select("topic", "partition", F.col("offset").alias("_end"))
    return records.join(at, ["topic", "partition"]).where(F.col("offset") < F.col("_end")).drop("_end")
