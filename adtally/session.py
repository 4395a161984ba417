"""Session settings the engine relies on, and where it may keep working data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings. They are safe to set on a session somebody else created.
#: UTC: every bucket is a UTC bucket. Duplicate JSON keys: the last one wins.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Keyed streaming state lives on local disk with changelog uploads, not on the JVM heap.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Shuffled bytes per reduce task; AQE merges tasks that turn out smaller.
BYTES_PER_TASK = 128 * 1024 * 1024


def shuffle_conf(shuffled_bytes: int) -> dict[str, str]:
    """Shuffle width for a job that shuffles about this much.

    The default of 200 tasks would give each 500 GB of a 100 TB shuffle.
    """
    tasks = max(200, -(-shuffled_bytes // BYTES_PER_TASK))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(BYTES_PER_TASK),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(
    app: str = "adtally", master: str | None = None, conf: dict | None = None, shuffled_bytes: int | None = None
) -> SparkSession:
    """A session for this engine; ``shuffled_bytes``, about what its jobs shuffle, sets the shuffle width."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Recording a Python stack per expression costs more than planning the query.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    width = {} if shuffled_bytes is None else shuffle_conf(shuffled_bytes)
    for key, value in {**RUNTIME_CONF, **STREAMING_CONF, **width, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and working tables.

    Taken from ``spark.checkpoint.dir``. A machine-local folder is used only in
    local mode, where driver and executors are one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-adtally-"))
    return context.getCheckpointDir()


def working_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/adtally/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of an executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
