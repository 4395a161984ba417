"""Batch-addressed tables behind the stream.

Every micro-batch owns one directory per table and rewrites it as a whole, so
running a batch twice changes nothing and there are no increments to lose or to
repeat. Readers take only directories whose write was committed.

Layout below ``root``: ``<table>/batch_id=N``; ``merged/<table>/upto=N`` for the batches
since the merge before, with their numbers as a column; ``compacted/generation=G/upto=N``
for the minutes of all batches up to N. A compaction adds a version to its generation. A
rebuild computes the minutes from stored facts and begins a new generation; readers take
the last version of the newest generation, so they change over when its success marker
is there, and a version that an older generation adds later is not read.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.operators import digests
from adtally.operators.attribution import deltas_from_facts
from adtally.operators.reconcile import snapshot_diff
from adtally.plans.cover import LEVELS, LOOSE, levels_of
from adtally.plans.metrics import any_count, sums
from adtally.plans.rollup import minute_campaign
from adtally.schemas import COUNTERS

LEDGER = "ledger"
MINUTES = "minutes"
BID_FACTS = "bids"
IMPRESSION_FACTS = "impressions"
CHANGE_LOG = "change_log"
PROGRESS = "progress"
#: Digests of what a batch wrote to each layer (see ``adtally.operators.digests``).
DIGESTS = "digests"
COMPACTED = "compacted"
#: What expired minutes add to the totals for all time, by the version that dropped them.
EXPIRED = "expired"
#: A batch's folded ids, kept only while the batch is being written.
TOUCHED = "touched"
#: The same after ids that the state forgot were looked up; also kept only meanwhile.
SETTLED = "settled"
#: Minutes of all time from facts, kept only while a rebuild is under way.
REBUILT = "rebuilt"
#: Many batches of a table in one directory.
MERGED = "merged"

#: Tables of which no row ever goes.
KEPT = (LEDGER, BID_FACTS, IMPRESSION_FACTS, CHANGE_LOG, DIGESTS, PROGRESS)

_COUNTER_DDL = ", ".join(f"{name} BIGINT" for name in COUNTERS)
_FACT_TAIL = "raw_json STRING, ingested_at TIMESTAMP, seq BIGINT, event_date DATE"
SCHEMAS = {
    LEDGER: (
        "bid_id STRING, seq BIGINT, known_ts TIMESTAMP, campaign_id STRING, event_ts TIMESTAMP, "
        + _COUNTER_DDL
    ),
    MINUTES: f"campaign_id STRING, minute_ts TIMESTAMP, {_COUNTER_DDL}",
    COMPACTED: f"level STRING, campaign_id STRING, minute_ts TIMESTAMP, {_COUNTER_DDL}",
    EXPIRED: f"campaign_id STRING, {_COUNTER_DDL}",
    BID_FACTS: (
        "bid_id STRING, request_id STRING, campaign_id STRING, user_idfv STRING, placement_id STRING, "
        f"event_ts TIMESTAMP, {_FACT_TAIL}"
    ),
    IMPRESSION_FACTS: f"bid_id STRING, event_ts TIMESTAMP, {_FACT_TAIL}",
    CHANGE_LOG: "seq BIGINT, event_type STRING, entity_id STRING, event_ts TIMESTAMP, payload STRING",
    DIGESTS: "subject STRING, layer STRING, event_date DATE, bucket INT, rows BIGINT, low BIGINT, high BIGINT",
    PROGRESS: "projected_at TIMESTAMP, last_seq BIGINT, changes BIGINT",
}


def _number(path) -> int:
    """The value in the name of a ``key=value`` directory."""
    return int(path.getName().split("=")[1])


class BatchStore:
    """``snapshot_every`` keeps the version of every so many batches for answers as of then."""

    def __init__(self, spark: SparkSession, root: str, snapshot_every: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.snapshot_every = snapshot_every

    # ---- writing --------------------------------------------------------

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def write(self, table: str, batch_id: int, rows: DataFrame, by: str | None = None) -> None:
        if by:
            writer = rows.hint("rebalance", by).write.partitionBy(by)
        else:
            writer = rows.write
        writer.mode("overwrite").parquet(self._path(table, batch_id))

    def discard(self, table: str, batch_id: int) -> None:
        self._delete([self._path(table, batch_id)])

    # ---- reading --------------------------------------------------------

    def _files(self, location: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(location)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _committed(self, table: str, key: str) -> list[int]:
        """Numbers of the written directories: those with a success marker."""
        path, files = self._files(f"{self.root}/{table}/{key}=*/_SUCCESS")
        found = files.globStatus(path) or []
        return sorted(_number(status.getPath().getParent()) for status in found)

    def last_complete(self) -> int:
        """The last batch written to all its tables; batches complete in order."""
        return max(self._committed(PROGRESS, "batch_id"), default=-1)

    def _exists(self, location: str) -> bool:
        path, files = self._files(location)
        return files.exists(path)

    def one(self, table: str, batch_id: int, schema=None) -> DataFrame:
        """One batch of a table, complete or not."""
        return self.spark.read.schema(schema or SCHEMAS[table]).parquet(self._path(table, batch_id))

    def read(self, table: str, after: int = -1, upto: int | None = None) -> DataFrame:
        """All complete batches later than ``after`` (up to ``upto``); other directories are pruned."""
        last = self.last_complete() if upto is None else upto
        return self._numbered(table, after, last).drop("batch_id")

    def _numbered(self, table: str, after: int, last: int) -> DataFrame:
        """Rows of the batches in (after, last] with their ``batch_id``: merged ones, then the loose ones."""
        schema = f"{SCHEMAS[table]}, batch_id BIGINT"
        merges = self._committed(f"{MERGED}/{table}", "upto")
        loose_after = max([after, *merges])
        parts = []
        if last > loose_after and self._exists(f"{self.root}/{table}"):
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
            parts.append(rows.where((F.col("batch_id") > loose_after) & (F.col("batch_id") <= last)))
        base = f"{self.root}/{MERGED}/{table}"
        places = [f"{base}/upto={n}" for n in merges if n > after]
        if places and last > after:
            rows = self.spark.read.schema(f"{schema}, upto BIGINT").option("basePath", base).parquet(*places).drop("upto")
            parts.append(rows.where((F.col("batch_id") > after) & (F.col("batch_id") <= last)))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def merge(self, table: str) -> int:
        """Gather the loose batches of a table in one directory, whose success marker makes readers take it instead."""
        before, last = max(self._committed(f"{MERGED}/{table}", "upto"), default=-1), self.last_complete()
        if last > before and self._exists(f"{self.root}/{table}"):
            rows = self._numbered(table, before, last)
            if "event_date" in rows.columns:
                writer = rows.hint("rebalance", "event_date").write.partitionBy("event_date")
            elif "event_ts" in rows.columns:
                # sorted by time, so a range opens few files and skips most of their row groups
                writer = rows.repartitionByRange("event_ts").sortWithinPartitions("event_ts").write
            else:
                writer = rows.hint("rebalance").write
            writer.mode("overwrite").parquet(f"{self.root}/{MERGED}/{table}/upto={last}")
        return max(before, last)

    # ---- versions of the minutes ------------------------------------------

    def versions(self) -> list[tuple[int, int]]:
        """``(generation, last batch)`` of each committed version, oldest first."""
        path, files = self._files(f"{self.root}/{COMPACTED}/generation=*/upto=*/_SUCCESS")
        places = [status.getPath().getParent() for status in files.globStatus(path) or []]
        return sorted((_number(place.getParent()), _number(place)) for place in places)

    def version(self) -> tuple[int, int]:
        return max(self.versions(), default=(0, -1))

    def compacted_upto(self) -> int:
        return self.version()[1]

    def _of_version(self, table: str, version: tuple[int, int]) -> str:
        return f"{self.root}/{table}/generation={version[0]}/upto={version[1]}"

    def _version_rows(self, table: str, version: tuple[int, int]) -> DataFrame:
        if version[1] < 0:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(self._of_version(table, version))

    def _commit(self, version: tuple[int, int], minutes: DataFrame, gone: DataFrame) -> None:
        """Write a version: minutes, hours and days. They come last: their success marker is the commit."""
        gone.write.mode("overwrite").parquet(self._of_version(EXPIRED, version))
        rows = levels_of(minutes).repartitionByRange("level", "minute_ts").sortWithinPartitions("level", "minute_ts")
        rows.write.mode("overwrite").partitionBy("level").parquet(self._of_version(COMPACTED, version))

    def _minutes_of(self, version: tuple[int, int]) -> DataFrame:
        folded = self._version_rows(COMPACTED, version).where(F.col("level") == LEVELS[0]).drop("level")
        rows = self.read(MINUTES, after=version[1]).unionByName(folded)
        return rows.groupBy("campaign_id", "minute_ts").agg(*sums()).where(any_count())

    def levels(self) -> DataFrame:
        """Minutes, hours and days of the current version, and the minute rows of the batches after it, as ``loose``."""
        version = self.version()
        loose = self.read(MINUTES, after=version[1]).withColumn("level", F.lit(LOOSE))
        return loose.unionByName(self._version_rows(COMPACTED, version))

    def minute_campaign(self) -> DataFrame:
        """The roll-up: the current version plus the batches after it."""
        return self._minutes_of(self.version())

    def minute_campaign_as_of(self, seq: int) -> DataFrame:
        """The roll-up after the changes up to and including ``seq``.

        The last version that holds none later, and the ledger's rows behind it: the more versions are kept, the
        shorter that tail. Versions of an older generation are not used.
        """
        progress = self._numbered(PROGRESS, -1, self.last_complete())
        later = progress.where(F.col("last_seq") > seq).agg(F.min("batch_id")).first()[0]
        whole = self.last_complete() if later is None else later - 1
        generation = self.version()[0]
        base = max((v for v in self.versions() if v[0] == generation and v[1] <= whole), default=(generation, -1))
        folded = self._version_rows(COMPACTED, base).where(F.col("level") == LEVELS[0]).drop("level")
        tail = self.read(LEDGER, after=base[1]).where(F.col("seq") <= seq)
        rows = minute_campaign(tail).unionByName(folded)
        return rows.groupBy("campaign_id", "minute_ts").agg(*sums()).where(any_count())

    def compact(self, horizon: datetime | None = None) -> int:
        """Fold all complete minute batches into a new version, without minutes before ``horizon``.

        What expires is added up per campaign first, beside the version, so lifetime totals stay whole.
        """
        before = self.version()
        after = (before[0], self.last_complete())
        if after > before:
            rows, gone = self._minutes_of(before), self._version_rows(EXPIRED, before)
            if horizon is not None:
                old = F.col("minute_ts") < F.lit(horizon)
                gone = gone.unionByName(rows.where(old).drop("minute_ts")).groupBy("campaign_id").agg(*sums())
                rows = rows.where(~old)
            self._commit(after, rows, gone)
        return self.compacted_upto()

    def rebuild(self, horizon: datetime | None = None) -> tuple[int, int]:
        """Replace the served minutes by those of the stored facts; needs a store with facts.

        Facts of the batches complete by now become a new generation; batches after them are added as ever, so the
        stream goes on meanwhile. Impressions are attributed against bids of any age. Minutes before ``horizon`` are
        served as lifetime totals only. Until the commit readers keep the old generation, also if this driver is lost
        on the way; then the next rebuild takes the same number and writes all anew.
        """
        version = (self.version()[0] + 1, self.last_complete())
        if version[1] < 0:
            return self.version()
        if not self._exists(f"{self.root}/{BID_FACTS}"):
            raise RuntimeError("a rebuild needs stored facts; start the projection with them")
        staged = f"{self.root}/{REBUILT}"
        facts = [self.read(table, upto=version[1]) for table in (BID_FACTS, IMPRESSION_FACTS)]
        minute_campaign(deltas_from_facts(*facts)).write.mode("overwrite").parquet(staged)
        minutes = self.spark.read.schema(SCHEMAS[MINUTES]).parquet(staged)
        old = F.lit(False) if horizon is None else F.col("minute_ts") < F.lit(horizon)
        self._commit(version, minutes.where(~old), minutes.where(old).groupBy("campaign_id").agg(*sums()))
        self._delete([staged])
        return version

    def lifetime_campaign(self) -> DataFrame:
        """Totals per campaign for all time: what has expired, and the minutes that have not."""
        version = self.version()
        kept = self._minutes_of(version).drop("minute_ts")
        return kept.unionByName(self._version_rows(EXPIRED, version)).groupBy("campaign_id").agg(*sums())

    def vacuum(self) -> int:
        """Delete what the version (or merge) before the last replaced; how many minute batches and versions went.

        Readers on one of the last two versions are not disturbed. No row of ledger, facts or change log goes. While a
        rebuild is under way, no minutes go, for those that come after its facts are still needed.
        """
        for table in KEPT:
            merges = self._committed(f"{MERGED}/{table}", "upto")
            if len(merges) > 1:
                self._delete([self._path(table, n) for n in self._committed(table, "batch_id") if n <= merges[-2]])
        versions = self.versions()
        if len(versions) < 2 or self._exists(f"{self.root}/{REBUILT}"):
            return 0
        kept = min(last for _, last in versions[-2:])
        minutes = [n for n in self._committed(MINUTES, "batch_id") if n <= kept]
        self._delete([self._path(MINUTES, n) for n in minutes])
        old = [v for v in versions[:-2] if not self.snapshot_every or (v[1] + 1) % self.snapshot_every]
        self._delete([self._of_version(table, v) for v in old for table in (COMPACTED, EXPIRED)])
        return len(minutes) + len(old)

    def _delete(self, locations: list[str]) -> None:
        for location in locations:
            path, files = self._files(location)
            files.delete(path, True)

    # ---- agreement of the layers -------------------------------------------

    def layer_digests(self, batch_id: int | None = None, dates: list | None = None) -> DataFrame:
        """Digests of the stored layers as they are now: of one batch, or of all (or some dates).

        The minutes of all batches are the served ones.
        """

        def rows(table: str, ts: str) -> DataFrame:
            if batch_id is not None:
                return self.one(table, batch_id)
            found = self.minute_campaign() if table == MINUTES else self.read(table)
            if dates is None:
                return found
            wanted = F.to_date(ts).isin(dates)
            return found.where(wanted & F.col("event_date").isin(dates)) if "event_date" in found.columns else found.where(wanted)

        layers = [digests.of_ledger(rows(LEDGER, "event_ts")), digests.of_minutes(rows(MINUTES, "minute_ts"))]
        if self._exists(f"{self.root}/{BID_FACTS}"):
            layers.append(digests.of_facts(rows(BID_FACTS, "event_ts"), rows(IMPRESSION_FACTS, "event_ts")))
            layers.append(digests.of_change_log(rows(CHANGE_LOG, "event_ts")))
        return digests.added(reduce(DataFrame.unionByName, layers))

    def reconcile(self) -> DataFrame:
        """``subject, event_date, bucket, rows, ok`` from the digests that the batches left; no layer is read."""
        return digests.compare(self.read(DIGESTS))

    def drift(self, dates: list | None = None) -> DataFrame:
        """Where stored layers are no longer what their batches wrote: lost or damaged files, wrong compactions.

        ``dates`` limits what is read to them.
        """
        written = self.read(DIGESTS)
        written = written if dates is None else written.where(F.col("event_date").isin(dates))
        some = "rows != 0 OR low != 0 OR high != 0"
        now, then = self.layer_digests(dates=dates).where(some), digests.added(written).where(some)
        return snapshot_diff(now, then)

    def differing_rows(self, subject: str) -> DataFrame:
        """``bid_id, event_ts, side, copies`` of the facts (left) and the ledger (right) in the cells that differ.

        ``subject`` is bids or impressions. Only the dates and buckets of those cells are read.
        """
        cells = self.reconcile().where(~F.col("ok") & (F.col("subject") == subject)).select("event_date", "bucket")
        dates = [row[0] for row in cells.select("event_date").distinct().collect()]
        if not dates:
            return self.spark.createDataFrame([], "bid_id STRING, event_ts TIMESTAMP, side STRING, copies BIGINT")
        first, after = min(dates), max(dates) + timedelta(days=1)
        near = (F.col("event_ts") >= F.lit(first).cast("timestamp")) & (F.col("event_ts") < F.lit(after).cast("timestamp"))

        def there(rows: DataFrame) -> DataFrame:
            keyed = rows.withColumns({"event_date": F.to_date("event_ts"), "bucket": digests.bucket_of("bid_id")})
            return keyed.join(cells, ["event_date", "bucket"], "left_semi")

        table, weight = (BID_FACTS, F.col(COUNTERS[0])) if subject == "bids" else (IMPRESSION_FACTS, F.col(COUNTERS[1]) + F.col(COUNTERS[2]))
        facts = self.read(table).where(F.col("event_date").isin(dates) & near)
        ledger = there(self.read(LEDGER).where(near & (weight != 0)))
        # a correction takes back the row it corrects
        ledger = ledger.groupBy("bid_id", "event_ts").agg(F.sum(weight).alias("n")).where("n != 0")
        return snapshot_diff(there(facts).select("bid_id", "event_ts"), ledger.select("bid_id", "event_ts"))

    def freshness(self) -> DataFrame:
        """When the last projected batch was written."""
        return self.read(PROGRESS).agg(F.max("projected_at").alias("last_projected_at"))
