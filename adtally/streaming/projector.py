"""Records in, facts and corrected counters out: one streaming query.

The keyed state is a streaming aggregation, the same fold as in batch
(``operators.lifecycle``), in update mode: per bid id the first bid and the first
impression. It runs inside the JVM, its partial aggregation combines each
micro-batch on the map side before the shuffle, and the state store holds one
small row per bid id. From the rows a micro-batch touches, the ledger of signed
counter changes follows without knowing the previous state: a first record is new
exactly when it carries the current batch's time.

Order is (batch time, order of arrival). A record of an earlier batch therefore always
wins, as a first write does; within a batch the lowest offset of a topic does.

With ``keep`` the state is bounded. The fold is then also by windows of arrival time, each
twice ``keep`` long and one ``keep`` after the other, which the watermark evicts. A record
lies in two of them and is judged in the one whose later half it is in, so that window
reaches back at least ``keep``. What was known of its id outside of the window is
looked up in the stored ledger, which no id ever leaves. So dedup and attribution stay
exact for all time, and the state holds at most two rows per id of the last
``2 * keep + late``. The look-up is a join of the ids of one micro-batch with the ledger,
whose rows of the window itself are skipped by their arrival times.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.functions.times import event_date
from adtally.operators.dedup import arrival_order
from adtally.operators.lifecycle import correction_ledger, lifecycle
from adtally.plans.rollup import minute_campaign
from adtally.schemas import BID_SEEN, IMPRESSION_SEEN
from adtally.streaming import store as S

BID_PAYLOAD = ("request_id", "user_idfv", "placement_id", "raw_json")
IMPRESSION_PAYLOAD = ("raw_json",)


#: Broker logs are kept a week, so no record comes later than that.
LATE = timedelta(days=7)


def _span(time: timedelta) -> str:
    return f"{time // timedelta(microseconds=1)} microseconds"


def touched_lives(
    changes: DataFrame, with_facts: bool = False, keep: timedelta | None = None, late: timedelta = LATE
) -> DataFrame:
    """The fold over a stream of changes; rows of the ids each micro-batch touches.

    ``with_facts`` also carries what the fact tables store, at the price of larger
    state rows. ``keep`` bounds the state; records that arrive more than ``late`` behind
    the newest one are then not counted.
    """
    bid_carry = ("campaign_id", "event_ts", "arrival_ts") + (BID_PAYLOAD if with_facts else ())
    impression_carry = ("event_ts", "arrival_ts") + (IMPRESSION_PAYLOAD if with_facts else ())
    order = ["batch_ts", *arrival_order(changes)]
    keys = ("bid_id",)
    if keep is not None:
        changes = changes.withWatermark("arrival_ts", _span(late))
        keys = (F.window("arrival_ts", _span(2 * keep), _span(keep)), "bid_id")
    lives = lifecycle(
        changes.withColumn("batch_ts", F.current_timestamp()), order, bid_carry, impression_carry, keys
    )
    newest = F.greatest(F.col("bid.batch_ts"), F.col("impression.batch_ts"))
    # Batch times come from the driver's clock and are kept in the offset log. Were
    # the clock set back, new changes would look old; fail rather than lose them.
    now = F.when(newest <= F.current_timestamp(), F.current_timestamp()).otherwise(
        F.raise_error(F.lit("the clock went back between micro-batches"))
    )
    return lives.withColumn("batch_ts", now)


def _is_new(side: str):
    return F.col(f"{side}.batch_ts") == F.col("batch_ts")


def judged_here(lives: DataFrame, keep: timedelta) -> DataFrame:
    """Rows of windows in whose later half a record of this batch lies.

    What this batch holds of the id before that half counts as known, be it in the window or, in a batch that spans
    more time than a window, before it: there a row of another window has it.
    """
    middle = F.col("window.start") + F.lit(keep)
    sides = ("bid", "impression")
    every = Window.partitionBy("bid_id")
    rows = lives.withColumns({f"_{side}": F.min(side).over(every) for side in sides})

    def marked(side: str) -> Column:
        life = F.when(F.col(f"_{side}.arrival_ts") < F.col("window.start"), F.col(f"_{side}")).otherwise(F.col(side))
        known = life["batch_ts"] - F.expr("INTERVAL 1 MICROSECOND")
        when = F.when(life["arrival_ts"] < middle, known).otherwise(life["batch_ts"])
        return F.when(life.isNotNull(), life.withField("batch_ts", when))

    rows = rows.withColumns({side: marked(side) for side in sides}).drop(*[f"_{side}" for side in sides])
    return rows.where(F.coalesce(_is_new("bid"), F.lit(False)) | F.coalesce(_is_new("impression"), F.lit(False)))


def with_history(lives: DataFrame, ledger: DataFrame) -> DataFrame:
    """``lives`` whose first bid and impression are those of the ledger, where it knows them from outside the window."""
    bounds = lives.agg(F.max("window.start"), F.min("window.end")).first()
    if bounds[0] is None:
        return lives
    outside = (F.col("known_ts") < F.lit(bounds[0])) | (F.col("known_ts") >= F.lit(bounds[1]))
    past = ledger.where(outside & ((F.col("bid_requests") > 0) | (F.col("deduped_impressions") > 0) | (F.col("unknown_impressions") > 0)))
    asked = lives.select(F.col("bid_id").alias("_id"), F.col("window").alias("_window"))
    apart = (F.col("known_ts") < F.col("_window.start")) | (F.col("known_ts") >= F.col("_window.end"))
    long_ago = F.lit(0).cast("timestamp")

    def known(side: str, given: dict[str, Column]) -> Column:
        fields = lives.schema[side].dataType.fields
        given = {"batch_ts": long_ago, "seq": F.col("seq"), "arrival_ts": F.col("known_ts"), "event_ts": F.col("event_ts"), **given}
        return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    is_bid, first_seen = F.col("bid_requests") > 0, F.col("unknown_impressions") > 0
    # of an impression's rows the one it came with leads, before a correction that came with its bid
    rank = F.when(first_seen, 0).otherwise(1).alias("rank")
    found = past.join(asked, (F.col("bid_id") == F.col("_id")) & apart).groupBy("_id", "_window").agg(
        F.min(F.when(is_bid, F.struct("seq", known("bid", {"campaign_id": F.col("campaign_id")}).alias("life")))).alias("_bid"),
        F.min(F.when(~is_bid, F.struct(rank, "seq", known("impression", {}).alias("life")))).alias("_impression"),
    )
    joined = lives.join(found, (F.col("bid_id") == F.col("_id")) & (F.col("window") == F.col("_window")), "left")
    return joined.select(
        "window", "bid_id",
        F.coalesce("_bid.life", "bid").alias("bid"),
        F.coalesce("_impression.life", "impression").alias("impression"),
        "batch_ts",
    )


def batch_ledger(lives: DataFrame, remember: timedelta | None = None) -> DataFrame:
    """Signed counter rows of one micro-batch."""
    return correction_ledger(lives, _is_new("bid"), _is_new("impression"), remember)


def new_bid_facts(lives: DataFrame) -> DataFrame:
    b = F.col("bid")
    return lives.where(b.isNotNull() & _is_new("bid")).select(
        "bid_id",
        b["request_id"].alias("request_id"),
        b["campaign_id"].alias("campaign_id"),
        b["user_idfv"].alias("user_idfv"),
        b["placement_id"].alias("placement_id"),
        b["event_ts"].alias("event_ts"),
        b["raw_json"].alias("raw_json"),
        b["arrival_ts"].alias("ingested_at"),
        b["seq"].alias("seq"),
        event_date(b["event_ts"]).alias("event_date"),
    )


def new_impression_facts(lives: DataFrame) -> DataFrame:
    i = F.col("impression")
    return lives.where(i.isNotNull() & _is_new("impression")).select(
        "bid_id",
        i["event_ts"].alias("event_ts"),
        i["raw_json"].alias("raw_json"),
        i["arrival_ts"].alias("ingested_at"),
        i["seq"].alias("seq"),
        event_date(i["event_ts"]).alias("event_date"),
    )


def new_change_log(lives: DataFrame) -> DataFrame:
    def entries(facts: DataFrame, event_type: str) -> DataFrame:
        return facts.select(
            "seq",
            F.lit(event_type).alias("event_type"),
            F.col("bid_id").alias("entity_id"),
            "event_ts",
            F.col("raw_json").alias("payload"),
        )

    return entries(new_bid_facts(lives), BID_SEEN).unionByName(
        entries(new_impression_facts(lives), IMPRESSION_SEEN)
    )


def project_batch(
    store: S.BatchStore,
    lives: DataFrame,
    batch_id: int,
    with_facts: bool,
    remember: timedelta | None,
    keep: timedelta | None = None,
    with_digests: bool = False,
) -> None:
    """Write one micro-batch. Each table's directory is replaced as a whole.

    The stateful result is computed by exactly one write; whatever else is needed
    reads that table back. A lost executor then costs a re-read, not the state.
    """
    if with_facts or keep is not None:
        schema = lives.schema
        store.write(S.TOUCHED, batch_id, lives)
        lives = store.one(S.TOUCHED, batch_id, schema)
    if keep is not None:
        lives = with_history(judged_here(lives, keep), store.read(S.LEDGER, upto=batch_id - 1))
        schema = lives.schema
        store.write(S.SETTLED, batch_id, lives)
        lives = store.one(S.SETTLED, batch_id, schema)
    if with_facts:
        for table, facts in (
            (S.BID_FACTS, new_bid_facts(lives)),
            (S.IMPRESSION_FACTS, new_impression_facts(lives)),
        ):
            store.write(table, batch_id, facts, by="event_date")
        store.write(S.CHANGE_LOG, batch_id, new_change_log(lives))
    store.write(S.LEDGER, batch_id, batch_ledger(lives, remember))
    ledger = store.one(S.LEDGER, batch_id)
    store.write(S.MINUTES, batch_id, minute_campaign(ledger))
    if with_digests:
        store.write(S.DIGESTS, batch_id, store.layer_digests(batch_id))
    # Written last: its presence says that the batch is complete.
    progress = ledger.agg(F.max("seq").alias("last_seq"), F.count("*").alias("changes"))
    store.write(
        S.PROGRESS,
        batch_id,
        progress.select(F.current_timestamp().alias("projected_at"), "last_seq", "changes"),
    )
    for table in (S.TOUCHED, S.SETTLED):
        store.discard(table, batch_id)


def start(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    with_facts: bool = False,
    remember: timedelta | None = None,
    trigger: dict | None = None,
    compact_every: int | None = 100,
    keep: timedelta | None = None,
    late: timedelta = LATE,
    with_digests: bool = False,
    snapshot_every: int | None = None,
) -> StreamingQuery:
    """Start the projection of a stream of changes into a :class:`BatchStore` at ``root``.

    ``with_digests`` leaves digests of what each batch wrote, for ``BatchStore.reconcile``.

    ``keep`` bounds the keyed state to ids of about twice that time; results are the same.
    It is part of the checkpoint, like the width of the state.

    ``trigger`` defaults to all available data, then stop; pass for instance
    ``{"processingTime": "10 seconds"}`` to keep running. The size of a micro-batch
    is the source's setting (files or offsets per trigger).
    """

    def sink(lives: DataFrame, batch_id: int) -> None:
        store = S.BatchStore(lives.sparkSession, root, snapshot_every)
        project_batch(store, lives, batch_id, with_facts, remember, keep, with_digests)
        if compact_every and batch_id % compact_every == compact_every - 1:
            store.compact()
            for table in S.KEPT:
                store.merge(table)
            store.vacuum()

    return (
        touched_lives(changes, with_facts, keep, late)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_to_end(changes: DataFrame, root: str, checkpoint: str, **options) -> S.BatchStore:
    """Project everything available and return the store."""
    start(changes, root, checkpoint, **options).awaitTermination()
    return S.BatchStore(changes.sparkSession, root)
