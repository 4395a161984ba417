"""One named query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.functions.rates import counter
from adtally.functions.times import minute_key, spine_of
from adtally.operators import attribution, decode, dedup, lifecycle, reconcile, requests, runlog
from adtally.operators.suppression import suppress_repeats
from adtally.plans import cover, metrics, rollup
from adtally.plans.serving import Serving
from adtally.schemas import BID, BID_TOPIC, COUNTERS, IMPRESSION, IMPRESSION_TOPIC
from adtally.session import STREAMING_CONF, configure, working_dir
from adtally.sources import facts as fact_tables
from adtally.sources import results, tables, topics
from adtally.streaming import projector
from adtally.streaming import store as S
from adtally.streaming.windows import accepted_so_far, suppress_into


def _utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


# Query parameters: a whole week, an unaligned day, a short and a long range.
WEEK = (_utc(2024, 1, 5), _utc(2024, 1, 12))
UNALIGNED = (_utc(2024, 1, 16, 6, 6, 59, 900000), _utc(2024, 1, 16, 23, 20, 15))
HOURS = (_utc(2024, 1, 5, 10, 0, 30), _utc(2024, 1, 5, 14, 20, 15))
TEN_DAYS = (_utc(2024, 1, 10), _utc(2024, 1, 20))
CUTOFF = _utc(2024, 1, 16, 6, 6, 59, 900000)
NOW = _utc(2024, 2, 10)
HALFWAY = _utc(2024, 1, 16)
DAYS_AND_MORE = (_utc(2024, 1, 8, 6, 6, 59, 900000), _utc(2024, 1, 20, 23, 20, 15))
ORDER_YEARS = (_utc(1995, 1, 1), _utc(2002, 1, 1))
BATCH_EDGES = (_utc(2024, 1, 11), _utc(2024, 1, 21))
WAIT = timedelta(hours=24)
MAX_BID_AGE = timedelta(days=31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps leave as UTC wall-clock values, whatever reads them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def query(function: Callable[[SparkSession, DataFrame], DataFrame]) -> Callable:
    """Register a query over the events table under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return _plain_times(function(spark, tables.events(spark, sf_dir)))

    QUERIES[function.__name__] = run
    return function


def table_query(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
    """Register a query that opens its tables itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return _plain_times(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


# ---- shared relations ---------------------------------------------------


def _lives(events: DataFrame) -> DataFrame:
    return lifecycle.lifecycle(tables.changes(events))


def _deltas(events: DataFrame) -> DataFrame:
    return lifecycle.deltas(_lives(events))


def _ledger(events: DataFrame) -> DataFrame:
    lives = lifecycle.lifecycle(
        tables.changes(events),
        bid_carry=("campaign_id", "event_ts", "arrival_ts"),
        impression_carry=("event_ts", "arrival_ts"),
    )
    return lifecycle.correction_ledger(lives)


def _bids(events: DataFrame) -> DataFrame:
    rows = tables.changes(events, BID)
    return dedup.first_write(rows.select("seq", "bid_id", "campaign_id", "event_ts"))


def _impressions(events: DataFrame) -> DataFrame:
    rows = tables.changes(events, IMPRESSION)
    return dedup.first_write(rows.select("seq", "bid_id", "event_ts"))


def _decoded(events: DataFrame, kind: str | None = None) -> DataFrame:
    return decode.decode(tables.records(events, broken=True, kind=kind))


def _serving(events: DataFrame, overlap: bool = False, cutoff: datetime = CUTOFF) -> Serving:
    rows = _deltas(events)
    return Serving(rows, rollup.minute_campaign(rows), cutoff, rollup.minute_global(rows), overlap)


def _halfway_seq(events: DataFrame):
    """The last change that arrived before the halfway instant, as a scalar subquery."""
    rows = tables.changes(events).where(F.col("arrival_ts") < F.lit(HALFWAY))
    return rows.agg(F.max("seq")).scalar()


# ---- sources and sinks --------------------------------------------------


@query
def src_events(spark, events):
    return tables.records(events)


@query
def encode_events(spark, events):
    epoch = {"timestamp": F.unix_seconds("event_ts")}
    empty = {"campaign_id": F.lit(""), "user_idfv": F.lit("")}
    bids = tables.changes(events, BID).withColumns(epoch)
    impressions = tables.changes(events, IMPRESSION).withColumns({**epoch, **empty})
    return topics.encode_bids(bids).unionByName(topics.encode_impressions(impressions))


@query
def facts_bids(spark, events):
    return dedup.bid_facts(decode.changes(_decoded(events, BID)))


@query
def facts_impressions(spark, events):
    return dedup.impression_facts(decode.changes(_decoded(events, IMPRESSION)))


@query
def change_log(spark, events):
    return dedup.change_log(decode.changes(_decoded(events)))


@query
def replay_scan(spark, events):
    return fact_tables.replay_scan(facts_bids(spark, events), HALFWAY, BID)


@query
def replay_impressions(spark, events):
    return fact_tables.replay_scan(facts_impressions(spark, events), HALFWAY, IMPRESSION)


@query
def change_log_replay(spark, events):
    return decode.changes_from_log(change_log(spark, events))


@query
def topic_sample(spark, events):
    return topics.topic_sample(tables.records(events), [BID_TOPIC, IMPRESSION_TOPIC], 100)


# ---- decoding and requests ----------------------------------------------


@query
def decode_bids(spark, events):
    return decode.bids(_decoded(events, BID)).select(
        "seq", "request_id", "bid_id", "user_idfv", "campaign_id", "placement_id", "event_ts"
    )


@query
def decode_impressions(spark, events):
    return decode.impressions(_decoded(events, IMPRESSION)).select("seq", "bid_id", "event_ts")


@query
def quarantine(spark, events):
    return decode.quarantine(_decoded(events))


@query
def select_campaign(spark, events):
    return requests.select_campaign(tables.requests(events)).select(
        "seq", "user_idfv", "campaign_id", "creative_url"
    )


@query
def bid_requests_decoded(spark, events):
    decoded = requests.decode_requests(tables.request_bodies(events))
    filled = requests.campaign_for(F.col("user_idfv")).isNotNull()
    outcome = F.when(F.col("malformed"), F.lit("malformed")).when(filled, F.lit("filled")).otherwise(F.lit("no_fill"))
    return decoded.select("seq", "user_idfv", "placement_id", outcome.alias("outcome"))


@query
def nofill_counts(spark, events):
    return requests.fill_counts(tables.requests(events))


@query
def bid_events(spark, events):
    return requests.bid_events(tables.requests(events))


@query
def billing_outcomes(spark, events):
    return requests.classify_billing(tables.billing_requests(events))


@query
def billed_impressions(spark, events):
    return requests.impression_events(requests.classify_billing(tables.billing_requests(events)))


@query
def minute_keys(spark, events):
    rows = tables.changes(events)
    return rows.groupBy(minute_key(F.col("event_ts")).alias("minute_key")).agg(F.count("*").alias("records"))


# ---- deduplication ------------------------------------------------------


@query
def dedup_bids(spark, events):
    return _bids(events)


@query
def dedup_impressions(spark, events):
    return _impressions(events)


@query
def billing_suppression_24h(spark, events):
    rows = tables.changes(events, IMPRESSION)
    return suppress_repeats(rows, ts="arrival_ts")


@query
def billing_suppression_ties(spark, events):
    """Times cut to the day and places to two numbers: many rows are equal in both."""
    rows = tables.changes(events, IMPRESSION)
    return suppress_repeats(
        rows.withColumns({"arrival_ts": F.date_trunc("day", "arrival_ts"), "seq": F.col("seq") % 2}), ts="arrival_ts"
    )


@query
def billing_suppression_hot(spark, events):
    """Every key with more than one row takes the path of large keys."""
    return suppress_repeats(tables.changes(events, IMPRESSION), ts="arrival_ts", hot_rows=1)


# ---- attribution --------------------------------------------------------


@query
def matched_impressions(spark, events):
    return attribution.matched_impressions(_impressions(events), _bids(events))


@query
def unknown_impressions(spark, events):
    return attribution.unknown_impressions(_impressions(events), _bids(events))


@query
def attributed_impressions(spark, events):
    return attribution.attributed_impressions(_impressions(events), _bids(events))


@query
def unmatched_bids(spark, events):
    return attribution.unmatched_bids(_bids(events), _impressions(events), 100)


@query
def matched_bid_ids(spark, events):
    return attribution.matched_bid_ids(_bids(events), _impressions(events))


# ---- exact range queries ------------------------------------------------


@query
def summary_exact(spark, events):
    return metrics.summary(metrics.in_range(_deltas(events), *UNALIGNED), *UNALIGNED, "facts")


@query
def by_campaign_exact(spark, events):
    return metrics.by_campaign(metrics.in_range(_deltas(events), *WEEK))


@query
def by_campaign_from_facts(spark, events):
    return metrics.by_campaign(
        attribution.deltas_from_facts(_bids(events), _impressions(events), *UNALIGNED)
    )


@query
def bucketed_counts(spark, events):
    return metrics.bucketed_counts(_deltas(events), "hour")


@query
def by_campaign_json(spark, events):
    return results.as_json(by_campaign_exact(spark, events))


@query
def timeseries_minute(spark, events):
    return metrics.series(metrics.in_range(_deltas(events), *HOURS), *HOURS, "minute")


@query
def timeseries_hour(spark, events):
    return metrics.series(metrics.in_range(_deltas(events), *WEEK), *WEEK, "hour")


@query
def timeseries_day(spark, events):
    return metrics.series(metrics.in_range(_deltas(events), *TEN_DAYS), *TEN_DAYS, "day")


@query
def series_spine(spark, events):
    times = F.col("ts").cast("timestamp")
    return spine_of(events.agg(F.min(times).alias("first"), F.max(times).alias("last")), "minute")


@query
def top_campaigns(spark, events):
    return metrics.top_campaigns(by_campaign_exact(spark, events))


# ---- roll-ups -----------------------------------------------------------


@query
def minute_global(spark, events):
    return rollup.minute_global(_deltas(events))


@query
def minute_campaign(spark, events):
    return rollup.minute_campaign(_deltas(events))


@query
def lifetime_global(spark, events):
    return metrics.totals(_ledger(events))


@query
def lifetime_campaign(spark, events):
    return rollup.lifetime_campaign(_ledger(events))


@query
def campaign_registry(spark, events):
    return rollup.campaign_registry(_ledger(events))


@query
def summary_rollup(spark, events):
    return _serving(events, cutoff=UNALIGNED[0]).summary(*UNALIGNED)


@query
def by_campaign_rollup(spark, events):
    return _serving(events, cutoff=UNALIGNED[0]).by_campaign(*UNALIGNED)


@query
def timeseries_rollup_hour(spark, events):
    return _serving(events, cutoff=UNALIGNED[0]).series(*UNALIGNED, "hour")


@query
def timeseries_rollup_day(spark, events):
    return _serving(events, cutoff=TEN_DAYS[0]).series(*TEN_DAYS, "auto")


def _cover_serving(events: DataFrame) -> Serving:
    rows = _deltas(events)
    levels = cover.levels_of(rollup.minute_campaign(rows))
    return Serving(rows, rollup.minute_campaign(rows), DAYS_AND_MORE[0], levels=levels)


@query
def summary_cover(spark, events):
    return _cover_serving(events).summary(*DAYS_AND_MORE)


@query
def by_campaign_cover(spark, events):
    return _cover_serving(events).by_campaign(*DAYS_AND_MORE)


@query
def timeseries_cover_hour(spark, events):
    return _cover_serving(events).series(*DAYS_AND_MORE, "hour")


@query
def freshness(spark, events):
    return _ledger(events).agg(F.max("known_ts").alias("last_projected_at"))


@query
def rebuild_minutes(spark, events):
    return rollup.rebuild(_bids(events), _impressions(events), NOW)


@query
def rebuild_minutes_recent_bids(spark, events):
    return rollup.rebuild(_bids(events), _impressions(events), NOW, recent_bids_only=True)


@query
def rollup_multires(spark, events):
    return rollup.multi_resolution(_deltas(events))


@query
def retention_filter(spark, events):
    return fact_tables.retained(_bids(events), NOW)


@query
def retention_impressions(spark, events):
    return fact_tables.retained(_impressions(events), NOW)


@query
def counter_parse(spark, events):
    """Stored counters as numbers, among texts that are none and one too large."""
    which = F.col("event_id") % 5
    text = (
        F.when(which == 0, F.get_json_object("props", "$.k"))
        .when(which == 1, F.col("event_type"))
        .when(which == 2, F.concat(F.lit("-"), F.col("event_id").cast("string")))
        .when(which == 3, F.lit("99999999999999999999"))
    )
    return events.select("event_id", counter(text).alias("counter"))


# ---- routed and mixed queries -------------------------------------------


@query
def summary_routed(spark, events):
    """The same week before, across and after the cutoff."""
    serving = _serving(events)
    days = timedelta(days=7)
    result = None
    for start in (CUTOFF - days, CUTOFF - days / 2, CUTOFF):
        part = serving.summary(start, start + days)
        result = part if result is None else result.unionByName(part)
    return result


@query
def summary_mixed(spark, events):
    return _serving(events).summary(*TEN_DAYS)


@query
def summary_mixed_compat(spark, events):
    return _serving(events, overlap=True).summary(*TEN_DAYS)


@query
def by_campaign_mixed(spark, events):
    return _serving(events).by_campaign(*TEN_DAYS)


@query
def timeseries_mixed_disjoint(spark, events):
    return _serving(events).series(*TEN_DAYS, "hour")


@query
def timeseries_mixed(spark, events):
    return _serving(events, overlap=True).series(*TEN_DAYS, "hour")


# ---- corrections --------------------------------------------------------


@query
def correction_ledger(spark, events):
    return _ledger(events)


@query
def read_model_as_of(spark, events):
    ledger = lifecycle.as_of(_ledger(events), _halfway_seq(events))
    return metrics.by_campaign(ledger)


@query
def read_model_growth(spark, events):
    return rollup.growth(_ledger(events), "day")


@query
def backlog(spark, events):
    return reconcile.backlog(change_log(spark, events), _halfway_seq(events))


@query
def unknown_after_wait(spark, events):
    return lifecycle.unknown_after_wait(_lives(events), WAIT, MAX_BID_AGE)


# ---- reconciliation -----------------------------------------------------


@query
def topic_counts(spark, events):
    return reconcile.topic_counts(tables.topic_offsets(events))


@query
def topic_thresholds(spark, events):
    return reconcile.thresholds(reconcile.topic_counts(tables.topic_offsets(events)))


@query
def reconcile_layers(spark, events):
    changes = tables.changes(events)
    ledger = _ledger(events)
    return reconcile.reconcile(
        changes,
        _bids(events),
        _impressions(events),
        reconcile.backlog(ledger, ledger.agg(F.max("seq")).scalar()),
        rollup.minute_campaign(ledger),
        _deltas(events),
    )


def _half_and_whole(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    ledger = _ledger(events)
    columns = ["campaign_id", *COUNTERS]
    half = rollup.lifetime_campaign(lifecycle.as_of(ledger, _halfway_seq(events)))
    return half.select(*columns), rollup.lifetime_campaign(ledger).select(*columns)


@query
def snapshot_diff(spark, events):
    return reconcile.snapshot_diff(*_half_and_whole(events))


@query
def snapshot_delta(spark, events):
    return reconcile.snapshot_delta(*_half_and_whole(events))


# ---- request log --------------------------------------------------------


@query
def stage_counters(spark, events):
    return runlog.stage_counters(tables.request_log(events))


@query
def first_minute_error_rate(spark, events):
    return runlog.first_minute_error_rate(tables.request_log(events))


@query
def response_gaps(spark, events):
    return runlog.response_gaps(tables.request_log(events))


@query
def burst_slo(spark, events):
    return runlog.burst_slo(runlog.stage_report(tables.request_log(events)))


@query
def load_totals(spark, events):
    return runlog.load_totals(tables.request_log(events))


# ---- orders as bids, line items as impressions --------------------------


def _order_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = tables.table(spark, sf_dir, "orders"), tables.table(spark, sf_dir, "lineitem")
    return lifecycle.deltas(lifecycle.lifecycle(tables.order_changes(orders, lineitem)))


@table_query
def orders_summary(spark, sf_dir):
    rows = metrics.in_range(_order_deltas(spark, sf_dir), *ORDER_YEARS)
    return metrics.summary(rows, *ORDER_YEARS, "facts")


@table_query
def orders_by_campaign(spark, sf_dir):
    return metrics.by_campaign(_order_deltas(spark, sf_dir))


@table_query
def orders_series_day(spark, sf_dir):
    rows = metrics.in_range(_order_deltas(spark, sf_dir), *ORDER_YEARS)
    return metrics.series(rows, *ORDER_YEARS, "day")


# ---- streams run to their end -------------------------------------------


def _event_parts(events: DataFrame) -> list[DataFrame]:
    """The events in three parts by arrival."""
    parts = []
    for start, end in zip((None, *BATCH_EDGES), (*BATCH_EDGES, None)):
        part = events if start is None else events.where(F.col("ts") >= F.lit(start.replace(tzinfo=None)))
        parts.append(part if end is None else part.where(F.col("ts") < F.lit(end.replace(tzinfo=None))))
    return parts


def _feed(part: DataFrame, source: str, files: int = 0) -> None:
    """More files for a stream to read, written by as many tasks as read them."""
    (part.repartition(files) if files else part).write.mode("append").parquet(source)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in three micro-batches: each part is dealt into as many files as a trigger takes."""
    events = tables.events(spark, sf_dir)
    source, parts = working_dir(spark, "events-in"), _event_parts(events)
    # no file is empty, so every part has the same number of them
    rows = [F.sum(F.when(F.col("ts") < F.lit(edge.replace(tzinfo=None)), 1).otherwise(0)) for edge in BATCH_EDGES]
    first, second, every = (n or 0 for n in events.agg(*rows, F.count("*")).first())
    least = max(min(first, second - first, every - second), 1)
    files = min(max(spark.sparkContext.defaultParallelism, len(events.inputFiles())), least)
    for part in parts:
        _feed(part, source, files)
    return topics.file_stream(spark, source, tables.EVENTS, files_per_trigger=files)


def _streaming(spark: SparkSession) -> SparkSession:
    """A session of its own for state-store settings; context and tables are shared."""
    own = configure(spark.newSession())
    for key, value in STREAMING_CONF.items():
        own.conf.set(key, value)
    # State partitions are fixed at the first start of a checkpoint.
    own.conf.set("spark.sql.shuffle.partitions", str(max(spark.sparkContext.defaultParallelism, 1)))
    return own


def _projected(spark: SparkSession, sf_dir: str, **options) -> S.BatchStore:
    own = _streaming(spark)
    changes = tables.changes(_event_stream(own, sf_dir))
    store = projector.run_to_end(
        changes, working_dir(spark, "projection"), working_dir(spark, "projection-state"), compact_every=2, **options
    )
    return S.BatchStore(spark, store.root)


@table_query
def stream_correction_ledger(spark, sf_dir):
    return _projected(spark, sf_dir).read(S.LEDGER)


@table_query
def stream_minute_campaign(spark, sf_dir):
    return _projected(spark, sf_dir).minute_campaign()


@table_query
def stream_bounded_state(spark, sf_dir):
    """The ledger of a projection that forgets ids after some days and looks them up where they come back."""
    return _projected(spark, sf_dir, keep=timedelta(days=5), late=timedelta(days=1)).read(S.LEDGER)


@table_query
def attributed_from_ledger(spark, sf_dir):
    """Impressions of some days with their campaigns, from a stored ledger alone."""
    return attribution.attributed_from_ledger(_projected(spark, sf_dir).read(S.LEDGER), *DAYS_AND_MORE)


@table_query
def as_of_from_store(spark, sf_dir):
    """The campaigns as they stood after the first half, from a stored version and the ledger's rows behind it."""
    store = _projected(spark, sf_dir)
    half = tables.events(spark, sf_dir).agg(_halfway_seq(tables.events(spark, sf_dir)).alias("n")).first().n
    return metrics.by_campaign(store.minute_campaign_as_of(half))


@table_query
def stream_levels(spark, sf_dir):
    """Minutes, hours and days that a projection maintains."""
    store = _projected(spark, sf_dir)
    store.compact()
    return store.levels().where(F.col("level") != cover.LOOSE)


@table_query
def rebuild_takes_over(spark, sf_dir):
    """The served minutes of a projection that was rebuilt from its facts when two of three parts had come."""
    own = _streaming(spark)
    source, root, state = (working_dir(spark, name) for name in ("events-in", "projection", "projection-state"))

    def run() -> S.BatchStore:
        changes = tables.changes(topics.file_stream(own, source, tables.EVENTS))
        raw = F.to_json(F.struct("bid_id", "campaign_id", "event_ts"))
        return projector.run_to_end(changes.withColumn("raw_json", raw), root, state, with_facts=True)

    for number, part in enumerate(_event_parts(tables.events(spark, sf_dir))):
        _feed(part, source)
        store = run()
        if number == 1:
            store.rebuild()
    return S.BatchStore(spark, root).minute_campaign()


@table_query
def reconcile_stored(spark, sf_dir):
    """Rows of each subject by date in a store, and whether its layers agree, by the digests its batches left."""
    own = _streaming(spark)
    raw = F.to_json(F.struct("bid_id", "campaign_id", "event_ts"))
    changes = tables.changes(_event_stream(own, sf_dir)).withColumn("raw_json", raw)
    root, state = working_dir(spark, "projection"), working_dir(spark, "projection-state")
    projector.run_to_end(changes, root, state, with_facts=True, with_digests=True)
    cells = S.BatchStore(spark, root).reconcile()
    by_date = cells.groupBy("subject", "event_date").agg(F.sum("rows").cast("bigint").alias("rows"), F.min("ok").alias("ok"))
    return by_date.where("rows != 0")


@table_query
def stream_retention(spark, sf_dir):
    """The served minutes after those before the horizon have expired."""
    store = _projected(spark, sf_dir)
    store.compact(HALFWAY)
    return store.minute_campaign()


@table_query
def lifetime_from_store(spark, sf_dir):
    """Totals for all time, from a store whose older minutes have expired."""
    store = _projected(spark, sf_dir)
    store.compact(HALFWAY)
    return store.lifetime_campaign()


@table_query
def stream_billing_suppression(spark, sf_dir):
    stream = _event_stream(spark, sf_dir)
    root = working_dir(spark, "billing")
    suppress_into(tables.changes(stream, IMPRESSION), root, working_dir(spark, "billing-state")).awaitTermination()
    return accepted_so_far(spark, root).select("bid_id", "seq", "arrival_ts")
