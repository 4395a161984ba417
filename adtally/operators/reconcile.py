"""Do the layers agree? Counts, thresholds and snapshot comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.schemas import COUNTERS

#: Fixed value: the smallest acceptable number of messages per topic.
MIN_MESSAGES = 10001


def topic_counts(offsets: DataFrame) -> DataFrame:
    """Messages per topic: latest minus earliest over partitions, negative spans skipped.

    A partition without one of its offsets is an error.
    """
    known = F.col("earliest").isNotNull() & F.col("latest").isNotNull()
    span = F.when(known, F.greatest(F.col("latest") - F.col("earliest"), F.lit(0))).otherwise(
        F.raise_error(F.concat(F.lit("missing offsets for partition "), F.col("partition").cast("string")))
    )
    return offsets.groupBy("topic").agg(F.sum(span.cast("bigint")).alias("messages"))


def thresholds(counts: DataFrame, minimum: int | dict[str, int] = MIN_MESSAGES) -> DataFrame:
    """PASS or FAIL per topic; ``minimum`` is one number or one per topic."""
    if isinstance(minimum, dict):
        bound = F
        for topic, count in minimum.items():
            bound = bound.when(F.col("topic") == topic, F.lit(count))
        bound = bound.otherwise(F.lit(MIN_MESSAGES)).cast("bigint")
    else:
        bound = F.lit(minimum).cast("bigint")
    return counts.select(
        "topic", "messages", bound.alias("threshold")
    ).withColumn("status", F.when(F.col("messages") >= F.col("threshold"), "PASS").otherwise("FAIL"))


def _tagged(rows: DataFrame, side: int) -> DataFrame:
    return rows.withColumn("_side", F.lit(side))


def snapshot_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference of two snapshots in one grouped count; NULLs compare equal.

    ``side`` says where the surplus ``copies`` are. Empty means equal.
    """
    columns = left.columns
    return (
        _tagged(left, 1)
        .unionByName(_tagged(right, -1))
        .groupBy(*columns)
        .agg(F.sum("_side").cast("bigint").alias("_net"))
        .where(F.col("_net") != 0)
        .select(
            *columns,
            F.when(F.col("_net") > 0, "left_only").otherwise("right_only").alias("side"),
            F.abs("_net").alias("copies"),
        )
    )


def snapshot_delta(before: DataFrame, after: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Counter growth per key between two snapshots; a missing key counts as zeros."""
    aggregates = []
    for name in COUNTERS:
        old = F.sum(F.when(F.col("_side") == 1, F.col(name)).otherwise(0)).cast("bigint")
        new = F.sum(F.when(F.col("_side") == 2, F.col(name)).otherwise(0)).cast("bigint")
        aggregates += [old.alias(f"{name}_before"), new.alias(f"{name}_after"), (new - old).alias(f"{name}_delta")]
    columns = [key, *COUNTERS]
    return (
        _tagged(before.select(*columns), 1)
        .unionByName(_tagged(after.select(*columns), 2))
        .groupBy(key)
        .agg(*aggregates)
    )


def backlog(change_log: DataFrame, checkpointed_seq: int | None) -> DataFrame:
    """Changes not yet projected."""
    rows = change_log if checkpointed_seq is None else change_log.where(F.col("seq") > checkpointed_seq)
    return rows.agg(F.count("*").alias("pending"))


def reconcile(
    topic_changes: DataFrame,
    bid_facts: DataFrame,
    impression_facts: DataFrame,
    pending: DataFrame,
    rollup: DataFrame,
    exact: DataFrame,
) -> DataFrame:
    """One row per check: ``check, expected, actual, ok``.

    Topics may carry duplicates, so facts are compared with the number of distinct
    ids, and the raw numbers are reported beside them. Every layer is reduced to
    its counts first; the checks then run on that handful of rows.
    """

    def measured(rows: DataFrame, **counts) -> DataFrame:
        pairs = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in counts.items()]
        return rows.agg(F.array(*pairs).alias("_pairs")).select(F.inline("_pairs"))

    per_id = topic_changes.groupBy("kind", "bid_id").agg(F.count("*").alias("rows"))

    def of(kind, value):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0)).cast("bigint")

    one = F.lit(1)
    parts = [
        measured(
            per_id,
            topic_bid_rows=of("bid", F.col("rows")),
            topic_bids=of("bid", one),
            topic_impression_rows=of("impression", F.col("rows")),
            topic_impressions=of("impression", one),
        ),
        measured(bid_facts, fact_bids=F.count("*")),
        measured(impression_facts, fact_impressions=F.count("*")),
        measured(pending, backlog=F.coalesce(F.sum("pending"), F.lit(0)).cast("bigint")),
    ]
    for layer, rows in (("rollup", rollup), ("summary", exact)):
        parts.append(
            measured(
                rows,
                **{
                    f"{layer}_{name}": F.coalesce(F.sum(name), F.lit(0)).cast("bigint") for name in COUNTERS
                },
            )
        )
    metrics = parts[0]
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    m = F.col("_m")
    checks = [
        ("bid facts = distinct topic bids", m["topic_bids"], m["fact_bids"]),
        ("impression facts = distinct topic impressions", m["topic_impressions"], m["fact_impressions"]),
        ("bid rows >= bid facts", m["topic_bid_rows"], F.greatest(m["topic_bid_rows"], m["fact_bids"])),
        (
            "impression rows >= impression facts",
            m["topic_impression_rows"],
            F.greatest(m["topic_impression_rows"], m["fact_impressions"]),
        ),
        ("backlog is empty", F.lit(0).cast("bigint"), m["backlog"]),
        ("roll-up bids = bid facts", m["fact_bids"], m["rollup_bid_requests"]),
        (
            "matched + unknown = impression facts",
            m["fact_impressions"],
            m["rollup_deduped_impressions"] + m["rollup_unknown_impressions"],
        ),
    ]
    checks += [(f"summary {name} = roll-up", m[f"rollup_{name}"], m[f"summary_{name}"]) for name in COUNTERS]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                expected.alias("expected"),
                actual.alias("actual"),
                (expected == actual).alias("ok"),
            )
            for name, expected, actual in checks
        ]
    )
    return metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("_m")).select(
        F.inline(rows)
    )
