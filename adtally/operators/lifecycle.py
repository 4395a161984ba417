"""The per-bid fold: one shuffle from which every metric follows.

Both topics are keyed by ``bid_id``, and all the engine needs of a bid id is its
first bid and its first impression. One aggregation over the union of both topics
yields the two deduplications and the join of their survivors at once. It combines
on the map side, so an id that holds a large share of all rows costs one row per
map task. The same aggregation, run as a streaming aggregation, is the keyed state
of the late-bid correction (``adtally.streaming.projector``).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.operators.dedup import arrival_order
from adtally.schemas import BID, COUNTERS, IMPRESSION, UNKNOWN


def first_of(kind: str, order: list[str], carry: list[str]) -> Column:
    """The first record of a kind; ``order`` leads the struct, so ``min`` finds it."""
    return F.min(F.when(F.col("kind") == kind, F.struct(*order, *carry)))


def lifecycle(
    changes: DataFrame,
    order: list[str] | None = None,
    bid_carry: tuple[str, ...] = ("campaign_id", "event_ts"),
    impression_carry: tuple[str, ...] = ("event_ts",),
    keys: tuple[str | Column, ...] = ("bid_id",),
) -> DataFrame:
    """``(bid_id, bid, impression)``: structs of the first record of each kind, or NULL.

    ``order`` defaults to the order of arrival. Carry only what is needed: the structs
    are what is shuffled and sorted. ``keys`` can hold a time window as well.
    """
    order = order or arrival_order(changes)
    return changes.groupBy(*keys).agg(
        first_of(BID, order, list(bid_carry)).alias("bid"),
        first_of(IMPRESSION, order, list(impression_carry)).alias("impression"),
    )


def lifecycle_from_facts(bids: DataFrame, impressions: DataFrame) -> DataFrame:
    """The same relation from stored facts, which are already unique per bid id.

    A full outer join on the key; no shuffle when both tables are bucketed by it.
    """
    left = bids.select("bid_id", F.struct("seq", "campaign_id", "event_ts").alias("bid"))
    right = impressions.select("bid_id", F.struct("seq", "event_ts").alias("impression"))
    return left.join(right, "bid_id", "full_outer")


def _row(campaign: Column, ts: Column, bids: int, matched: int, unknown: int, **extra: Column) -> Column:
    counts = [F.lit(n).cast("bigint").alias(name) for n, name in zip((bids, matched, unknown), COUNTERS)]
    leading = [column.alias(name) for name, column in extra.items()]
    return F.struct(*leading, campaign.alias("campaign_id"), ts.alias("event_ts"), *counts)


def _emit(rows: DataFrame, candidates: list[Column], keep: list[str]) -> DataFrame:
    array = F.filter(F.array(*candidates), lambda row: row.isNotNull())
    return rows.select(*keep, F.inline(array))


def deltas(lives: DataFrame) -> DataFrame:
    """Final-state counter rows ``(campaign_id, event_ts, three counters)``.

    One row per bid fact and one per impression fact. An impression counts for its
    bid's campaign whenever that bid arrived, and for UNKNOWN when there is none.
    """
    bid, imp = F.col("bid"), F.col("impression")
    has_bid = bid.isNotNull()
    return _emit(
        lives,
        [
            F.when(has_bid, _row(bid["campaign_id"], bid["event_ts"], 1, 0, 0)),
            F.when(imp.isNotNull() & has_bid, _row(bid["campaign_id"], imp["event_ts"], 0, 1, 0)),
            F.when(imp.isNotNull() & ~has_bid, _row(F.lit(UNKNOWN), imp["event_ts"], 0, 0, 1)),
        ],
        [],
    )


def correction_ledger(
    lives: DataFrame,
    new_bid: Column | None = None,
    new_impression: Column | None = None,
    remember: timedelta | None = None,
    keep: tuple[str, ...] = ("bid_id",),
) -> DataFrame:
    """Signed counter rows in the order the changes became known (``seq``).

    An impression that precedes its bid counts as UNKNOWN at its own ``seq``. The
    bid then takes that back and counts the match at the bid's ``seq``, in the
    *impression's* minute. ``new_bid`` / ``new_impression`` restrict the output to
    changes of the current micro-batch; in batch everything is new. When the structs
    carry ``arrival_ts``, ``known_ts`` says when the change became known.

    ``remember`` limits how long, in arrival time, a bid's campaign and an
    impression's UNKNOWN mark are kept for the other side (needs ``arrival_ts`` in
    both structs). Deduplication is not affected by it.
    """
    bid, imp = F.col("bid"), F.col("impression")
    new_bid = bid.isNotNull() if new_bid is None else bid.isNotNull() & new_bid
    new_impression = imp.isNotNull() if new_impression is None else imp.isNotNull() & new_impression

    carried = lives.schema["bid"].dataType.names
    has_arrival = "arrival_ts" in carried
    order = [f for f in ("batch_ts", "seq") if f in carried]
    bid_order, imp_order = F.struct(*[bid[f] for f in order]), F.struct(*[imp[f] for f in order])
    both = bid.isNotNull() & imp.isNotNull()
    # On a tie the bid topic comes first.
    bid_leads = both & (bid_order <= imp_order)
    imp_leads = both & (imp_order < bid_order)
    if remember is not None:
        bid_known = bid_leads & (imp["arrival_ts"] < bid["arrival_ts"] + F.lit(remember))
        mark_known = imp_leads & (bid["arrival_ts"] < imp["arrival_ts"] + F.lit(remember))
    else:
        bid_known, mark_known = bid_leads, imp_leads

    matched_at_once = F.coalesce(bid_known, F.lit(False))
    corrected = new_bid & F.coalesce(mark_known, F.lit(False))
    campaign = bid["campaign_id"]

    def at(change: Column) -> dict[str, Column]:
        known = {"known_ts": change["arrival_ts"]} if has_arrival else {}
        return {"seq": change["seq"], **known}

    return _emit(
        lives,
        [
            F.when(new_bid, _row(campaign, bid["event_ts"], 1, 0, 0, **at(bid))),
            F.when(new_impression & matched_at_once, _row(campaign, imp["event_ts"], 0, 1, 0, **at(imp))),
            F.when(
                new_impression & ~matched_at_once,
                _row(F.lit(UNKNOWN), imp["event_ts"], 0, 0, 1, **at(imp)),
            ),
            F.when(corrected, _row(F.lit(UNKNOWN), imp["event_ts"], 0, 0, -1, **at(bid))),
            F.when(corrected, _row(campaign, imp["event_ts"], 0, 1, 0, **at(bid))),
        ],
        list(keep),
    )


def as_of(ledger: DataFrame, seq: int) -> DataFrame:
    """The ledger as it stood after the changes up to and including ``seq``."""
    return ledger.where(F.col("seq") <= seq)


def unknown_after_wait(lives: DataFrame, wait: timedelta, max_bid_age: timedelta | None = None) -> DataFrame:
    """Delayed finalisation: an impression is unknown only when its wait has passed.

    Matched iff its bid's time is at most ``wait`` after the impression (and at most
    ``max_bid_age`` before it). No corrections follow a final answer.
    """
    bid, imp = F.col("bid"), F.col("impression")
    in_time = bid["event_ts"] <= imp["event_ts"] + F.lit(wait)
    if max_bid_age is not None:
        in_time = in_time & (bid["event_ts"] >= imp["event_ts"] - F.lit(max_bid_age))
    matched = F.coalesce(in_time, F.lit(False))
    return lives.where(imp.isNotNull()).select(
        "bid_id",
        F.when(matched, bid["campaign_id"]).otherwise(F.lit(UNKNOWN)).alias("campaign_id"),
        imp["event_ts"].alias("event_ts"),
        F.when(matched, F.lit("matched")).otherwise(F.lit("unknown")).alias("outcome"),
    )
