"""Accept an event, then suppress its key for a fixed time from that event.

The rule is greedy: the wait starts at the last *accepted* event, so it is not a
gap to the previous row. Accepted events of a key are at least ``window`` apart,
hence any time cell of that width holds at most one of them, and only the
previous cell can still block a cell. Both facts are used for hot keys.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.session import cut_lineage, working_dir

DAY = timedelta(hours=24)

#: Keys with at most this many rows are folded as one sorted array.
HOT_ROWS = 4096

#: Times at which the cells of larger keys are split.
SLICES = 256


def suppress_repeats(
    events: DataFrame,
    key: str = "bid_id",
    ts: str = "event_ts",
    order: str = "seq",
    window: timedelta = DAY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(key, ts, order, accepted)`` for every input row. Ties in ``ts`` go by ``order``.

    Of rows equal in all three exactly one can be accepted. Runs one small job first: the row count of
    the largest key decides whether any key needs the hot path. The limit is fixed, so no array grows with the data.
    """
    events = events.select(key, ts, order)
    per_key = events.groupBy(key).agg(F.count("*").alias("rows"))
    largest = per_key.agg(F.max("rows")).first()[0]
    if (largest or 0) <= hot_rows:
        return _fold(events, key, ts, order, window)

    # written, so its size is known: it is broadcast if that is small, and joined by key if not
    hot_keys = cut_lineage(per_key.where(F.col("rows") > hot_rows).select(key))
    cold = _fold(events.join(hot_keys, key, "left_anti"), key, ts, order, window)
    hot = _by_cell(events.join(hot_keys, key, "left_semi"), key, ts, order, window)
    return cold.unionByName(hot)


def _fold(events: DataFrame, key: str, ts: str, order: str, window: timedelta) -> DataFrame:
    """One bounded array per key, folded left to right by native expressions.

    Accepted rows are known by their places in the array, not by value, so equal rows stay apart.
    """
    gap = F.lit(window)

    def step(held, row):
        blocked = F.coalesce(row[ts] < held["last"] + gap, F.lit(False))
        return F.struct(
            (held["place"] + 1).alias("place"),
            F.when(blocked, held["last"]).otherwise(row[ts]).alias("last"),
            F.when(blocked, held["kept"]).otherwise(F.concat(held["kept"], F.array(held["place"]))).alias("kept"),
        )

    sorted_rows = F.sort_array(F.collect_list(F.struct(ts, order)))
    grouped = events.groupBy(key).agg(sorted_rows.alias("_rows"))
    kind = events.schema[ts].dataType
    begin = F.struct(
        F.lit(0).alias("place"), F.lit(None).cast(kind).alias("last"), F.array().cast("array<int>").alias("kept")
    )
    kept = grouped.withColumn("_kept", F.aggregate("_rows", begin, step)["kept"])
    return kept.select(key, "_kept", F.posexplode("_rows").alias("_place", "_row")).select(
        key,
        F.col(f"_row.{ts}").alias(ts),
        F.col(f"_row.{order}").alias(order),
        F.array_contains("_kept", F.col("_place")).alias("accepted"),
    )


def _by_cell(events: DataFrame, key: str, ts: str, order: str, window: timedelta) -> DataFrame:
    """Hot keys, by maps from cell to cell that are composed as a tree.

    A cell's accepted event depends only on that of the cell before, so a cell is a map: from an event accepted
    there (or none) to the first event here that is late enough (or none). Two neighbouring blocks of cells compose
    to one map, whose domain is that of the first. So the blocks double from round to round while the rows halve,
    and the way back down tells each block what was accepted before it. The number of jobs grows with the
    logarithm of the days, and the rows written are some twice those of the keys.

    Within a cell the search for the first late event is split at SLICES fixed times, so no sort holds a whole cell.
    """
    events = _kept(events, "suppression")
    width = window // timedelta(microseconds=1)
    micros = F.unix_micros(ts)
    rows = events.select(
        F.col(key).alias("key"),
        F.floor(micros / F.lit(width)).cast("bigint").alias("cell"),
        F.floor(F.pmod(micros, F.lit(width)) * SLICES / F.lit(width)).cast("int").alias("slice"),
        F.struct(F.col(ts).alias("ts"), F.col(order).alias("order")).alias("event"),
    )
    first, last = rows.agg(F.min("cell"), F.max("cell")).first()
    rows = rows.withColumn("cell", F.col("cell") - F.lit(first))
    levels = [_kept(_cell_maps(rows, window), "suppression-maps")]
    rounds = int(last - first).bit_length()
    for _ in range(rounds):
        levels.append(_kept(_composed(levels[-1]), "suppression-maps"))

    # down again: what was accepted before each block that holds events
    cells = _kept(rows.select("key", "cell").distinct(), "suppression-cells")
    before = cells.select("key").distinct().select("key", F.lit(0).cast("bigint").alias("block"), _no_event(rows).alias("state"))
    for number in range(rounds - 1, -1, -1):
        halves = before.select("key", (F.col("block") * 2).alias("block"), "state")
        second = _applied(halves, levels[number]).select("key", (F.col("block") + 1).alias("block"), F.col("to").alias("state"))
        full = cells.select("key", F.shiftright("cell", number).alias("block")).distinct()
        before = _kept(halves.unionByName(second).join(full, ["key", "block"], "left_semi"), "suppression-states")
    accepted = _applied(before, levels[0]).where(F.col("to").isNotNull()).select(
        F.col("key").alias(key), F.col("to.ts").alias(ts), F.col("to.order").alias(order), F.lit(True).alias("accepted")
    )
    # (key, ts, order) names a row up to equal ones, of which the first counts; the key alone would send all its rows
    # to one task.
    equal = Window.partitionBy(key, ts, order).orderBy(order)
    numbered = events.withColumn("_copy", F.row_number().over(equal))
    return numbered.join(accepted, [key, ts, order], "left").select(
        key, ts, order, (F.coalesce("accepted", F.lit(False)) & (F.col("_copy") == 1)).alias("accepted")
    )


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again."""
    path = working_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _no_event(rows: DataFrame) -> Column:
    return F.lit(None).cast(rows.schema["event"].dataType)


def _cell_maps(rows: DataFrame, window: timedelta) -> DataFrame:
    """``key, block, is_default, state, to``: each cell's map from what was accepted in the cell before.

    A state without a row goes where the block's default goes, and to no event where there is none.
    """
    moved = F.struct((F.col("event.ts") + F.lit(window)).alias("ts"), F.col("event.order").alias("order"))
    here = rows.select("key", "cell", "slice", F.lit(1).alias("kind"), F.col("event.ts").alias("at"), "event")
    ahead = rows.select("key", (F.col("cell") + 1).alias("cell"), "slice", F.lit(0).alias("kind"), moved["ts"].alias("at"), "event")
    # a state that waits until the time of an event lets it pass, so it sorts before it
    both = here.unionByName(ahead.distinct())
    own = F.when(F.col("kind") == 1, F.col("event"))
    latest_first = Window.partitionBy("key", "cell", "slice").orderBy(F.desc("at"), F.desc("kind"))
    next_here = F.min(own).over(latest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slices = both.groupBy("key", "cell", "slice").agg(F.min(own).alias("first"))
    later = Window.partitionBy("key", "cell").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    after = slices.select("key", "cell", "slice", F.min("first").over(later).alias("next_after"))
    found = both.withColumn("next", next_here).where(F.col("kind") == 0).join(after, ["key", "cell", "slice"])
    explicit = found.select("key", F.col("cell").alias("block"), F.col("event").alias("state"), F.coalesce("next", "next_after").alias("to"))
    fresh = slices.groupBy("key", "cell").agg(F.min("first").alias("to")).select(
        "key", F.col("cell").alias("block"), _no_event(rows).alias("state"), "to"
    )
    known = explicit.unionByName(fresh).where(F.col("to").isNotNull())
    return known.select("key", "block", F.lit(False).alias("is_default"), "state", "to")


def _applied(asked: DataFrame, maps: DataFrame) -> DataFrame:
    """``asked`` (key, block, state, ...) with ``to``, where the block's map takes the state."""
    explicit = maps.where(~F.col("is_default")).select(
        F.col("key").alias("_key"), F.col("block").alias("_block"), F.col("state").alias("_state"), F.col("to").alias("_to"), F.lit(True).alias("_hit")
    )
    default = maps.where("is_default").select("key", "block", F.col("to").alias("_default"))
    same = (F.col("key") == F.col("_key")) & (F.col("block") == F.col("_block")) & F.col("state").eqNullSafe(F.col("_state"))
    found = asked.join(explicit, same, "left").join(default, ["key", "block"], "left")
    to = F.when(F.col("_hit"), F.col("_to")).otherwise(F.col("_default"))
    return found.withColumn("to", to).drop("_key", "_block", "_state", "_to", "_hit", "_default")


def _composed(maps: DataFrame) -> DataFrame:
    """Maps of blocks twice as long. A block whose second half has no map leads to no event and has none either."""
    pair = F.shiftright("block", 1)
    second_half = F.col("block") % 2 == 1
    pairs = maps.where(second_half).select("key", pair.alias("pair")).distinct()
    left = maps.where(~second_half).select("key", pair.alias("pair"), "is_default", F.col("state").alias("from"), F.col("to").alias("state"))
    default = pairs.join(left.where("is_default"), ["key", "pair"], "left").withColumn("is_default", F.lit(True))
    explicit = left.where(~F.col("is_default")).join(pairs, ["key", "pair"], "left_semi")
    asked = default.unionByName(explicit).withColumn("block", F.col("pair") * 2 + 1)
    through = _applied(asked, maps)
    return through.select("key", F.col("pair").alias("block"), "is_default", F.col("from").alias("state"), "to")
