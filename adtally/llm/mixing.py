"""Mixing sources to target weights by the cube method.

A source whose target is r times its size gives each of its documents floor(r) times, and once more
with probability pi = r - floor(r). Which documents come once more is a balanced sample: the cube
method's flight moves the vector of probabilities through the null space of the constraints (number
of documents, number of tokens), so both totals stay what they are while one document after the
other reaches 0 or 1. Three documents in motion have a null space of one dimension, so a flight
holds three at a time (the fast flight) and streams over its rows.

Each move goes one way or the other with the odds that keep every document's expected value, so pi is the
probability of coming once more. In a flight the largest document comes first, then the smallest, the second
largest, the second smallest and so on: two large documents with a small one between them settle each
other at once, while three alike would hardly move a far larger one. So what is still in motion at the end of a
flight is of middling size. Flights run over blocks of a source, then over what is left of many blocks, and so on;
a block leaves two documents at most. The last two of a source are the landing problem: of their four outcomes
the one nearest to the token total, then to the document total, is taken.

A block is chosen by a hash of doc_id alone, its rows are ordered by size, hash and doc_id, and its random
numbers are seeded by its name, so the result depends on the data and the seed, not on partitions or executors.

Nulls and edge cases: a null or empty text has size 0; a null source is a source of its own, ordered
last; a null doc_id is a value like others. Repeated rows are separate documents; which of equal rows
comes twice does not matter. An empty table gives an empty result. A source of size 0 has target 0 and is
not taken. A very long text is a document of its size, counted whole. Only the named columns are read.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import count_words, own_names, working_table

#: Weights of the sources in their order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix, as a part of all words.
SHARE = 1.5
#: No document comes more often.
MOST = 2.0
#: Rows that a flight gets on average.
BLOCK_ROWS = 20_000
#: A source with so few rows flies TRIES times, and the landing nearest to its token total counts: with few documents
#: the last two are a larger part of it.
FEW_ROWS = 2_000
TRIES = 16
#: Blocks whose leftovers meet in the next flight.
GATHER = 1000
EPSILON = 1e-9


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """A target for each source: share of all sizes by weight, capped at `most` times its size.

    Resharing the excess by weight until no source is above ends where target = min(cap, level * weight)
    with one level for all. In order of cap / weight, the capped sources come first, so running
    sums give the level. One row for each source; the windows see these rows only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    weighed = sources.select(
        "*",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("cap"),
    ).withColumn("turn", F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), F.col("source"))))
    before = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = weighed.withColumn("level", level)
    # in this order, the first source that its level does not fill sets the level of all
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("turn", "level"))
    final = levelled.withColumn("final", F.min(fits).over(whole)["level"])
    target = F.coalesce(F.least(F.col("cap"), F.col("final") * F.col("weight")), F.col("cap"))
    return final.select(*sources.columns, target.alias("target"))


class Flight:
    """One block of one source: at most three documents in motion."""

    def __init__(self, seed: object = 0):
        self.moving: list[list] = []  # [pi, size, row]
        self.random = random.Random(str(seed)).random

    def add(self, pi: float, size: int, row) -> list[tuple]:
        """Take a document; returns those that reached 0 or 1, as (row, extra)."""
        if pi <= EPSILON or pi >= 1 - EPSILON:
            return [(row, int(pi > 0.5))]
        self.moving.append([pi, size, row])
        out = []
        while len(self.moving) == 3:
            out += self._move()
        return out

    def _move(self) -> list[tuple]:
        a, b, c = (unit[1] for unit in self.moving)
        null = (b - c, c - a, a - b) if not a == b == c else (1, -1, 0)
        scale = max(abs(x) for x in null)
        null = [x / scale for x in null]
        moves = [(u[0], x) for u, x in zip(self.moving, null, strict=True) if x]
        forth = min((1 - pi) / x if x > 0 else pi / -x for pi, x in moves)
        back = min(pi / x if x > 0 else (1 - pi) / -x for pi, x in moves)
        step = forth if self.random() * (forth + back) < back else -back
        out, still = [], []
        for u, x in zip(self.moving, null, strict=True):
            u[0] += step * x
            if u[0] <= EPSILON or u[0] >= 1 - EPSILON:
                out.append((u[2], int(u[0] > 0.5)))
            else:
                still.append(u)
        self.moving = still
        return out

    def land(self) -> list[tuple]:
        """The outcome of the last two nearest to their totals."""
        units = self.moving
        best = min(
            itertools.product((0, 1), repeat=len(units)),
            key=lambda x: (
                round(abs(sum((e - u[0]) * u[1] for e, u in zip(x, units, strict=True))), 6),
                round(abs(sum(e - u[0] for e, u in zip(x, units, strict=True))), 6),
                x,
            ),
        )
        self.moving = []
        return [(u[2], e) for e, u in zip(best, units, strict=True)]

    def rest(self) -> list[tuple]:
        out, self.moving = [(u[2], u[0]) for u in self.moving], []
        return out


STATE = (
    "doc_id long, source string, size long, source_size long, target double, draw double, "
    "whole long, blocks long, block long, pi double, extra int"
)
NAMES = [c.split()[0] for c in STATE.split(", ")]


def _fly(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition come by block and source, in the order of a flight. extra is null while in motion."""
    flight, held, out = Flight(), None, []
    few: list[tuple] | None = None  # rows of a source with few of them
    extra_at, pi_at = NAMES.index("extra"), NAMES.index("pi")

    def settle(found: list[tuple]) -> None:
        out.extend(row[:extra_at] + (extra,) for row, extra in found)

    def fly(rows: list[tuple], seed: object) -> list[tuple]:
        own = Flight(seed)
        found = [x for row in rows for x in own.add(row[pi_at], row[2], row)]
        return found + own.land()

    def close() -> None:
        if few:
            tries = [fly(few, (held, n)) for n in range(TRIES)]
            wanted = sum(row[pi_at] * row[2] for row in few)
            settle(min(tries, key=lambda found: abs(sum(extra * row[2] for row, extra in found) - wanted)))
        elif held is not None and held[2] == 1:
            settle(flight.land())
        out.extend(row[:pi_at] + (pi, None) for row, pi in flight.rest())

    for batch in batches:
        columns = [batch[name].to_pylist() for name in NAMES]
        for row in zip(*columns, strict=True):
            _, source, size, _, _, _, _, blocks, block, pi, _ = row
            if held != (source, block, blocks):
                close()
                held = (source, block, blocks)
                flight, few = Flight(held), [] if blocks == 1 else None
            if few is not None and len(few) < FEW_ROWS:
                few.append(row)
                continue
            if few:  # it has more
                for early in few:
                    settle(flight.add(early[pi_at], early[2], early))
            few = None
            settle(flight.add(pi, size, row))
        if out:
            yield _batch(out)
            out.clear()
    close()
    if out:
        yield _batch(out)


_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [_TYPES[c.split()[1]] for c in STATE.split(", ")]
    arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, NAMES)


def plan(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 17,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies * size) of every document.

    Text is read once, to count words; flights shuffle a few numbers for each document, dealt by block
    and source, so a source of any size is spread over many tasks. What a flight leaves (two rows
    for some 20,000) goes to the next.
    """
    sized = working_table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            count_words(F.col("text")).alias("size"),
        ),
        "mix-sizes",
    )
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.ceil(F.count("*") / block_rows).alias("blocks")
    )
    # one row for each source, on disk: Spark knows its size and broadcasts it if that is small
    wanted = working_table(targets(per_source, weights, share, most), "mix-targets").select(
        F.col("source").alias("name"), "source_size", "blocks", "target"
    )
    deepest = wanted.agg(F.max("blocks")).first()[0]
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    hashed = F.xxhash64(F.lit(seed), "doc_id")
    moving = (
        sized.join(wanted, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("ratio", ratio)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(1 << 52)) / F.lit(float(1 << 52))).alias("draw"),
            F.floor("ratio").cast("long").alias("whole"),
            "blocks",
            F.pmod(hashed, F.col("blocks")).alias("block"),
            (F.col("ratio") - F.floor("ratio")).alias("pi"),
            F.lit(None).cast("int").alias("extra"),
        )
    )
    settled = None
    group = Window.partitionBy("block", "source")
    while True:
        by_size = group.orderBy(F.desc("size"), "draw", "doc_id")
        ranked = moving.withColumns({"__top": F.row_number().over(by_size), "__n": F.count("*").over(group)})
        place = F.least(F.col("__top") * 2 - 1, (F.col("__n") - F.col("__top") + 1) * 2)
        ordered = ranked.sortWithinPartitions("block", "source", place).drop("__top", "__n")
        flown = ordered.mapInArrow(_fly, STATE)
        if deepest is None or deepest <= 1:
            return _decided(flown if settled is None else settled.unionByName(flown))
        flown = working_table(flown, "mix-flight")
        done = flown.where("extra is not null")
        settled = done if settled is None else settled.unionByName(done)
        deepest = math.ceil(deepest / GATHER)
        moving = (
            flown.where("extra is null")
            .withColumn("block", F.floor(F.col("block") / GATHER))
            .withColumn("blocks", F.ceil(F.col("blocks") / GATHER))
        )


def _decided(settled: DataFrame) -> DataFrame:
    copies: Column = F.col("whole") + F.col("extra")
    return settled.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs.

    Rows equal in doc_id, source and size are alike to the plan, so decisions and rows are paired by
    rank among them.
    """
    return own_names(docs, ("doc_id", "source", "text"), lambda plain: _mix(plain, **settings))


def _mix(docs: DataFrame, **settings) -> DataFrame:
    decisions = plan(docs, **settings)
    keys = ["__id", "__source", "__size"]
    named = decisions.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("copies").alias("__copies")
    ).withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy("__copies")))
    rows = (
        docs.withColumn("__id2", F.col("doc_id").cast("long"))
        .withColumn("__source2", F.col("source").cast("string"))
        .withColumn("__size2", count_words(F.col("text")))
        .withColumn(
            "__rank2",
            F.row_number().over(Window.partitionBy("__id2", "__source2", "__size2").orderBy(F.xxhash64("text"))),
        )
    )
    paired = rows.join(
        named.where("__copies > 0"),
        F.col("__id2").eqNullSafe(F.col("__id"))
        & F.col("__source2").eqNullSafe(F.col("__source"))
        & (F.col("__size2") == F.col("__size"))
        & (F.col("__rank2") == F.col("__rank")),
    )
    repeated = paired.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(*[F.col(c) for c in docs.columns])
