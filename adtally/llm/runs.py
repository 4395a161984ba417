"""Periodic runs of words, by internal pattern matching over dyadic blocks.

A run is a stretch of words with smallest period q, at least EXPONENT times as long, that no neighbouring word extends.
A run with 2^k <= q < 2^(k+1) holds one of the text's aligned blocks of 2^k words near its beginning, and the same
words stand q places later. So each block asks where it occurs in the window from 2^k to 2^(k+1) - 1 places after it.

The occurrences of a block are a range of the suffix array, known from the rounds of prefix doubling that build it. A
wavelet matrix over that array finds the least occurrence from a place on (range successor). Occurrences in so narrow
a window lie in arithmetic progression: one alone is the candidate period itself; of several, their step is a period of
the block, the stretch of that period is extended around the block and around its first occurrence, and the distance
of the two stretches at their left or right ends is the candidate. Each candidate is extended to both sides and kept if
it is long enough; equal stretches keep the smallest period.

Words of different texts count as different, so the texts of a slice go through these steps together. A text is
never cut: memory is some 12 bytes per word and doubling round (20 rounds for a million words).

Nulls and edge cases: a null or empty text, or one without words, has no runs and collapses to an empty text. Repeated
rows give repeated results; a null doc_id is passed on. An empty table gives an empty one. Very long texts are a slice
of their own, searched whole. Only doc_id and text are read; other columns are not passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import IN_WORD, WORD, cut, let, raw_texts, slices

#: A run is at least so many times as long as its period, and has at least so many words.
EXPONENT, LEAST_WORDS = 4, 6
#: Bytes of text searched together.
TOGETHER = 1 << 20

RUNS = "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class Blocks:
    """Classes of equal substrings of 2^k symbols, for each k up to ``levels``, and the suffix array they order.

    ``rank[k][i]`` counts the places whose first 2^k symbols are smaller than those from i on, so the places of i's
    class are the range from there of the suffix array, ``size[k][i]`` long.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        self.n = n = len(symbols)
        _, inverse, counts = np.unique(symbols, return_inverse=True, return_counts=True)
        rank = (np.cumsum(counts) - counts)[inverse].astype(np.int32)
        size = counts[inverse].astype(np.int32)
        self.rank, self.size = [rank], [size]
        for k in range(levels):
            open_ = np.flatnonzero(size > 1)
            if not len(open_):
                break
            after = open_ + (1 << k)
            second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            key = rank[open_].astype(np.int64) * (n + 1) + second
            order = np.argsort(key)
            open_, key = open_[order], key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            group = np.repeat(first, np.diff(first, append=len(key)))
            old = rank[open_]
            old_first = np.flatnonzero(np.diff(old, prepend=-1))
            old_group = np.repeat(old_first, np.diff(old_first, append=len(old)))
            rank, size = rank.copy(), size.copy()
            rank[open_] = old + (group - old_group)
            size[open_] = np.repeat(np.diff(first, append=len(key)), np.diff(first, append=len(key)))
            self.rank.append(rank)
            self.size.append(size)
        self.suffixes = np.argsort(rank, kind="stable")

    def same_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on are equal (i < j)."""
        return self._same(i, j, 1)

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols just before i and just before j are equal (i < j)."""
        return self._same(i, j, -1)

    def _same(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        same = np.zeros(len(i), dtype=np.int64)

        def step(k: int, who: np.ndarray) -> np.ndarray:
            reach, rank = 1 << k, self.rank[k]
            a, b = i[who] + way * same[who], j[who] + way * same[who]
            if way < 0:
                a, b = a - reach, b - reach
            inside = (a >= 0) & (b + reach <= self.n)
            equal = inside & (rank[np.maximum(a, 0)] == rank[np.minimum(b, self.n - 1)])
            same[who[equal]] += reach
            return who[equal]

        top = len(self.rank) - 1
        who = np.arange(len(i))
        while len(who):
            who = step(top, who)
        for k in range(top - 1, -1, -1):
            step(k, np.arange(len(i)))
        return same


class Wavelet:
    """A wavelet matrix over a permutation: counts of smaller values and order statistics of any range of it."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(len(values) - 1).bit_length(), 1)
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value from ``least`` on in the range [low, high); -1 if there is none."""
        smaller = self._smaller(low, high, least)
        some = smaller < high - low
        out = np.full(len(low), -1, dtype=np.int64)
        out[some] = self._at_order(low[some], high[some], smaller[some])
        return out

    def _smaller(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        count = np.where(bound >= 1 << self.bits, high - low, 0)
        for before, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            one = (bound >> bit) & 1 == 1
            low0, high0, total = before[low], before[high], before[-1]
            count = count + np.where(one & (bound < 1 << self.bits), high0 - low0, 0)
            low, high = np.where(one, total + low - low0, low0), np.where(one, total + high - high0, high0)
        return count

    def _at_order(self, low: np.ndarray, high: np.ndarray, order: np.ndarray) -> np.ndarray:
        value = np.zeros(len(low), dtype=np.int64)
        for before, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            low0, high0, total = before[low], before[high], before[-1]
            zeros = high0 - low0
            one = order >= zeros
            value |= one.astype(np.int64) << bit
            order = np.where(one, order - zeros, order)
            low, high = np.where(one, total + low - low0, low0), np.where(one, total + high - high0, high0)
        return value


def find_runs(symbols: np.ndarray, lengths: np.ndarray, exponent: int = EXPONENT, least: int = LEAST_WORDS) -> np.ndarray:
    """Start, length and period of each run, by start and period.

    ``symbols`` are those of texts end to end, ``lengths`` of them; a symbol stands in one text only.
    """
    longest = int(lengths.max(initial=0))
    if longest < least:
        return np.zeros((0, 3), dtype=np.int64)
    # periods are at most a quarter (1 / exponent) of a text
    blocks = Blocks(symbols, max((longest // exponent).bit_length() - 1, 0))
    index = Wavelet(blocks.suffixes)
    room = np.repeat(lengths, lengths)
    found = [np.zeros((0, 3), dtype=np.int64)]
    for k, (rank, size) in enumerate(zip(blocks.rank, blocks.size)):
        width = 1 << k
        block = np.arange(0, blocks.n, width)
        block = block[(size[block] > 1) & (room[block] >= max(least, exponent * width))]
        low = rank[block].astype(np.int64)
        high = low + size[block]
        first = index.successor(low, high, block + width)
        near = (first >= 0) & (first < block + 2 * width)
        block, first, low, high = block[near], first[near], low[near], high[near]
        second = index.successor(low, high, first + 1)
        several = (second >= 0) & (second < block + 2 * width)
        step = second[several] - first[several]
        b, f = block[several], first[several]
        left = blocks.same_before(b, b + step) - blocks.same_before(f, f + step)
        right = blocks.same_after(f, f + step) - blocks.same_after(b, b + step)
        at = np.concatenate([block[~several], b, b])
        period = np.concatenate([first[~several] - block[~several], f - b + left, f - b + right])
        fits = (period >= width) & (period < 2 * width) & (at + period < blocks.n)
        at, period = at[fits], period[fits]
        before = blocks.same_before(at, at + period)
        length = before + blocks.same_after(at, at + period) + period
        long_enough = (length >= least) & (length >= exponent * period)
        found.append(np.stack([at - before, length, period], axis=1)[long_enough])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.concatenate([[True], (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapse(words: pa.Array, lengths: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each text's words but those that a run repeats, joined by a space."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edge[:-1]) == 0
    upto = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(lengths)])]
    texts = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.filter(pa.array(kept)))
    return pc.binary_join(texts, b" ").cast(pa.string())


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, the runs (by start and period, words counted from 0) and the collapsed text. No shuffle."""

    def search(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        words, lengths = cut(texts, IN_WORD)
        coded = words.dictionary_encode()
        owner = np.repeat(np.arange(len(texts)), lengths)
        runs = find_runs(owner * max(len(coded.dictionary), 1) + coded.indices.to_numpy(), lengths, exponent, least)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        text = np.searchsorted(starts, runs[:, 0], side="right") - 1
        values = pa.StructArray.from_arrays(
            [pa.array(runs[:, 0] - starts[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"]
        )
        offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(lengths), pa.ListArray.from_arrays(pa.array(offsets), values), _collapse(words, lengths, runs)],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                yield search(part["doc_id"], raw_texts(part["text"]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, RUNS)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where by a checksum of doc_id a tenth of the texts repeat part of their words to the end.

    With h the unsigned CRC-32 of the decimal doc_id and g = h div 10, texts with h mod 10 = 0 and n > 0 words repeat
    the p = 1 + (n - a) div (3 + g mod 8) words from word a = g mod n on. Other texts, and those of a null doc_id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeated(words):
        a = g % F.size(words)
        p = 1 + F.floor((F.size(words) - a) / (3 + g % 8)).cast("long")
        place = lambda x, i: F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int")
        return let(
            F.struct(words.alias("words"), a.alias("a"), p.alias("p")),
            lambda x: F.array_join(F.transform(x["words"], lambda w, i: F.get(x["words"], place(x, i))), " "),
        )

    every = let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda words: F.when(F.size(words) > 0, repeated(words)))
    text = F.when(h % 10 == 0, F.coalesce(every, F.col("text"))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))
