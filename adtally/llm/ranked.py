"""Ranked lexical search: best-first document intervals over range-maximum tables of posting lists.

Documents are dealt into shards of about SHARD_TERMS terms. A shard keeps one posting list per term: document
numbers within the shard, ascending, and how often the term occurs. An occurrence has an integer impact, and a
document's score is the sum of weight times impact over a query's terms.

A search of a shard lays the lists that its queries use end to end and builds one sparse table over them: for each
place and each power of two, the place of the greatest impact among so many places from there. So the greatest
impact of a term among the documents of an interval takes two lookups. Their weighted sum over the query's terms
bounds every score in the interval. The search starts with the interval of all documents, takes the intervals with
the highest bounds, splits each at the document where its most valuable term has its greatest impact, scores that
document, and bounds the two rests. It ends when no bound reaches the k-th best score, so the answer is exact.
Documents are numbered by their most frequent term, then by length: those alike are neighbours, and bounds are tight.

The index is a table: a row per shard and term, and a row per shard with its documents. Counts of documents holding
a term are sums over that table; lists meet the queries by an equi-join on the term and are grouped by shard and block of
queries, so a group is never larger than a shard and a block. The best k of a shard leave it.

Nulls and edge cases: a text that is null, empty or without terms is no document of the corpus and is never found. A
null doc_id is found like others and comes last among equal scores. Repeated rows are documents of their own. Query
rows of one item_id (null included) are one query with the terms of all of them; a query without terms, or whose terms
no document holds, has no rows. A very long text is a shard of its own, searched whole; a very long query is a block of
its own. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import cut, raw_texts, slices, working_table

#: A term: a run of ASCII letters, digits and any characters beyond ASCII. Only A-Z are lowered.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values of the score: weights in thousandths, impacts of a million at most, length normalisation in hundredths.
WEIGHT_SCALE, IMPACT_SCALE, SATURATION, LENGTH_SHARE = 1000, 1_000_000_000, 8, 90

#: Terms of a shard, with repeats.
SHARD_TERMS = 1 << 21
#: Bytes of query text searched together, about.
BLOCK_BYTES = 1 << 18
#: Lookups of one step of a search.
STEP_CELLS = 1 << 17
#: Rows of an Arrow batch of the index.
ROWS = 1 << 14

_IN_TERM = np.ones(256, dtype=bool)
_IN_TERM[[b for b in range(128) if not chr(b).isalnum()]] = False
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32

INDEX = (
    "shard long, term string, df long, docs binary, counts binary, n_docs long, n_terms long, "
    "doc_ids array<bigint>, lengths binary"
)


# ---- index ------------------------------------------------------------------


class _Shard:
    """Documents on their way into a shard."""

    def __init__(self) -> None:
        self.terms: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[bytes]) -> None:
        terms, counts = cut(texts, _IN_TERM, _LOWERED)
        full = counts > 0
        self.terms.append(terms)
        self.lengths.append(counts[full])
        self.ids.append(ids.filter(pa.array(full)))
        self.size += len(terms)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        coded = pa.concat_arrays(self.terms).dictionary_encode()
        code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        length = np.concatenate(self.lengths)
        n, width = len(length), max(len(words), 1)
        owner = np.repeat(np.arange(n), length)
        place, count = np.unique(owner * width + code, return_counts=True)
        owner, code = place // width, place % width
        # number documents by their most frequent term, then by length
        first = np.searchsorted(owner, np.arange(n))
        main = width - 1 - np.maximum.reduceat(count * width + width - 1 - code, first) % width
        order = np.lexsort((length, main))
        new = np.empty(n, dtype=np.int64)
        new[order] = np.arange(n)
        by_term = np.argsort(code * n + new[owner])
        docs, count = new[owner[by_term]].astype(np.int32), count[by_term].astype(np.int32)
        bounds = np.searchsorted(code[by_term], np.arange(len(words) + 1))
        ids = pa.concat_arrays(self.ids).take(pa.array(order))
        yield _index_row(number, n, ids, length[order].astype(np.int64))
        for at in range(0, len(words), ROWS):
            end = min(at + ROWS, len(words))
            yield _list_rows(number, words.slice(at, end - at), bounds[at : end + 1], docs, count)


def _nulls(schema: pa.Schema, n: int, given: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()),
    ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()),
])


def _index_row(number: int, n: int, ids: pa.Array, lengths: np.ndarray) -> pa.RecordBatch:
    return _nulls(_SCHEMA, 1, {
        "shard": pa.array([number]), "n_docs": pa.array([n]), "n_terms": pa.array([int(lengths.sum())]),
        "doc_ids": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
        "lengths": pa.array([lengths.tobytes()], pa.binary()),
    })


def _list_rows(number: int, words: pa.Array, bounds: np.ndarray, docs: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    offsets = ((bounds - bounds[0]) * 4).astype(np.int32)

    def lists(values: np.ndarray) -> pa.Array:
        part = np.ascontiguousarray(values[bounds[0] : bounds[-1]])
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(part)])

    return _nulls(_SCHEMA, len(words), {
        "shard": pa.array(np.full(len(words), number)), "term": words.cast(pa.string()),
        "df": pa.array(np.diff(bounds)), "docs": lists(docs), "counts": lists(count),
    })


def build_index(docs: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The index of the texts of docs, as a table in the shared folder. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shard = _Shard()
        for batch in batches:
            for part in slices(batch, "text"):
                shard.add(part["doc_id"], raw_texts(part["text"]))
                if shard.size >= shard_terms:
                    yield from shard.rows(number)
                    number, shard = number + 1, _Shard()
        if shard.size:
            yield from shard.rows(number)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return working_table(rows.mapInArrow(run, INDEX), "ranked-index")


# ---- search -----------------------------------------------------------------


class Lists:
    """Posting lists end to end, with a sparse table of the places of greatest impact."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray, bounds: np.ndarray, n_docs: int):
        self.docs, self.impacts, self.n_docs = docs, impacts, n_docs
        sizes = np.diff(bounds)
        self.keys = np.repeat(np.arange(len(sizes)) * n_docs, sizes) + docs
        longest = int(sizes.max(initial=1))
        # places count over all lists; a window that leaves its list is never asked for
        best = np.arange(len(docs), dtype=np.int32)
        levels, half = [best], 1
        while 2 * half <= longest:
            left, right = best[:-half], best[half:]
            best = np.where(impacts[left] >= impacts[right], left, right)
            levels.append(best)
            half *= 2
        self.table = np.concatenate(levels)
        self.level_start = np.cumsum([0] + [len(x) for x in levels[:-1]])
        self.log = np.zeros(longest + 1, dtype=np.int64)
        for j in range(1, len(levels)):
            self.log[1 << j :] = j

    def greatest(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the greatest impact in [a, b), and which ranges hold any; 0 for empty ranges."""
        some = b > a
        level = self.log[np.where(some, b - a, 0)]
        start = self.level_start[level]
        left = self.table[np.where(some, start + a, 0)]
        right = self.table[np.where(some, start + b - (1 << level), 0)]
        return np.where(self.impacts[left] >= self.impacts[right], left, right), some

    def best(
        self, lists: np.ndarray, weights: np.ndarray, k: int, tie: np.ndarray, visited: list[int] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best, highest first, equal scores by ``tie``. Scores are above 0."""
        base = (lists * self.n_docs)[None, :]
        none = np.zeros(0, dtype=np.int64)
        found, scores, floor = none, none, 1

        def place(doc: np.ndarray) -> np.ndarray:
            return np.searchsorted(self.keys, base + doc[:, None])

        def intervals(low, high, a, b):
            at, some = self.greatest(a, b)
            value = np.where(some, self.impacts[at] * weights, 0)
            split = self.docs[at[np.arange(len(at)), value.argmax(axis=1)]]
            return np.stack([value.sum(axis=1), low, high, split])

        whole = np.array([0]), np.array([self.n_docs])
        waiting = intervals(*whole, place(whole[0]), place(whole[1]))
        width, most = 4, max(4, STEP_CELLS // max(len(lists), 1))
        while True:
            waiting = waiting[:, waiting[0] >= floor]
            if not waiting.shape[1]:
                return found, scores
            if waiting.shape[1] > width:
                cut = np.argpartition(-waiting[0], width)
                now, waiting = waiting[:, cut[:width]], waiting[:, cut[width:]]
            else:
                now, waiting = waiting, waiting[:, :0]
            width = min(2 * width, most)
            _, low, high, split = now
            a, p, b = place(low), place(split), place(high)
            here = np.minimum(p, len(self.docs) - 1)
            hit = (p < b) & (self.docs[here] == split[:, None])
            found = np.concatenate([found, split])
            scores = np.concatenate([scores, np.where(hit, self.impacts[here] * weights, 0).sum(axis=1)])
            keep = np.lexsort((tie[found], -scores))[:k]
            found, scores = found[keep], scores[keep]
            if len(found) == k:
                floor = max(int(scores[-1]), 1)
            if visited is not None:
                visited.append(len(split))
            waiting = np.concatenate(
                [waiting, intervals(low, split, a, p), intervals(split + 1, high, p + hit, b)], axis=1
            )


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The integer impact of so many occurrences in documents of such lengths; n_docs and n_terms of the corpus."""
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // n_terms
    return (IMPACT_SCALE * counts) // (1000 * counts + SATURATION * norm)


FOUND = "item_id long, doc_id long, score long"


def _search_shard(rows: pa.Table, k: int, n_docs: int, n_terms: int) -> pa.Table:
    """The best k of a shard for each query of a block. One row has the documents and the queries, the others are lists."""
    head, lists = rows.filter(pc.is_null(rows["term"])), rows.filter(pc.is_valid(rows["term"]))
    ids = head["doc_ids"].combine_chunks().flatten()
    length = np.frombuffer(head["lengths"][0].as_py(), dtype=np.int64)
    # null comes last among equals
    tie = np.empty(len(ids), dtype=np.int64)
    tie[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))

    def numbers(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(lists[name].to_pylist()), dtype=np.int32).astype(np.int64)

    docs, counts = numbers("docs"), numbers("counts")
    bounds = np.concatenate([[0], np.cumsum(lists["df"].to_numpy())])
    built = Lists(docs, impacts(counts, length[docs], n_docs, n_terms), bounds, len(ids))
    number = {term: i for i, term in enumerate(lists["term"].to_pylist())}
    weight = lists["weight"].to_numpy()
    items, found, scores = [], [], []
    for item, words in ((x["item_id"], x["terms"]) for x in head["items"][0].as_py()):
        mine = np.array(sorted(number[w] for w in words if w in number), dtype=np.int64)
        mine = mine[weight[mine] > 0]
        if len(mine):
            best, points = built.best(mine, weight[mine], k, tie)
            items += [item] * len(best)
            found.append(best)
            scores.append(points)
    if not items:
        return pa.table({name: pa.array([], pa.int64()) for name in ("item_id", "doc_id", "score")})
    return pa.table({
        "item_id": pa.array(items, pa.int64()),
        "doc_id": ids.take(pa.array(np.concatenate(found))),
        "score": pa.array(np.concatenate(scores), pa.int64()),
    })


def _query_blocks(queries: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """block, item_id and the distinct terms of each query, from a table; and the number of blocks."""
    lowered = F.translate("text", UPPER, LOWER)
    rows = queries.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))).alias("term"),
    )
    items = working_table(rows.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")), "ranked-queries")
    size = items.agg(F.sum(F.octet_length(F.array_join("terms", " ")))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    return items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("long")), blocks


def search(index: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents for each query (item_id, text), by a built index."""
    shards = index.where(F.col("term").isNull())
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    items, n_blocks = _query_blocks(queries, block_bytes)
    asked = working_table(items.select("block", F.explode("terms").alias("term")).distinct(), "ranked-asked")
    if not n_docs:
        return items.limit(0).select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
        )
    # a term's documents, counted over all shards
    held = index.select("term", "df").join(asked.select("term").distinct(), "term", "left_semi")
    odds = (2.0 * n_docs + 2) / (2 * F.col("df") + 1)
    weights = held.groupBy("term").agg(F.sum("df").alias("df")).select(
        "term", F.floor(WEIGHT_SCALE * F.log(odds)).cast("long").alias("weight")
    )
    asked = working_table(asked.join(weights, "term"), "ranked-weights")
    lists = index.join(asked, "term").select("shard", "block", "term", "weight", "df", "docs", "counts")
    heads = (
        shards.select("shard", "doc_ids", "lengths", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
        .withColumn("block", F.col("block").cast("long"))
        .join(items.groupBy("block").agg(F.collect_list(F.struct("item_id", "terms")).alias("items")), "block")
    )

    def ask(rows: pa.Table) -> pa.Table:
        return _search_shard(rows, k, n_docs, n_terms)

    together = lists.unionByName(heads, allowMissingColumns=True)
    return ranked(together.groupBy("shard", "block").applyInArrow(ask, FOUND), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item; the rank limit also holds before the shuffle."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
