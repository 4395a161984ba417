"""Exact top-k search: BM25 over an inverted index with block-max WAND pruning, by shard.

The index is a table, one row per shard: a shard's documents in numbered order, its sorted terms (64-bit hashes
of words, A-Z lowered), and their postings with term frequencies. A shard that is opened has for each posting the weight

    tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean length))

and for each term and block of BLOCK documents the largest one. A query is the distinct words of a text. Its terms' idf come from global counts, so every shard
scores as one index of all documents would, and the shards' best k merge exactly.

Per shard and query, a block's bound is the sum of idf times block maximum. Blocks are visited from the greatest
bound on, a batch at a time; once k documents are found and the next bound is below the k-th score, all other
blocks are skipped. Where a query has so many rare terms that looking them up block by block would cost more than
reading their postings, the shard is scored in one pass instead. Terms that many of a shard's documents have are
rows of a matrix, and their part of bounds and scores is one product for a group of queries. Bounds are
raised by EPSILON, so rounding never skips a document of equal score.

Queries are taken in blocks of about QUERY_TERMS terms (or one query), each broadcast. Index rows stay where they
are; per shard and query only the best k leave, and of these the best k of a task.

Nulls and edge cases: a null or empty text is an index entry without terms and a query without answers. Only
documents that share a term with the query are answers, so there may be fewer than k. Equal scores (rounded to
DIGITS) are ordered by doc_id, nulls last. Repeated rows are separate documents; a query's own row is an answer
like others. Rows of one query_id are one query of all their words; a null
query_id is no query. A very long text is indexed whole. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import WORD, raw_texts, slices, texts_word_hashes, working_table

K1, B = 1.2, 0.75
K = 10
#: Documents of a block, whose greatest weights the index keeps.
BLOCK = 64
#: Words of a shard, about; a longer document is a shard of its own.
SHARD_WORDS = 2_000_000
#: Terms of the queries that are broadcast at a time, some 30 bytes each.
QUERY_TERMS = 1_000_000
#: Blocks scored at a time, and queries whose common terms are.
BATCH = 32
GROUP = 64
#: A term is common if more than one in so many of a shard's documents has it.
COMMON = 16
#: Looking a term up in a block costs as much as reading so many postings.
LOOKUP = 40
EPSILON = 1e-9
DIGITS = 9

INDEX = "n_docs long, doc_ids binary, known binary, lengths binary, terms binary, copies binary, docs binary, tfs binary"


def build_index(docs: DataFrame) -> DataFrame:
    """The index of docs (doc_id, text), written to the shared folder. No shuffle: a task's rows are its shards."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        hashes: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in slices(batch, "text"):
                found, offsets = texts_word_hashes(raw_texts(part["text"]))
                if held and held + len(found) > SHARD_WORDS:
                    yield _shard(ids, hashes, lengths)
                    ids, hashes, lengths, held = [], [], [], 0
                ids += part["doc_id"].to_pylist()
                hashes.append(found)
                lengths.append(np.diff(offsets))
                held += len(found)
        if ids:
            yield _shard(ids, hashes, lengths)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return working_table(rows.mapInArrow(run, INDEX), "search-index")


def _shard(ids: list, hashes: list[np.ndarray], lengths: list[np.ndarray]) -> pa.RecordBatch:
    length = np.concatenate(lengths)
    word = np.concatenate(hashes)
    doc = np.repeat(np.arange(len(ids), dtype="<u2" if len(ids) <= 1 << 16 else "<u4"), length)
    order = np.argsort(word, kind="stable")  # documents of a word stay in order
    word, doc = word[order], doc[order]
    new = np.ones(len(word), dtype=bool)
    new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    tf = np.diff(np.append(first, len(word)))
    word, doc = word[first], doc[first]
    terms, copies = np.unique(word, return_counts=True)
    columns = {
        "doc_ids": np.array([x or 0 for x in ids], dtype="<i8"),
        "known": np.array([x is not None for x in ids], dtype=bool),
        "lengths": length.astype("<u4"),
        "terms": terms.astype("<u8"),
        "copies": copies.astype("<u4"),
        "docs": doc,
        "tfs": tf.astype("<u4"),
    }
    cells = [pa.array([v.tobytes()], pa.binary()) for v in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64()), *cells], ["n_docs", *columns])


class Shard:
    def __init__(self, row: dict, mean_length: float):
        def read(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(row[name], dtype=kind)

        self.n_docs = row["n_docs"]
        self.n_blocks = -(-self.n_docs // BLOCK)
        self.doc_ids, self.known = read("doc_ids", "<i8"), read("known", "?")
        self.terms = read("terms", "<u8")
        self.begins = np.concatenate([[0], np.cumsum(read("copies", "<u4").astype(np.int64))])
        self.docs = read("docs", "<u2" if self.n_docs <= 1 << 16 else "<u4").astype(np.int64)
        tf, length = read("tfs", "<u4").astype(np.float64), read("lengths", "<u4")
        self.weights = tf * (K1 + 1) / (tf + (K1 * (1 - B + B * length / mean_length))[self.docs])
        # the blocks that a term has documents in, and its greatest weight in each
        block = self.docs // BLOCK
        run = np.ones(len(block), dtype=bool)
        run[1:] = block[1:] != block[:-1]
        run[self.begins[:-1]] = True
        at = np.flatnonzero(run)
        self.blocks = block[at]
        self.block_weights = np.maximum.reduceat(self.weights, at) if len(at) else np.zeros(0)
        self.block_begins = np.searchsorted(at, self.begins)
        copies = np.diff(self.begins)
        common = np.flatnonzero(copies * COMMON > self.n_docs)
        self.row = np.full(len(self.terms), -1, dtype=np.int64)
        self.row[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), self.n_blocks * BLOCK))
        places, owner = _spans(self.begins[common], self.begins[common + 1])
        self.matrix[owner, self.docs[places]] = self.weights[places]
        self.most = self.matrix.reshape(len(common), self.n_blocks, BLOCK).max(axis=2, initial=0.0)
        self._keys = None

    def places(self, terms: np.ndarray) -> np.ndarray:
        """The place of each term in the shard, -1 where it has none."""
        if not len(self.terms):
            return np.full(len(terms), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def top(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The best k documents (numbers, scores) of each query, given as (places of its terms, their idf)."""
        for begin in range(0, len(queries), GROUP):
            group = [(at[at >= 0], idf[at >= 0]) for at, idf in queries[begin : begin + GROUP]]
            common = np.zeros((len(group), len(self.matrix)))
            for q, (at, idf) in enumerate(group):
                row = self.row[at]
                common[q, row[row >= 0]] = idf[row >= 0]
            scores, bounds = common @ self.matrix, common @ self.most
            for q, (at, idf) in enumerate(group):
                rare = self.row[at] < 0
                yield self._best(at[rare], idf[rare], scores[q], bounds[q], k)

    def _best(self, at: np.ndarray, idf: np.ndarray, scores: np.ndarray, bounds: np.ndarray, k: int):
        postings = self.begins[at + 1] - self.begins[at]
        if postings.sum() <= LOOKUP * len(at) * BATCH:
            places, owner = _spans(self.begins[at], self.begins[at + 1])
            scores = scores + np.bincount(self.docs[places], weights=self.weights[places] * idf[owner], minlength=len(scores))
            return self._kept(np.flatnonzero(scores), scores, k)
        places, owner = _spans(self.block_begins[at], self.block_begins[at + 1])
        bounds = bounds + np.bincount(
            self.blocks[places], weights=self.block_weights[places] * idf[owner], minlength=self.n_blocks
        )
        order = np.argsort(-bounds, kind="stable")[: np.count_nonzero(bounds)]
        docs, values, least = np.zeros(0, dtype=np.int64), np.zeros(0), -1.0
        for begin in range(0, len(order), BATCH):
            part = order[begin : begin + BATCH]
            part = np.sort(part[bounds[part] + EPSILON >= least])
            if not len(part):
                break
            numbers = (part[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()
            found = np.zeros(len(scores))
            found[numbers] = scores[numbers]
            self._add_rare(found, part, at, idf)
            numbers = numbers[found[numbers] > 0]
            docs, values = np.concatenate([docs, numbers]), np.concatenate([values, found[numbers]])
            keep = _order(values, self.known[docs], self.doc_ids[docs], k)
            docs, values = docs[keep], values[keep]
            if len(docs) == k:
                least = float(values.min())
        return docs, values

    def _add_rare(self, scores: np.ndarray, blocks: np.ndarray, at: np.ndarray, idf: np.ndarray) -> None:
        """Add the terms' weights in some blocks, found by their places in the sorted list of (term, document)."""
        wide = np.int64(self.n_blocks * BLOCK)
        if self._keys is None:
            self._keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), np.diff(self.begins)) * wide + self.docs
        low = (at[:, None] * wide + blocks[None, :] * BLOCK).ravel()
        places, owner = _spans(np.searchsorted(self._keys, low), np.searchsorted(self._keys, low + BLOCK))
        np.add.at(scores, self.docs[places], self.weights[places] * idf[owner // len(blocks)])

    def _kept(self, docs: np.ndarray, scores: np.ndarray, k: int):
        if len(docs) > 4 * k:  # all that may tie with the k-th
            least = np.partition(scores[docs], len(docs) - k)[len(docs) - k]
            docs = docs[scores[docs] >= least - EPSILON]
        keep = _order(scores[docs], self.known[docs], self.doc_ids[docs], k)
        return docs[keep], scores[docs][keep]


def _spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of several ranges, and the range each is from."""
    size = end - begin
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size), owner


def _order(scores: np.ndarray, known: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, ~known, -np.round(scores, DIGITS)))[:k]


def _query_terms(queries: DataFrame) -> DataFrame:
    """query_id and term of every distinct word of the queries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, offsets = texts_word_hashes(raw_texts(part["text"]))
                terms = [np.unique(found[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                owner = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
                yield pa.RecordBatch.from_arrays(
                    [part["query_id"].take(pa.array(owner)), pa.array(np.concatenate(terms).view(np.int64))], ["query_id", "term"]
                )

    rows = queries.where("query_id is not null").select(
        F.col("query_id").cast("long").alias("query_id"), F.col("text").cast("string").alias("text")
    )
    return working_table(rows.mapInArrow(run, "query_id long, term long").distinct(), "search-queries")


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, doc_id and score of the best k documents for each query (query_id, text)."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    sizes = docs.agg(F.count("*").alias("n"), F.sum(words).alias("words")).first()
    n_docs, mean_length = sizes["n"], max(1.0, (sizes["words"] or 0) / max(1, sizes["n"]))
    index = build_index(docs)
    asked = _query_terms(queries)
    n_blocks = max(1, -(-2 * asked.count() // QUERY_TERMS))
    found = None
    for number in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == number)
        part = _search_block(index, block, n_docs, mean_length, k)
        found = part if found is None else found.unionByName(part)
    answers = found.select("query_id", F.inline("answers")).withColumn("score", F.round("score", DIGITS))
    # a rank with a limit is cut to the limit before the shuffle as well
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, block: DataFrame, n_docs: int, mean_length: float, k: int) -> DataFrame:
    rows = block.toPandas().sort_values(["query_id", "term"])
    ids = rows["query_id"].tolist()
    parts = rows["term"].to_numpy(dtype=np.int64).view(np.uint64)
    cuts = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
    queries = [(int(ids[a]), np.sort(parts[a:b])) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
    terms = np.unique(np.concatenate([t for _, t in queries])) if queries else np.zeros(0, dtype=np.uint64)
    spark = index.sparkSession
    wanted = spark.sparkContext.broadcast(terms)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, copies = np.frombuffer(row["terms"], dtype="<u8"), np.frombuffer(row["copies"], dtype="<u4")
                at = np.flatnonzero(np.isin(own, wanted.value, assume_unique=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(wanted.value, own[at])), pa.array(copies[at].astype(np.int64))], ["place", "copies"]
                )

    counted = index.select("terms", "copies").mapInArrow(count, "place long, copies long").groupBy("place").agg(F.sum("copies").alias("copies"))
    pairs = counted.toPandas()
    copies = np.zeros(len(terms))
    copies[pairs["place"].to_numpy(dtype=np.int64)] = pairs["copies"].to_numpy()
    idf = np.log1p((n_docs - copies + 0.5) / (copies + 0.5))
    placed = [(q, np.searchsorted(terms, own)) for q, own in queries]
    shared = spark.sparkContext.broadcast((terms, idf, placed))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_terms, all_idf, asked = shared.value
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("score", pa.float64())]))
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # the best k of the task's shards so far
        for batch in batches:
            for number in range(batch.num_rows):
                shard = Shard(batch.slice(number, 1).to_pylist()[0], mean_length)
                there = shard.places(all_terms)
                given = [(there[own], all_idf[own]) for _, own in asked]
                for (query_id, _), (docs, scores) in zip(asked, shard.top(given, k), strict=True):
                    if not len(docs):
                        continue
                    found = (scores, shard.known[docs], shard.doc_ids[docs])
                    if query_id in best:
                        found = tuple(np.concatenate(pair) for pair in zip(best[query_id], found, strict=True))
                        keep = _order(*found, k)
                        found = tuple(x[keep] for x in found)
                    best[query_id] = found
        answers = [
            [
                {"doc_id": d if known else None, "score": score}
                for score, known, d in zip(scores.tolist(), known_.tolist(), ids.tolist(), strict=True)
            ]
            for scores, known_, ids in best.values()
        ]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(answers, kind)], ["query_id", "answers"])

    return index.mapInArrow(run, "query_id long, answers array<struct<doc_id:long,score:double>>")
