"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is trained in numpy from confirmed toxic documents (P) and documents whose label is not
looked at (U). With the prior p of toxic documents, the risk of a scorer f under the logistic loss is

    p * E_P[loss(f, +1)] + max(0, E_U[loss(f, -1)] - p * E_P[loss(f, -1)])

The second part is the risk on documents that are not toxic, corrected for the toxic ones among U. It can't
be negative in truth, so where the estimate is, a step goes against it instead of fitting it.

A document's features are scaled to length 1. They are words and, of longer words, the first 4, 5 and 6 bytes (stems), with A-Z lowered
and signs as blanks. All that tell P from U are the classifier's; which do is counted over the whole training fold. labels, lang, source and doc_id are never features; a document is used
for learning only if crc32(doc_id as text) mod 3 is not 1.

What is bounded: weights are learned from samples of P and U of at most MAX_POSITIVE and MAX_UNLABELLED training
documents, chosen by a hash of doc_id; the driver holds the places of their features only. A feature that none of
them has keeps the weight 0. All documents are scored, each as a whole.

Nulls and edge cases: a null or empty text has no features and gets the score of the constant alone. A null
doc_id counts as the empty text in the fold rule. Labels without a value are no labels; of several labels of a
document the highest counts. Without confirmed toxic documents every score is 0. Repeated rows get equal
scores; very long texts are read whole; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import first_bytes, mix, raw_texts, slices, texts_word_hashes, working_table

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 20_000
#: Bytes of a word that make a feature, besides the whole word.
STEMS = (4, 5, 6)
#: A feature's documents in P must be so many standard deviations above what U makes expect, five at least.
MIN_DEVIATIONS = 8.0
#: Its least evidence, as a log ratio, and as a part of the most that the prior allows.
MIN_EVIDENCE = 1.5
MIN_EVIDENCE_PART = 0.65
#: The prior is taken so many standard errors high: the non-negative risk guards against a high one only.
PRIOR_ERRORS = 3.0
THRESHOLD = 0.7
#: How far below 0 the estimate of the negative risk may go before a step is turned.
SLACK = 0.02

_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all features of all texts, and the text each is from."""
    clean = [t.translate(_BLANK) for t in texts]
    words, offsets = texts_word_hashes(clean)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    stems, stem_owner = [words], [owner]
    for size in STEMS:
        found, longer = first_bytes(clean, size)
        stems.append(mix(found + np.uint64(size)))
        stem_owner.append(owner[longer])
    return np.concatenate(stems), np.concatenate(stem_owner)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


class Classifier:
    """Weights by feature hash, and a constant."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, constant: float):
        order = np.argsort(hashes)
        self.hashes, self.weights, self.constant = hashes[order], weights[order], constant
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def columns(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs that occur, each once."""
        found, owner = features(texts)
        close = self.maybe[(found & np.uint64(0xFFFF)).astype(np.int64)]
        found, owner = found[close], owner[close]
        if not len(self.hashes) or not len(found):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        same = self.hashes[at] == found
        pairs = np.unique(owner[same] * len(self.hashes) + at[same])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant == -np.inf:
            return np.zeros(len(texts))
        row, column = self.columns(texts)
        length = np.sqrt(np.maximum(1, np.bincount(row, minlength=len(texts))))
        z = np.bincount(row, weights=self.weights[column], minlength=len(texts)) / length + self.constant
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def nnpu_gradient(w: np.ndarray, b: float, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """The step direction of the non-negative risk estimate."""
    zp, zu = positive @ w + b, unlabelled @ w + b
    sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
    negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    if negative_risk >= -SLACK:
        at_p, at_u = prior * ((sp - 1) - sp) / len(zp), su / len(zu)
    else:
        at_p, at_u = prior * sp / len(zp), -su / len(zu)
    return positive.T @ at_p + unlabelled.T @ at_u, float(at_p.sum() + at_u.sum())


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 40, batch: int = 1000, rate: float = 0.05, decay: float = 1e-5, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and constant by Adam over minibatches; the same for the same rows."""
    draw = np.random.default_rng(seed)
    n = positive.shape[1]
    w, b = np.zeros(n, dtype=np.float32), float(np.log(prior / (1 - prior)))
    first, second, step = np.zeros(n + 1), np.zeros(n + 1), 0
    parts = max(1, len(unlabelled) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(unlabelled))
        for k in range(parts):
            some = positive if len(positive) <= batch else positive[draw.choice(len(positive), batch, replace=False)]
            gw, gb = nnpu_gradient(w, b, some, unlabelled[order[k::parts]], prior)
            g = np.append(gw + decay * w, gb)
            step += 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            w, b = (w - move[:-1]).astype(np.float32), b - float(move[-1])
    return w.astype(np.float64), b


class Rows:
    """Rows of a matrix by the places of their features, each row of length 1."""

    def __init__(self, places: np.ndarray, sizes: np.ndarray, n: int):
        self.places, self.sizes, self.shape = places, sizes, (len(sizes), n)
        self.begins = np.concatenate([[0], np.cumsum(sizes)])
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.values = np.repeat(1 / np.sqrt(np.maximum(1, sizes)), sizes)

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, rows: np.ndarray) -> Rows:
        sizes = self.sizes[rows]
        at = np.arange(sizes.sum()) + np.repeat(self.begins[rows] - np.cumsum(sizes) + sizes, sizes)
        return Rows(self.places[at], sizes, self.shape[1])

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=self.values * w[self.places], minlength=len(self))

    @property
    def T(self) -> Turned:
        return Turned(self)


class Turned:
    def __init__(self, rows: Rows):
        self.rows = rows

    def __matmul__(self, x: np.ndarray) -> np.ndarray:
        rows = self.rows
        return np.bincount(rows.places, weights=rows.values * x[rows.owner], minlength=rows.shape[1])


def _selected(positive: DataFrame, unlabelled: DataFrame, n_positive: int, n_unlabelled: int, prior: float) -> np.ndarray:
    """Hashes of the features with strong evidence for P against U, given as their texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, owner = features(raw_texts(part["text"]))
                order = np.lexsort((owner, found))
                found, owner = found[order], owner[order]
                new = np.ones(len(found), dtype=bool)
                new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                found, owner = found[new], owner[new]
                columns = [part[c].to_numpy(zero_copy_only=False)[owner].astype(np.int64) for c in ("p", "u")]
                keys, begin = np.unique(found, return_index=True)
                if len(keys):
                    sums = [np.add.reduceat(c, begin) for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], ["feature", "p", "u"])

    flags = [(positive, 1, 0), (unlabelled, 0, 1)]
    marked, others = (texts.select("text", F.lit(p).alias("p"), F.lit(u).alias("u")) for texts, p, u in flags)
    counted = marked.unionByName(others).mapInArrow(count, "feature long, p long, u long")
    both = counted.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    evidence = F.log((F.col("p") + 0.5) / (n_positive + 1)) - F.log((F.col("u") + 0.5) / (n_unlabelled + 1))
    expected = (F.col("u") + 0.5) * (n_positive / max(1, n_unlabelled))
    deviations = (F.col("p") - expected) / F.sqrt(expected)
    least = min(MIN_EVIDENCE, MIN_EVIDENCE_PART * float(np.log(1 / prior)))
    strong = both.where((F.col("p") >= 5) & (deviations >= MIN_DEVIATIONS) & (evidence > least))
    return strong.select("feature").toPandas()["feature"].to_numpy(dtype=np.int64).view(np.uint64)


def learn(docs: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from the training fold of docs (doc_id, text) and labels (doc_id, toxic)."""
    marks = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(~held_out(F.col("doc_id")))
    ids = rows.select("doc_id").join(marks, F.col("doc_id") == F.col("__id"), "left")
    counts = ids.agg(F.count("*").alias("all"), F.count("toxic").alias("labelled"), F.sum("toxic").alias("toxic")).first()
    n_toxic = counts["toxic"] or 0
    if not n_toxic:
        return Classifier(np.zeros(0, dtype=np.uint64), np.zeros(0), -np.inf)
    share = n_toxic / counts["labelled"]
    prior = min(0.5, share + PRIOR_ERRORS * float(np.sqrt(share * (1 - share) / counts["labelled"])))

    def part(bound: int, n: int, seed: int) -> Column:
        rate = min(1.0, bound / n)
        return F.lit(True) if rate == 1.0 else F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int(rate * (1 << 30))

    confirmed = F.coalesce(F.col("toxic") == 1, F.lit(False))
    chosen = (
        ids.withColumns({"toxic": confirmed, "p": confirmed & part(MAX_POSITIVE, n_toxic, 1), "u": part(MAX_UNLABELLED, counts["all"], 2)})
        .where("toxic or u")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(*[F.max(c).alias(c) for c in ("toxic", "p", "u")])
    )
    known = working_table(
        rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("__id"))).select("text", "toxic", "p", "u"), "toxicity-sample"
    )
    hashes = _selected(known.where("toxic"), rows, n_toxic, counts["all"], prior)
    sample = known.where("p or u").select("text", "p", "u")
    blank = Classifier(hashes, np.zeros(len(hashes)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(blank)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                row, column = shared.value.columns(raw_texts(some["text"]))
                lists = np.split(column.astype("<u4"), np.searchsorted(row, np.arange(1, some.num_rows)))
                yield pa.RecordBatch.from_arrays([some["p"], some["u"], pa.array([x.tobytes() for x in lists], pa.binary())], ["p", "u", "columns"])

    found = sample.mapInArrow(encode, "p boolean, u boolean, columns binary").toPandas()
    found = found.sort_values(["p", "u", "columns"], kind="stable")  # the same order in each run

    def matrix(lists) -> Rows:
        return Rows(np.frombuffer(b"".join(lists), dtype="<u4"), np.array([len(x) // 4 for x in lists], dtype=np.int64), len(hashes))

    positive, unlabelled = matrix(found["columns"][found["p"]]), matrix(found["columns"][found["u"]])
    weights, constant = train(positive, unlabelled, prior)
    return Classifier(blank.hashes, weights, constant)


SCORED = "doc_id long, score double"


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                scores = shared.value.score(raw_texts(part["text"]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCORED).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
