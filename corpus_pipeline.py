"""From raw documents to token ids: rules, line dedup, near duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared
folder and read again as the next stage's docs. All but the last return the columns of documents.

Nulls and edge cases are those of the operators. A null or empty text, having less than 50 words, goes in the first
stage; very long texts pass whole; repeated rows are one document from the third stage on; an empty table stays empty.
Other columns, whatever their names, come through all stages but the last, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import bpe, linedup, mixing, ngram_join, rules
from adtally.llm.common import table, working_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned rule rejects go."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later places of repeated runs of lines go; n_chars follows the text."""
    out = linedup.dedup(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, and digests of ids and decoded text."""
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(docs, vocabulary, with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_duplicates),
    ("mixing sources", mix),
    ("byte-level bpe", encode),
]

#: Learned rules, flights and merges are no SQL; the tests compare with plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = working_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
