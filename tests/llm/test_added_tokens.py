"""Strings of added tokens in a text, against the tokenizers library as it comes."""

import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adtally.llm import binary, queries

SPEC = open(P.path("word_bpe_49k.json")).read()
LIBRARY = Tokenizer.from_str(SPEC)
PARTS = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "text|>", "<|", "end", "A", "e", "\u0301", " ", "~", ".", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_added_tokens_equal_library(text):
    coder = binary.encoder(SPEC, True)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text.encode()])[0], f"<u{coder.width}").tolist() == ids


def test_query_reads_added_tokens(spark, tmp_path):
    texts = ["plain", "end of file <|endoftext|> next", "<|startoftext|>a<|endoftext|>", None, "<|ENDOFTEXT|> after"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_binary_records(spark, str(tmp_path)).orderBy("start").collect()
    start = 0
    for r, (doc_id, text) in zip(got, enumerate(texts), strict=True):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, queries.END_ID]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), crc)
        start += len(ids)
