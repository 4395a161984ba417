"""Byte-level BPE and binary records against the libraries themselves."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import documents, edge, edge_rows, nothing, small  # noqa: F401

from adtally.llm import binary, bpe

SPEC = open(P.path("word_bpe_49k.json")).read()


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def plain():
    lines = map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(plain, text):
    ids = plain.encode_ordinary(text or "")
    packed = np.array(ids, dtype="<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_perfect_hash_is_minimal(vocabulary):
    perfect = vocabulary.perfect
    assert sorted(perfect.slot(k) for k in vocabulary.tokens.values()) == list(range(len(vocabulary.tokens)))
    assert perfect.slot(b"no token at all") == -1
    assert bpe.PerfectHash([]).slot(b"a") == -1


def test_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0}, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sa1 \x1c\x85")), max_size=60))
def test_encoding_equals_library(vocabulary, plain, text):
    assert np.frombuffer(bpe.Encoder(vocabulary).text(text), "<u4").tolist() == plain.encode_ordinary(text)


def test_bpe_edges(edge, edge_rows, nothing, vocabulary, plain):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(edge, vocabulary).collect())
    assert got == sorted((d or 0, *expected(plain, t)) for d, t, *_ in edge_rows)
    assert bpe.round_trip(nothing, vocabulary).collect() == []
    two = bpe.decode(bpe.encode(edge, vocabulary), vocabulary).collect()
    assert sorted(bytes(r.decoded) for r in two) == sorted((t or "").encode() for _, t, *_ in edge_rows)


def test_bpe_documents(documents, vocabulary, plain):
    got = {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(documents, vocabulary).collect()}
    assert got == {r.doc_id: expected(plain, r.text) for r in documents.collect()}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'st.~-A9́É")), max_size=60))
def test_word_encoder_equals_library(text):
    coder = binary.encoder(SPEC)
    ids = coder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text.encode()])[0], f"<u{coder.width}").tolist() == ids


def check_records(spark, docs, rows, root):
    binary.write_records(docs, root, SPEC, 1)
    got = binary.read_records(spark, root).orderBy("start").collect()
    library = Tokenizer.from_str(SPEC)
    library.encode_special_tokens = True
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, (doc_id, text) in zip(got, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_records_edges(spark, edge, edge_rows, nothing, tmp_path):
    check_records(spark, edge, [(d, t) for d, t, *_ in edge_rows], f"file://{tmp_path}/edge")
    check_records(spark, nothing, [], f"file://{tmp_path}/none")


def test_shuffled_read_and_damage(spark, documents, tmp_path):
    root = tmp_path / "records"
    check_records(spark, documents, [(r.doc_id, r.text) for r in documents.collect()], f"file://{root}")
    shard = sorted(root.glob("*.rec"))[0]
    index = np.fromfile(shard.with_suffix(".idx"), dtype=binary.ENTRY)
    with open(shard, "rb") as file:
        straight = [(d, ids.tolist()) for d, ids in binary.records(file)]
        for row in reversed(range(len(index))):
            doc_id, ids = binary.record_at(file, index, row)
            assert (doc_id, ids.tolist()) == straight[row] and len(ids) == index[row]["n_ids"]
    data = bytearray(shard.read_bytes())
    data[len(data) // 2] ^= 1
    shard.write_bytes(data)
    with pytest.raises(ValueError), open(shard, "rb") as file:
        list(binary.records(file))
    shard.write_bytes(data[:-3])
    with pytest.raises(Exception):
        binary.read_records(spark, f"file://{root}").collect()


def test_bpe_of_many_texts_at_once(vocabulary, plain):
    """Texts of a slice share their chunks; those with odd blanks are split as a whole beside them."""
    rng = random.Random(1)
    pieces = list(" \n\t'sa1\x1c\x85é日　ß.,-") + ["  ", " \n", "\r\n", "'ll", "don't", "  x", "word", " word", "x" * 70]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    got = bpe.Encoder(vocabulary).texts([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain.encode_ordinary(t) for t in texts]
    assert bpe.Decoder(vocabulary.tokens).texts(got) == [t.encode() for t in texts]
    with pytest.raises(KeyError):
        bpe.Decoder(vocabulary.tokens).texts([bpe.packed([1, 60_000])])
