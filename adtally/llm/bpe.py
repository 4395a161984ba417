"""Byte-level BPE: encoding by a minimal perfect hash and a heap, and decoding.

A text is split by the vocabulary's pattern. Each pre-token that is itself a token is found by a
minimal perfect hash over the vocabulary (tier 1). Any other is a list of bytes, linked both ways,
whose best pair (lowest rank, then leftmost) is taken from a heap until no pair is a token (tier 2).

The pattern never matches across a single blank between two characters that are not white space,
except with that blank in front. So a text with only such blanks falls into chunks, and the ids of a
chunk do not depend on its neighbours. The chunks of a slice of texts are numbered by Arrow, the distinct ones are
encoded (a worker remembers those it has met), and the ids of all places are gathered by those numbers; decoding
gathers the bytes of all ids likewise. Other texts are split by the pattern as a whole.

Nulls and edge cases: a null text is empty; an empty text has no ids and decodes to no bytes. Repeated
rows give repeated results, an empty table an empty one. Very long texts are encoded whole. Only the named columns are read, and the result
has columns of its own, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import cut, raw_texts, slices

#: Distinct chunks, and distinct pre-tokens, whose ids a worker remembers.
MEMO_CHUNKS = 150_000
MEMO_PIECES = 350_000
#: Fixed value: the first character behind the Latin letters.
LATIN_END = "\u0250"
#: Bytes of a chunk.
NOT_BLANK = np.arange(256) != 32


class PerfectHash:
    """A minimal perfect hash over byte strings: each key has a slot of its own below len(keys).

    Keys are dealt into buckets. From the largest on, each bucket gets the first displacement that
    sends its keys to free slots; a bucket of one key names its slot itself, as -1 - slot.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 2):
        self.size = len(keys)
        self.buckets = max(1, self.size // per_bucket)
        self.shift = np.zeros(self.buckets, dtype=np.int64).tolist()
        self.keys: list[bytes] = [b""] * self.size
        dealt: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
        for number, h in enumerate(hashes):
            dealt.setdefault(h % self.buckets, []).append(number)
        free = np.ones(self.size, dtype=bool)
        slot_of = [0] * self.size
        singles = []
        for bucket, members in sorted(dealt.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                singles.append((bucket, members[0]))
                continue
            shift = 0
            while True:
                slots = [self._slot(hashes[m], shift) for m in members]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for member, slot in zip(members, slots, strict=True):
                slot_of[member], free[slot] = slot, False
        for (bucket, member), slot in zip(singles, np.flatnonzero(free).tolist(), strict=True):
            self.shift[bucket] = -1 - slot
            slot_of[member] = slot
        for number, slot in enumerate(slot_of):
            self.keys[slot] = keys[number]

    def _slot(self, h: int, shift: int) -> int:
        return ((h >> 32) + shift * ((h >> 11) | 1) + shift * shift) % self.size

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 if it is no key."""
        if not self.size:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        slot = -1 - shift if shift < 0 else self._slot(h, shift)
        return slot if self.keys[slot] == key else -1


class Vocabulary:
    """Tokens and ranks of a rank file, and what encoding and decoding need of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.pattern = pattern
        self.perfect = PerfectHash(sorted(ranks))
        self.rank_at = [ranks[key] for key in self.perfect.keys]
        self.tokens = {rank: key for key, rank in ranks.items()}
        self.bytes_ids = [ranks[bytes([b])] for b in range(256)]
        #: The rank of two joined tokens, by the left one's id, then the right one's.
        self.joined: list[dict[int, int]] = [{} for _ in range(max(ranks.values()) + 1)]
        for key, rank in ranks.items():
            for cut in range(1, len(key)):
                left, right = ranks.get(key[:cut]), ranks.get(key[cut:])
                if left is not None and right is not None:
                    self.joined[left][right] = rank
        #: The same for two bytes, by both.
        self.joined_bytes = [self.joined[a].get(b) for a in self.bytes_ids for b in self.bytes_ids]

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.decoder = Decoder(vocabulary.tokens)
        self.chunks: dict[bytes, bytes | None] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Tier 2: merge linked bytes, best pair first."""
        v, n = self.v, len(piece)
        joined, joined_bytes, bits = v.joined, v.joined_bytes, n.bit_length()
        place = (1 << bits) - 1
        ids = [v.bytes_ids[b] for b in piece]
        #: The rank of the pair that begins at a place now; what the heap holds of earlier pairs no longer counts.
        ranks = [joined_bytes[a << 8 | b] for a, b in zip(piece, piece[1:])]
        heap = [rank << bits | i for i, rank in enumerate(ranks) if rank is not None]
        heapify(heap)
        ranks.append(None)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            best = heappop(heap)
            rank, i = best >> bits, best & place
            if ranks[i] != rank:
                continue
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j], ranks[j] = rank, -1, None
            if k < n:
                before[k] = i
                ranks[i] = other = joined[rank].get(ids[k])
                if other is not None:
                    heappush(heap, other << bits | i)
            else:
                ranks[i] = None
            h = before[i]
            if h >= 0:
                ranks[h] = other = joined[ids[h]].get(rank)
                if other is not None:
                    heappush(heap, other << bits | h)
        return [x for x in ids if x >= 0]

    def piece(self, text: str) -> bytes:
        """Ids of a pre-token, as little-endian numbers of four bytes."""
        found = self.pieces.get(text)
        if found is None:
            data = text.encode()
            slot = self.v.perfect.slot(data)
            ids = [self.v.rank_at[slot]] if slot >= 0 else self.merge(data)
            found = packed(ids)
            if len(data) <= 64:
                if len(self.pieces) >= MEMO_PIECES:
                    self.pieces = {}
                self.pieces[text] = found
        return found

    def whole(self, text: bytes) -> bytes:
        """Ids of a text that is split by the pattern as a whole."""
        return b"".join(map(self.piece, self.find(text.decode())))

    def chunk(self, bare: bytes) -> bytes | None:
        """Ids of a blank and these characters; None if their pre-tokens can depend on what stands beside them."""
        text = bare.decode()
        if len(bare) > 64 or text[0].isspace() or text[-1].isspace():
            return None
        # letters alone are one pre-token; those of Latin script are so in every version of Unicode
        if max(text) < LATIN_END and text.isalpha():
            return self.piece(" " + text)
        return b"".join(map(self.piece, self.find(" " + text)))

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian numbers of four bytes."""
        chunks, counts = cut(texts, NOT_BLANK, between=b" ")
        if not len(chunks):
            return [self.whole(text) for text in texts]
        coded = chunks.dictionary_encode()
        distinct, number = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.chunks) + len(distinct) > MEMO_CHUNKS:
            self.chunks = {}
        known = self.chunks
        for bare in distinct:
            if bare not in known:
                known[bare] = self.chunk(bare)
        found = [known[bare] for bare in distinct]
        # texts with one blank between any two chunks, none at the ends, and no chunk that depends on others
        upto = np.concatenate([[0], np.cumsum(counts)])
        sizes = np.frombuffer(chunks.buffers()[1], np.int32)[: len(chunks) + 1].astype(np.int64)
        blanks = np.array([len(t) for t in texts]) - (sizes[upto[1:]] - sizes[upto[:-1]])
        bad = np.concatenate([[0], np.cumsum(np.array([x is None for x in found])[number])])
        plain = (counts > 0) & (blanks == counts - 1) & (bad[upto[1:]] == bad[upto[:-1]])
        table = Table([x or b"" for x in found], np.uint32)
        ends = np.concatenate([[0], np.cumsum(table.length[number])]) * 4
        ids = memoryview(table.gathered(number))
        out = []
        for i, text in enumerate(texts):
            if not plain[i]:
                out.append(self.whole(text))
                continue
            # a text's first chunk has no blank
            first, last = upto[i], upto[i + 1]
            head = self.whole(distinct[number[first]])
            out.append(head + ids[ends[first + 1] : ends[last]])
        return out


    def text(self, text: str) -> bytes:
        return self.texts([text.encode()])[0]


class Table:
    """Byte strings end to end, of which many are gathered at once, in the order of their numbers."""

    WINDOW = 1 << 17

    def __init__(self, values: list[bytes], kind: type = np.uint8):
        self.flat = np.frombuffer(b"".join(values), dtype=np.dtype(kind).newbyteorder("<"))
        self.length = np.array([len(x) for x in values], dtype=np.int64) // np.dtype(kind).itemsize
        self.start = np.cumsum(self.length) - self.length

    def gathered(self, numbers: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(numbers), self.WINDOW):
            part = numbers[at : at + self.WINDOW]
            length = self.length[part]
            ends = np.cumsum(length)
            places = np.repeat(self.start[part] - ends + length, length) + np.arange(ends[-1])
            out.append(self.flat[places].tobytes())
        return b"".join(out)


_HELD: list[Encoder] = []


def _encoder(shared) -> Encoder:
    """The worker's encoder for this broadcast; what it remembers lives as long as the broadcast does here."""
    vocabulary = shared.value
    if not _HELD or _HELD[0].v is not vocabulary:
        _HELD[:] = [Encoder(vocabulary)]
    return _HELD[0]


ENCODED = "doc_id long, ids binary"
DECODED = "doc_id long, ids binary, decoded binary"


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids of every text, ids as little-endian unsigned 32-bit numbers.

    The vocabulary is broadcast: its size is that of the rank file, whatever the data. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = coder.texts(raw_texts(part["text"]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, ENCODED)


class Decoder:
    def __init__(self, tokens: dict[int, bytes]):
        self.table = Table([tokens.get(i, b"") for i in range(max(tokens) + 1)])

    def texts(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that packed ids stand for; an unknown id raises KeyError."""
        every = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
        table = self.table
        if len(every):
            strange = every[(every >= len(table.length)) | (table.length[np.minimum(every, len(table.length) - 1)] == 0)]
            if len(strange):
                raise KeyError(int(strange[0]))
        ends = np.concatenate([[0], np.cumsum(table.length[every])])
        data = table.gathered(every)
        upto = np.cumsum([0] + [len(x) // 4 for x in ids])
        return [data[a:b] for a, b in zip(ends[upto[:-1]].tolist(), ends[upto[1:]].tolist())]


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The bytes that the ids stand for, beside them; an unknown id raises KeyError."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            for part in slices(batch, "ids"):
                texts = decoder.texts(raw_texts(part["ids"]))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["ids"], pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes, for each document; with_ids, the ids too."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(shared)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = coder.texts(raw_texts(part["text"]))
                texts = coder.decoder.texts(ids)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(ids, pa.binary()), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
                )

    # both ways in one worker: a second one beside it would hold its own copy of everything
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = rows.mapInArrow(run, DECODED)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *([F.col("ids")] if with_ids else []),
    )
