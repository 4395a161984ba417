"""Token ids as files of length-delimited binary records, with an offset index beside each.

A shard file is a run of records:

    length   u64   bytes of the payload
    check    u32   masked checksum of the eight length bytes
    payload        u8 width of an id (2 or 4), u8 1 if the document has an id, i64 doc_id, the ids
    check    u32   masked checksum of the payload

All numbers are little-endian. The checksum is CRC-32, masked by a rotation and a constant so
that a checksum stored among the data it covers does not weaken it. The index file has 16 bytes
for each record, its offset and its number of ids, so a reader can fetch records in any order.

Each shard holds a range of doc_id in ascending order and shard numbers ascend with it. A shard
is written under a name of its attempt and renamed when whole: a task that is run again, or twice
at a time, replaces the file by an equal one.

Nulls and edge cases: a null text is empty and gives a record with the end id alone; a null
doc_id is kept, first in order. Repeated rows give repeated records; rows of one doc_id are
ordered by their text. A very long text is one record. An empty table writes no shard. Other columns are not read. Whether the
string of an added token in a text is one id or text is the caller's choice (`added`).
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtally.llm.common import raw_texts, slices

LENGTH = struct.Struct("<QI")
CHECK = struct.Struct("<I")
HEAD = struct.Struct("<BBq")
ENTRY = np.dtype([("offset", "<u8"), ("n_ids", "<u8")])

#: Parts the pieces of a text that is encoded.
MARK = b"~"
#: Letters below are letters in every version of Unicode that a library may use.
LATIN_END = "\u0250"

#: Distinct pieces whose ids a worker remembers, some 130 bytes each.
MEMO_PIECES = 900_000


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = HEAD.pack(width, doc_id is not None, doc_id or 0) + ids
    size = len(payload).to_bytes(8, "little")
    return size + CHECK.pack(masked(size)) + payload + CHECK.pack(masked(payload))


def records(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each record; ValueError on a damaged or truncated file."""
    while head := stream.read(LENGTH.size):
        if len(head) < LENGTH.size:
            raise ValueError("truncated record")
        size, check = LENGTH.unpack(head)
        if masked(head[:8]) != check:
            raise ValueError("damaged length")
        payload = stream.read(size)
        tail = stream.read(CHECK.size)
        if len(payload) < size or len(tail) < CHECK.size:
            raise ValueError("truncated record")
        if masked(payload) != CHECK.unpack(tail)[0]:
            raise ValueError("damaged payload")
        width, known, doc_id = HEAD.unpack_from(payload)
        ids = np.frombuffer(payload, dtype=f"<u{width}", offset=HEAD.size)
        yield (doc_id if known else None), ids


def record_at(stream, index: np.ndarray, row: int) -> tuple[int | None, np.ndarray]:
    """One record by its place in the index: what a shuffled read does."""
    stream.seek(int(index[row]["offset"]))
    return next(records(stream))


# --- encoding with the tokenizers library -------------------------------------------------

_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


class WordEncoder:
    """Ids of texts by a tokenizer whose tokens never cross ASCII white space, nor a letter's end.

    That holds for a tokenizer that lowers letters, drops white space before the merges and splits
    runs of letters from runs of signs. So A-Z may be lowered and a blank put between an ASCII
    letter and a sign first; the library then encodes each distinct piece once, and a text is the
    concatenation. Pieces of letters alone need no splitting by pattern and take a copy of the
    tokenizer without that step. The constructor refuses a tokenizer that fails on a probe.

    With `added` the string of an added token in a text is one id, as the library reads it unless
    told otherwise; the library looks for it in the text as given, so the text is parted there
    first. Without, it is text like any other.
    """

    PROBE = "Don't stop!! a.b, x-1 (Über) No. 5%% it's 'tis #tag*** end."

    def __init__(self, spec: str, added: bool = False, memo_pieces: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(spec)
        tokens = self.library.get_added_tokens_decoder() if added else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip or not t.special for t in tokens.values()):
            raise ValueError("this tokenizer's added tokens are not found by their strings alone")
        probe = self.PROBE + "".join(f"{t.content}A {t.content.upper()}b{t.content}" for t in tokens.values())
        self.library.encode_special_tokens = not added
        whole = self.library.encode(probe, add_special_tokens=False).ids
        # From here on the library sees pieces between added tokens; lowering may have made one look like a token.
        self.library.encode_special_tokens = True
        self.letters = Tokenizer.from_str(spec)
        self.letters.encode_special_tokens = True
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.memo: dict[bytes, bytes] = {}
        self.memo_pieces = memo_pieces
        (self.mark,) = self.library.encode(MARK.decode(), add_special_tokens=False).ids
        self.added = {t.content.encode(): self.pack([i]) for i, t in tokens.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None
        if self.pack(whole) != self.encode([probe.encode()])[0]:
            raise ValueError("this tokenizer's ids of a text are not those of its pieces")

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def learn(self, pieces: list[bytes]) -> None:
        """Encode pieces a thousand to a text, parted by a mark that none of them contains."""
        letters, others = [], []
        for piece in pieces:
            text = piece.decode()
            if text.isalpha() and text.lower().isalpha() and max(text) < LATIN_END:
                letters.append(text)
            elif MARK in piece:
                self.memo[piece] = self.pack(self.library.encode(text, add_special_tokens=False).ids)
            else:
                others.append(text)
        parted = f" {MARK.decode()} "
        for library, texts in ((self.letters, letters), (self.library, others)):
            for at in range(0, len(texts), 20_000):
                part = texts[at : at + 20_000]
                groups = [part[k : k + 1000] for k in range(0, len(part), 1000)]
                found = library.encode_batch_fast([parted.join(g) for g in groups], add_special_tokens=False)
                for group, encoding in zip(groups, found, strict=True):
                    ids = np.array(encoding.ids, dtype=f"<u{self.width}")
                    ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
                    if len(ends) != len(group):
                        raise ValueError("this tokenizer's tokens cross white space")
                    data, begin = ids.tobytes(), 0
                    for text, end in zip(group, (ends * self.width).tolist(), strict=True):
                        self.memo[text.encode()] = data[begin:end]
                        begin = end + self.width

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.cut is None:
            return self._ordinary(texts)
        parted = [self.cut.split(text) for text in texts]  # text, token, text, token, ..., text
        between = iter(self._ordinary([text for parts in parted for text in parts[::2]]))
        return [b"".join(self.added[x] if k % 2 else next(between) for k, x in enumerate(parts)) for parts in parted]

    def _ordinary(self, texts: list[bytes]) -> list[bytes]:
        split = [pieces(text) for text in texts]
        unseen = set().union(*split) if split else set()
        fresh = [p for p in unseen if p not in self.memo]
        if len(self.memo) + len(fresh) > self.memo_pieces:
            self.memo, fresh = {}, list(unseen)
        self.learn(fresh)
        get = self.memo.__getitem__
        return [b"".join(map(get, found)) for found in split]


_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def pieces(text: bytes) -> list[bytes]:
    """Lowered pieces of a text, parted at ASCII white space and between a letter and a sign."""
    text = text.lower()
    data = np.frombuffer(text, dtype=np.uint8)
    gaps = np.flatnonzero(_LETTER[data[:-1]] & _SIGN[data[1:]]) + 1
    return (np.insert(data, gaps, 32).tobytes() if len(gaps) else text).split()


def encoder(spec: str, added: bool = False) -> WordEncoder:
    """The worker's encoder of this tokenizer; its memo lives as long as the worker."""
    key = spec, added
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(spec, added)
    return _ENCODERS[key]


# --- writing and reading ------------------------------------------------------------------


def qualified(spark: SparkSession, root: str) -> str:
    """The root with the scheme that Spark gives it: a bare path lies on the default file system, not on this machine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()
    return f"file://{whole[5:]}" if whole.startswith("file:/") and not whole.startswith("file://") else whole


def _open_root(root: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system and path of a qualified root."""
    return fs.FileSystem.from_uri(root)


SHARDS = "shard int, records long, ids long, bytes long"


def write_records(
    docs: DataFrame, root: str, spec: str, end_id: int, text: str = "text", doc_id: str = "doc_id", added: bool = False
) -> DataFrame:
    """Encode and write all documents below root, a folder that driver and executors share.

    With `added` the string of an added token (<|endoftext|>, say) is one id, the library's default.
    Returns the manifest, one row for each shard, itself written as root/manifest. The text is
    shuffled once, by ranges of doc_id; ids are made after the shuffle, so they never cross it.
    """
    spark = docs.sparkSession
    spread = spark.sparkContext.broadcast(spec)
    root = qualified(spark, root)
    system, path = _open_root(root)
    system.create_dir(path, recursive=True)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(spread.value, added)
        system, folder = _open_root(root)
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}"
        attempt = uuid.uuid4().hex
        end = coder.pack([end_id])
        n = ids = offset = 0
        stream = index = None
        for batch in batches:
            for part in slices(batch, "text"):
                if stream is None:
                    stream = system.open_output_stream(f"{name}.rec.{attempt}")
                    index = system.open_output_stream(f"{name}.idx.{attempt}")
                entries = np.zeros(part.num_rows, dtype=ENTRY)
                encoded = coder.encode(raw_texts(part["text"]))
                for row, (key, data) in enumerate(zip(part["doc_id"].to_pylist(), encoded, strict=True)):
                    record = frame(key, data + end, coder.width)
                    entries[row] = (offset, len(data) // coder.width + 1)
                    stream.write(record)
                    offset += len(record)
                index.write(entries.tobytes())
                n += part.num_rows
                ids += int(entries["n_ids"].sum())
        if stream is not None:
            stream.close()
            index.close()
            for kind in ("rec", "idx"):
                system.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "records": pa.array([n], pa.int64()),
                    "ids": pa.array([ids], pa.int64()),
                    "bytes": pa.array([offset], pa.int64()),
                }
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(write, SHARDS).write.parquet(f"{root}/manifest")
    return spark.read.schema(SHARDS).parquet(f"{root}/manifest")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, read back from the files.

    One task reads one shard as a stream. `start` is the shard's first place, a running sum over
    the manifest (one row for each file, so a few numbers for 128 MB of ids), plus the records
    before it in the shard.
    """
    root = qualified(spark, root)
    manifest = spark.read.schema(SHARDS).parquet(f"{root}/manifest")
    n_shards = manifest.count()
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open_root(root)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{folder}/shard-{row['shard']:06d}"
                place, out, n = row["first"], [], 0
                with system.open_input_stream(f"{name}.rec") as stream:
                    for doc_id, ids in records(stream):
                        out.append((doc_id, place, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        place += len(ids)
                        n += 1
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                if n != row["records"] or place - row["first"] != row["ids"]:
                    raise ValueError(f"shard {row['shard']} is not whole")
                yield _rows(out)

    return placed.repartition(max(1, n_shards), "shard").mapInArrow(read, READ)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
    return pa.RecordBatch.from_pydict(
        {name: pa.array(list(c), pa.int64()) for name, c in zip(("doc_id", "start", "n_tokens", "ids_crc32"), columns, strict=True)}
    )
