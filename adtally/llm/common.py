"""Helpers the operators share: tables, working tables, slicing of Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import working_dir

#: A word everywhere in this subpackage: a run of other characters than these six.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: A word and the white space behind it.
_WORD_AND_SPACE = WORD + r"[\x20\x09-\x0D]*"

#: Text bytes that a Python task holds expanded at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark removes a query's shuffle files at its end, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def working_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends here, any executor may be lost."""
    spark = df.sparkSession
    path, before = working_dir(spark, name), spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.working_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete working tables; what was made of them must be written by now."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.working_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def own_names(docs: DataFrame, used: tuple[str, ...], run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """run(docs), with the columns but those ``used`` under names that nothing else has; they get theirs back after it."""
    names = {c: f"_given{i}" for i, c in enumerate(docs.columns) if c not in used}
    back = {n: c for c, n in names.items()}
    out = run(docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns]))
    return out.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in out.columns])


def count_words(text: Column) -> Column:
    """Words of a text; null has none.

    regexp_count makes an array of all words first, many times the text's size. Here each word becomes one character;
    the word put before the text takes the text's leading white space with it.
    """
    marks = F.regexp_replace(F.concat(F.lit(". "), text), F.lit(_WORD_AND_SPACE), F.lit("."))
    return F.coalesce(F.length(marks) - 1, F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for the row.

    The planner copies a column's expression to where it is used, also into a lambda, where it would be computed
    again for each element. A lambda's own variable stays a variable.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the text of a part stays near the limit; a longer row is a part of its own."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    small = pa.types.is_string(column.type) or pa.types.is_binary(column.type)
    return [x or b"" for x in column.cast(pa.binary() if small else pa.large_binary()).to_pylist()]


_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEGMENT = 2 << 20
_PAD = 8
#: Masks that keep the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


#: Bytes of a word's characters.
IN_WORD = ~_SEPARATOR


def cut(
    texts: list[bytes], inside: np.ndarray, fold: np.ndarray | None = None, between: bytes = b"\n"
) -> tuple[pa.Array, np.ndarray]:
    """All runs of bytes marked ``inside``, of all texts in order, and how many each text has; bytes go through ``fold``.

    The byte ``between`` parts the texts, so it must not be marked.
    """
    data = np.frombuffer(between.join(texts) + between, dtype=np.uint8)
    mark = np.zeros(len(data) + 1, dtype=np.int8)
    mark[1:] = inside[data]
    step = np.diff(mark)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = data[mark[1:].view(bool)]
    letters = np.ascontiguousarray(letters if fold is None else fold[letters])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]), counts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads each bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~_SEPARATOR[data]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each word eight bytes at a time; data is padded by eight bytes."""
    at = np.ndarray(shape=(len(data) - _PAD + 1,), dtype="<u8", buffer=data.data, strides=(1,))
    size = ends - starts
    state = mix(size.astype(np.uint64) * _STEP)
    open_ = np.arange(len(starts))
    done = 0
    while len(open_):
        left = size[open_] - done
        part = at[starts[open_] + done] & _FIRST[np.minimum(left, 8)]
        state[open_] = mix((state[open_] ^ part) * _STEP + _STEP)
        done += 8
        open_ = open_[left > 8]
    return state


def texts_word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts in order, A-Z lowered first, and where each text's words begin.

    Long texts are taken in pieces cut at white space, so the expanded arrays stay small.
    """
    found, counts, group, held = [], [], [], 0

    def flush() -> None:
        nonlocal group, held
        if group:
            data = np.frombuffer(b"\n".join(group) + bytes(_PAD), dtype=np.uint8)
            if lower:
                data = _LOWER[data]
            starts, ends = word_bounds(data[:-_PAD])
            found.append(_hashes(np.ascontiguousarray(data), starts, ends))
            text_ends = np.cumsum([len(t) + 1 for t in group])
            counts.append(np.diff(np.searchsorted(starts, text_ends), prepend=0))
            group, held = [], 0

    owners: list[int] = []
    for number, text in enumerate(texts):
        at = 0
        while True:
            end = _cut(text, at)
            if held + end - at > _SEGMENT:
                flush()
            group.append(text[at:end] if at or end < len(text) else text)
            owners.append(number)
            held += end - at
            at = end
            if at >= len(text):
                break
    flush()
    per_text = np.bincount(owners, weights=np.concatenate(counts), minlength=len(texts)) if counts else np.zeros(0)
    offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)), offsets


def _cut(text: bytes, at: int) -> int:
    """The end of the piece that begins here: just after white space, or the end of the text."""
    end = at + _SEGMENT
    if end >= len(text):
        return len(text)
    last = max(text.rfind(bytes([c]), at, end) for c in SPACES)
    if last >= at:
        return last + 1
    first = min((x for c in SPACES if (x := text.find(bytes([c]), end)) >= 0), default=len(text) - 1)
    return first + 1


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    return texts_word_hashes([text], lower)[0]


def first_bytes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first bytes (8 at most), A-Z lowered, of each longer word, and which words are longer."""
    found, longer = [], []
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) <= _SEGMENT):
            held += len(texts[end]) + 1
            end += 1
        data = _LOWER[np.frombuffer(b"\n".join(texts[at:end]) + bytes(_PAD), dtype=np.uint8)]
        starts, ends = word_bounds(data[:-_PAD])
        long_enough = ends - starts > size
        numbers = np.ndarray(shape=(len(data) - _PAD + 1,), dtype="<u8", buffer=data.data, strides=(1,))
        found.append(numbers[starts[long_enough]] & _FIRST[size])
        longer.append(long_enough)
        at = end
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    return np.concatenate(found), np.concatenate(longer)
