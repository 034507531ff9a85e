"""What the operators of this package share: texts as bytes, words as codes, batches of bounded size.

Python workers get Arrow batches of thousands of rows. The helpers here cut
them into slices of some megabytes of text, so that the memory of a worker does
not depend on how long the texts of a batch happen to be, and give memory back
between batches: Spark keeps its workers for later tasks of other operators.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SLICE_BYTES = 2 << 20

# Letters, digits and all bytes of characters beyond ASCII.
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[:128] = [chr(b).isalnum() for b in range(128)]

# Bytes that end a word: blank, tab, line feed, vertical tab, form feed, carriage return.
IS_WHITE = np.zeros(256, dtype=bool)
IS_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Lower-cases the letters A to Z and leaves all other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _give_back() -> None:
    """Return free memory to the system, where the C library knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The task, giving memory back after each batch and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one_by_one() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                _give_back()

        yield from task(one_by_one())
        _give_back()

    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def arrow_schema(schema: StructType | str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def unused_name(wanted: str, taken) -> str:
    """A column name that none of ``taken`` clashes with, upper and lower case alike."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of text each; one longer text is a slice alone."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    before = np.cumsum(lengths, dtype=np.int64) - lengths
    begins = np.flatnonzero(np.diff(before // limit, prepend=-1))
    for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
        yield batch.slice(begin, end - begin)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset of each text and the end); a null text is empty."""
    return bytes_of(pc.fill_null(texts, "").cast(pa.large_string()))


def bytes_of(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(joined bytes, offsets) of a large string or binary array without nulls."""
    if not len(pieces):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    buffer = pieces.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between consecutive offsets, without a copy."""
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )


@dataclass
class Words:
    """Words of some texts: maximal runs of bytes that are not white."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text the number of its first word, and the number of all words

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """For each word the text it stands in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """(code of each word, the distinct words as binary, in the order of their codes)."""
        if not len(self.starts):
            return np.empty(0, dtype=np.int64), pa.array([], pa.large_binary())
        # words and the gaps between them alternate; every second piece is a word
        bounds = np.empty(2 * len(self.starts), dtype=np.int64)
        bounds[0::2], bounds[1::2] = self.starts, self.ends
        pieces = binary_array(self.data, bounds).dictionary_encode()
        codes = pieces.indices.to_numpy(zero_copy_only=False)[0::2]
        used = np.zeros(len(pieces.dictionary), dtype=bool)
        used[codes] = True
        return (np.cumsum(used) - 1)[codes], pieces.dictionary.filter(pa.array(used))


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of texts given as bytes; no word crosses from one text into the next."""
    return _runs(data, offsets, ~IS_WHITE[data])


def letter_words(texts: pa.Array) -> Words:
    """Lower-case words of letters and digits; all other ASCII characters part words."""
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    return _runs(data, offsets, _IN_WORD[data])


def cased_words(texts: pa.Array) -> Words:
    """Words of letters and digits as they are written, so that their places are those of the text."""
    data, offsets = text_bytes(texts)
    return _runs(data, offsets, _IN_WORD[data])


def word_hashes(words: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash for each word; equal words have equal ones, with ``lower`` whatever their case."""
    codes, distinct = words.coded()
    if lower:
        distinct = pc.utf8_lower(distinct.cast(pa.large_string())).cast(pa.large_binary())
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))[codes]


def _runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    if len(data):
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(data)]] = False
        after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def ragged(lengths: np.ndarray, values: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """``values`` holds runs of ``lengths``; the runs named by ``picks``, one after the other."""
    begins = np.cumsum(lengths) - lengths
    wanted = lengths[picks]
    total = int(wanted.sum())
    shift = np.repeat(begins[picks] - (np.cumsum(wanted) - wanted), wanted)
    return values[np.arange(total) + shift]


def pack(numbers: np.ndarray) -> bytes:
    """Numbers of 64 bits as byte planes, compressed: the high bytes of small ones take no room."""
    return pa.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, size: int) -> np.ndarray:
    """``size`` packed numbers as 64-bit integers."""
    planes = np.frombuffer(pa.decompress(packed, 8 * size, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()
