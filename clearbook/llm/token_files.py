"""Token ids as Parquet list columns, laid out for selective reads.

Documents are dealt by ranges of their id and sorted within each file, so a file
holds a run of consecutive documents. A row has small metadata columns beside the
list of ids. Row groups are bounded in bytes, and Parquet writes page indexes,
so a reader that asks for some documents, or for the metadata alone, fetches the
pages it needs and nothing else:

* ids are delta encoded or dictionary encoded, by choice, and compressed;
* id, shard and number of tokens are delta encoded (sorted or small numbers);
* ``shard`` is the number of the file's range: shards, and documents within one,
  are in ascending order.

A row also says how many ids stand before it in its shard. Its place in the
stream of all ids is that and the total of all shards before its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from clearbook.llm.common import LOWER, arrow_schema, binary_array, ragged, text_bytes, text_slices, tidy, unused_name

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 1 << 20

IDS, SIZE, SHARD, BEFORE = "ids", "n_tokens", "shard", "before"


# A text is cut into pieces wherever the tokenizer's own pattern cuts for certain: around white space, and between an
# ASCII letter and ASCII punctuation. An apostrophe may join letters, and other characters are left to the tokenizer.
_WHITE, _LETTER, _MARK, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _WHITE
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = _MARK
_CUTS = np.zeros(16, dtype=bool)
for _left in range(4):
    for _right in range(4):
        _CUTS[4 * _left + _right] = (_left == _WHITE) != (_right == _WHITE) or {_left, _right} == {_LETTER, _MARK}

# Words of small Latin letters are what the normaliser and the pattern leave as they are: the model alone encodes them.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")

CACHED_PIECES = 400_000  # that a Python worker remembers; the frequent ones come first, others are encoded again


def _byte_characters() -> list[str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (chr(256 + n) for n in range(256))
    return [chr(b) if b in shown else next(others) for b in range(256)]


def _special_strings(tokenizer: Tokenizer) -> re.Pattern[bytes] | None:
    """What finds the strings that the tokenizer takes for one token wherever they stand, as they are written."""
    tokens = tokenizer.get_added_tokens_decoder().values()
    if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in tokens):
        raise ValueError("Added tokens of this vocabulary depend on what stands around them.")
    strings = sorted((t.content for t in tokens), key=len, reverse=True)
    return re.compile(b"|".join(re.escape(s.encode()) for s in strings)) if strings else None


def _occurrences(special: re.Pattern[bytes] | None, data: np.ndarray, offsets: np.ndarray) -> tuple[list[int], list[int]]:
    """(begins, ends) of the special strings, from left to right; none crosses from one text into the next."""
    begins, ends = [], []
    raw, at = data.tobytes() if special else b"", 0
    while special and (found := special.search(raw, at)):
        begin, end = found.span()
        if offsets[np.searchsorted(offsets, begin, "right")] < end:
            at = begin + 1
        else:
            begins.append(begin)
            ends.append(end)
            at = end
    return begins, ends


class _Pieces:
    """The ids of the pieces that a worker has met; a remembered piece is encoded once."""

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = _special_strings(self.tokenizer)
        self.characters = _byte_characters()
        self.numbers: dict[bytes, int] = {}
        self.lengths = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int32)

    def _encoded(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """(number of ids of each piece, all ids)."""
        tokenize, characters = self.tokenizer.model.tokenize, self.characters
        lengths, ids = [], []
        for piece in pieces:
            text = piece.decode()
            if _PLAIN.fullmatch(text):
                own = [t.id for t in tokenize(text if len(text) == len(piece) else "".join([characters[b] for b in piece]))]
            else:
                own = self.tokenizer.encode(text, add_special_tokens=False).ids
            lengths.append(len(own))
            ids.extend(own)
        return lengths, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        raw, offsets = text_bytes(texts)
        begins, ends = _occurrences(self.special, raw, offsets)
        data = LOWER[raw]
        for begin, end in zip(begins, ends, strict=True):
            data[begin:end] = raw[begin:end]
        kinds = _CLASS[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data):
            cut[1:-1] = _CUTS[4 * kinds[:-1] + kinds[1:]]
            for begin, end in zip(begins, ends, strict=True):
                cut[begin + 1 : end] = False
                cut[[begin, end]] = True
            cut[offsets[offsets < len(data)]] = True
        bounds = np.append(np.flatnonzero(cut[:-1]), len(data))
        if len(bounds) < 2:
            return np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        filled = kinds[bounds[:-1]] != _WHITE
        coded = binary_array(data, bounds).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)[filled]
        used = np.unique(codes)
        pieces = coded.dictionary.take(pa.array(used)).to_pylist()
        known = self.numbers
        new = [p for p in pieces if p not in known]
        places = {p: len(known) + n for n, p in enumerate(new)}
        lengths, ids = self._encoded(new)
        all_lengths = np.concatenate([self.lengths, np.array(lengths, dtype=np.int64)])
        all_ids = np.concatenate([self.ids, np.array(ids, dtype=np.int32)])
        number = np.zeros(len(coded.dictionary), dtype=np.int64)
        number[used] = [known[p] if p in known else places[p] for p in pieces]
        if len(known) + len(new) <= CACHED_PIECES:
            known.update(places)
            self.lengths, self.ids = all_lengths, all_ids
        picks = number[codes]
        ends = np.concatenate([[0], np.cumsum(all_lengths[picks])])
        return ragged(all_lengths, all_ids, picks), np.diff(ends[np.searchsorted(bounds[:-1][filled], offsets)])


_REMEMBERED: dict[str, _Pieces] = {}  # of this Python worker, by vocabulary


def _pieces_of(vocabulary: str) -> _Pieces:
    key = xxhash.xxh64_hexdigest(vocabulary.encode())
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = _Pieces(vocabulary)
    return _REMEMBERED[key]


def _tokenize(schema: pa.Schema, text_column: str, vocabulary: str, end_id: int):
    """Task over documents: the ids in place of the text, the end id behind those of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, done = _pieces_of(vocabulary), 0
        for batch in batches:
            for rows in text_slices(batch, text_column):
                ids, counts = pieces.encode(rows.column(text_column))
                ends = np.cumsum(counts)
                whole = np.insert(ids, ends, end_id).astype(np.int32)
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(whole))
                kept = rows.drop_columns([text_column]).columns
                yield pa.record_batch([*kept, pa.array(counts + 1), pa.array(done + offsets[:-1]), lists], schema=schema)
                done += len(whole)

    return run


def tokenize(
    documents: DataFrame,
    vocabulary: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """(all columns but the text, n_tokens, before, ids, shard), in ranges of ``id_column``, sorted within each.

    ``vocabulary`` is the tokenizer as JSON; it has to lower-case, to drop white
    space, and to encode runs of letters and of punctuation one by one, as word
    vocabularies do. Strings of its special tokens in a text become these
    tokens, as the tokenizer itself has it. No special token is added but
    ``end_id``, one behind each document; a null or empty text has that alone. Null ids come first, equal ids in the order of their
    texts' hashes. Older columns named like a new one are replaced.
    """
    made = {IDS, SIZE, SHARD, BEFORE, text_column.lower()}
    kept = [c for c in documents.columns if c.lower() not in made]
    order = [F.col(f"`{id_column}`"), F.xxhash64(F.col(f"`{text_column}`"))]
    docs = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_column}`").cast("string"))
    parts = [shards] if shards else []
    docs = docs.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
    fields = [f for f in docs.schema.fields if f.name in kept]
    counts = [StructField(SIZE, LongType()), StructField(BEFORE, LongType())]
    schema = StructType([*fields, *counts, StructField(IDS, ArrayType(IntegerType()))])
    encoded = docs.mapInArrow(tidy(_tokenize(arrow_schema(schema), text_column, vocabulary, end_id)), schema)
    return encoded.withColumn(SHARD, F.spark_partition_id())


def write(tokens: DataFrame, path: str, dictionary: bool = False, codec: str = "zstd") -> None:
    """Write token rows; one file for each shard that has rows.

    ``dictionary`` chooses dictionary encoding of the ids in place of delta
    encoding; a dictionary that outgrows a page falls back to plain values.
    """
    (
        tokens.write.option("compression", codec)
        .option("parquet.writer.version", "PARQUET_2_0")  # delta encodings
        .option("parquet.enable.dictionary", "false")
        .option(f"parquet.enable.dictionary#{IDS}.list.element", str(dictionary).lower())
        .option("parquet.dictionary.page.size", str(PAGE_BYTES))
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The token rows of all shards. Columns that are not selected, and pages that filters rule out, are not read."""
    return spark.read.parquet(path)


def with_starts(tokens: DataFrame) -> DataFrame:
    """Replace ``before`` by ``start``: the number of ids of all documents before this one.

    The totals of the shards come from the metadata columns alone, a row for
    each shard.
    """
    offset = unused_name("_offset", tokens.columns)
    sizes = tokens.groupBy(SHARD).agg(F.sum(SIZE).alias("size"))
    earlier = W.orderBy(SHARD).rowsBetween(W.unboundedPreceding, -1)  # as many rows as there are files
    offsets = sizes.select(SHARD, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias(offset))
    # 12 bytes for each file, of which there are far fewer than rows; the ids stay where they are
    joined = tokens.join(F.broadcast(offsets), SHARD)
    return joined.withColumn("start", F.col(BEFORE) + F.col(offset)).drop(offset, BEFORE)


def checksums(tokens: DataFrame, column: str = "ids_crc32") -> DataFrame:
    """The token rows with the CRC-32 of the ids, as little-endian unsigned 32-bit integers, in place of the ids."""
    kept = [f for f in tokens.schema.fields if f.name not in (IDS, column)]
    schema = StructType([*kept, StructField(column, LongType())])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(IDS)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            sums = [zlib.crc32(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            others = [batch.column(f.name) for f in kept]
            yield pa.record_batch([*others, pa.array(sums, pa.int64())], schema=arrow)

    return tokens.mapInArrow(tidy(run), schema)
