"""Byte-level BPE over a whole corpus by a global shuffle of distinct words.

Encoding runs in three passes:

1. Every task cuts its texts into pre-tokens and keeps, for each block of
   texts, a list of distinct pre-tokens and the place of each occurrence in
   that list. A block is bounded by its bytes of text, not by rows.
2. The distinct pre-tokens of all blocks meet by their bytes. Each one is
   encoded once and the ids go back to every block that holds it.
3. Blocks are put together again: the ids of a block's pre-tokens arrive
   before its texts, and each text picks its ids by position.

A shuffle so carries a pre-token once for each block and a small number for
each occurrence. A frequent pre-token has one row per block, never one per
occurrence, and a partition is read as a sorted stream, so memory is bounded
by one block.
"""

from __future__ import annotations

import base64
import random
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from clearbook.llm.common import (
    SLICE_BYTES,
    arrow_schema,
    binary_array,
    bytes_of,
    ragged,
    text_bytes,
    text_slices,
    tidy,
    unused_name,
)

BLOCK_TOKENS = 4_000_000

TOKEN_BYTES = 6  # of an average pre-token, by which the size of a block is told

NOT_WHOLE = "The pattern leaves out characters; every one has to be part of a match."

CHANGED = "The documents changed between two reads; write them to a table first."

WORD, TEXT = 0, 1

# Kinds of bytes. Marks are the printable ASCII signs but the apostrophe, which may begin a pre-token of letters.
_LETTER, _DIGIT, _MARK, _BLANK, _OTHER = range(5)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[0x20] = _BLANK
for _byte in range(33, 127):
    _sign = chr(_byte)
    _KIND[_byte] = _LETTER if _sign.isalpha() else _DIGIT if _sign.isdigit() else _OTHER if _sign == "'" else _MARK

# Second bytes of the letters from U+00C0 to U+00FF; two of these characters are signs.
_SECOND_OF_LETTER = np.zeros(256, dtype=bool)
_SECOND_OF_LETTER[0x80:0xC0] = True
_SECOND_OF_LETTER[[0x97, 0xB7]] = False

# A chunk may begin at a blank if the byte behind it cannot begin a white character of Unicode:
# it is no ASCII white space or separator and no first byte of a longer white character.
_MAY_FOLLOW = np.ones(256, dtype=bool)
_MAY_FOLLOW[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0xC2, 0xE1, 0xE2, 0xE3]] = False


def read_ranks(path: str) -> list[bytes]:
    """The token-byte table of a rank file: the bytes of every id, in id order.

    The file is the vocabulary, so its size does not depend on the corpus.
    """
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    table = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        table[int(rank)] = base64.b64decode(token)
    return table


def _kinds(data: np.ndarray) -> np.ndarray:
    """What each byte is part of: a blank, an ASCII letter or one of U+00C0 to U+00FF, a digit, a mark, or anything else."""
    kinds = _KIND[data]
    if len(data):
        latin = (data[:-1] == 0xC3) & _SECOND_OF_LETTER[data[1:]]
        kinds[:-1][latin] = _LETTER
        kinds[1:][latin] = _LETTER
    return kinds


def _pieces(data: np.ndarray, offsets: np.ndarray, pattern) -> np.ndarray:
    """Where the pre-tokens of texts begin, and the end.

    The texts are cut before single blanks and between letters, digits and
    marks. Every pre-token lies within one such chunk. A chunk of letters alone,
    or digits or marks, with a blank before them or not, is a pre-token; the
    pattern cuts each distinct one of the others.
    """
    size = len(data)
    if not size:
        return np.zeros(1, dtype=np.int64)
    kinds = _kinds(data)
    cut = np.zeros(size, dtype=bool)
    cut[:-1] = (data[:-1] == 0x20) & _MAY_FOLLOW[data[1:]]
    last = offsets[1:][offsets[1:] > 0] - 1
    cut[last] = False  # what follows the last blank of a text is not of that text
    cut[1:] |= (kinds[1:] != kinds[:-1]) & (kinds[1:] <= _MARK) & (kinds[:-1] <= _MARK)
    cut[offsets[offsets < size]] = True
    begins = np.flatnonzero(cut)
    bounds = np.append(begins, size)
    blank, other = kinds == _BLANK, kinds == _OTHER
    odd = np.add.reduceat(other, begins, dtype=np.int64) > 0
    blanks = np.add.reduceat(blank, begins, dtype=np.int64)
    odd |= (blanks > 1) | ((blanks == 1) & (~blank[begins] | (np.diff(bounds) == 1)))
    chosen = np.flatnonzero(odd)
    if not len(chosen):
        return bounds
    # every second piece of these bounds is a chunk that the pattern has to cut
    ends = np.empty(2 * len(chosen), dtype=np.int64)
    ends[0::2], ends[1::2] = bounds[chosen], bounds[chosen + 1]
    coded = binary_array(data, ends).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)[0::2]
    used = np.zeros(len(coded.dictionary), dtype=bool)
    used[codes] = True
    counts = np.zeros(len(used), dtype=np.int64)
    lengths: list[int] = []
    for at, chunk in zip(np.flatnonzero(used), coded.dictionary.filter(pa.array(used)).to_pylist(), strict=True):
        own = [len(piece.encode()) for piece in pattern.findall(chunk.decode())]
        if sum(own) != len(chunk):
            raise ValueError(NOT_WHOLE)
        counts[at] = len(own)
        lengths.extend(own)
    # where the pieces of each chunk begin, within the chunk
    flat = np.array(lengths, dtype=np.int64)
    within = np.cumsum(flat) - flat
    first = np.cumsum(counts) - counts
    within -= np.repeat(within[np.minimum(first, len(flat) - 1)], counts)
    more = ragged(counts, within, codes) + np.repeat(bounds[chosen], counts[codes])
    cut[more] = True
    return np.append(np.flatnonzero(cut), size)


def _check(pattern: str) -> None:
    """Raise for a pattern whose pre-tokens cross the cuts; tried on short texts of all kinds of characters."""
    compiled, rng = regex.compile(pattern), random.Random(0)
    signs = "abST09.,#-_'\" \n\t\x1c\xa0éÀ÷中٣\u0301" + "    aaa"
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(2000)]
    data, offsets = text_bytes(pa.array(texts))
    bounds = _pieces(data, offsets, compiled)
    raw = data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    if found != [piece for text in texts for piece in compiled.findall(text)]:
        raise ValueError("This pattern joins what the texts are cut between: blanks, letters, digits and marks.")


def _hashes(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """A 64-bit hash of each piece of ``data`` between consecutive offsets, as a signed number."""
    whole = memoryview(np.ascontiguousarray(data))
    digests = np.fromiter(
        (xxhash.xxh64_intdigest(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)),
        dtype=np.uint64,
        count=len(offsets) - 1,
    )
    return digests.view(np.int64).tolist()


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: high bytes are nearly all zero."""
    planes = numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * size, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


class _Block:
    """The pre-tokens of a block's slices: numbers for each slice, and the distinct ones they number."""

    def __init__(self, name: int) -> None:
        self.name, self.bytes = name, 0
        self.lists: list[pa.Array] = []
        self.slices: list[tuple[np.ndarray, np.ndarray, list[int], list[pa.Array]]] = []

    def add(self, rows: pa.RecordBatch, text_column: str, part_column: str, pattern) -> None:
        data, offsets = text_bytes(rows.column(text_column))
        bounds = _pieces(data, offsets, pattern)
        coded = binary_array(data, bounds).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        kept = rows.drop_columns([text_column, part_column]).columns
        self.lists.append(coded.dictionary)
        self.slices.append((codes, np.searchsorted(bounds[:-1], offsets), _hashes(data, offsets), kept))
        self.bytes += len(data)

    def numbered(self) -> tuple[pa.Array, list[np.ndarray]]:
        """(distinct pre-tokens in the order they first come, their numbers where each slice's own ones begin)."""
        coded = pa.concat_arrays(self.lists).dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        before = np.cumsum([0, *(len(own) for own in self.lists)])
        return coded.dictionary, [places[at:] for at in before[:-1]]


def _cut_blocks(kind: int, text_column: str, part_column: str, pattern: str, block_tokens: int, schema: pa.Schema):
    """Task over documents with their split: rows of one kind, the pre-tokens or the texts of its blocks."""

    def word_rows(block: _Block) -> Iterator[pa.RecordBatch]:
        words, _ = block.numbered()
        for begin in range(0, len(words), 50_000):
            some = words.slice(begin, 50_000).cast(pa.binary())
            places = np.arange(begin, begin + len(some), dtype=np.int32)
            yield pa.record_batch([pa.array(np.full(len(some), block.name)), pa.array(places), some], schema=schema)

    def text_rows(block: _Block, sequence: int) -> Iterator[pa.RecordBatch]:
        fields = list(schema.field("carried").type)
        _, numbers = block.numbered()
        for (codes, ends, hashes, kept), own in zip(block.slices, numbers, strict=True):
            places, size = own[codes], len(hashes)
            positions = [places[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.record_batch(
                [
                    pa.array(np.full(size, block.name)),
                    pa.array(np.arange(sequence, sequence + size, dtype=np.int32)),
                    pa.array([_pack(p) for p in positions], pa.binary()),
                    pa.array([len(p) for p in positions], pa.int32()),
                    pa.array(hashes, pa.int64()),
                    pa.StructArray.from_arrays(kept, fields=fields) if kept else pa.nulls(size, pa.struct([])),
                ],
                schema=schema,
            )
            sequence += size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        block, number, sequence = None, 0, 0
        for batch in batches:
            for rows in text_slices(batch, text_column, min(SLICE_BYTES, TOKEN_BYTES * block_tokens)):
                if block is not None and block.bytes >= TOKEN_BYTES * block_tokens:
                    yield from word_rows(block) if kind == WORD else text_rows(block, sequence)
                    sequence += sum(len(hashes) for _, _, hashes, _ in block.slices)
                    block, number = None, number + 1
                if block is None:
                    block = _Block((rows.column(part_column)[0].as_py() << 32) + number)
                block.add(rows, text_column, part_column, compiled)
        if block is not None:
            yield from word_rows(block) if kind == WORD else text_rows(block, sequence)

    return run


def _encode_sorted(table: list[bytes], pattern: str, flush_rows: int = 500_000):
    """Task over (block, seq, word) sorted by word: every word is encoded when it first comes.

    The answers for one block leave as few rows: the places in its list, their numbers of ids, the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(table, pattern).encode_ordinary
        blocks, places, lengths, found, waiting = [], [], [], [], 0

        def answers() -> pa.RecordBatch:
            block, place = np.concatenate(blocks), np.concatenate(places)
            sizes, flat = np.concatenate(lengths), np.concatenate(found)
            order = np.lexsort((place, block))
            block, place = block[order], place[order]
            begins = np.flatnonzero(np.diff(block, prepend=-1))
            packed, counts = [], []
            for a, b in zip(begins, [*begins[1:], len(order)], strict=True):
                own = order[a:b]
                whole = np.concatenate([[b - a], np.diff(place[a:b], prepend=0), sizes[own], ragged(sizes, flat, own)])
                packed.append(_pack(whole))
                counts.append(len(whole))
            return pa.record_batch(
                [pa.array(block[begins]), pa.array(packed, pa.binary()), pa.array(counts, pa.int32())],
                names=["block", "payload", "size"],
            )

        for batch in batches:
            # equal words follow each other, so a word is encoded once, or twice where a batch ends between
            coded = batch.column("word").dictionary_encode()
            own = [encode(word.decode()) for word in coded.dictionary.to_pylist()]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.fromiter(chain.from_iterable(own), np.int32, int(sizes.sum()))
            codes = coded.indices.to_numpy(zero_copy_only=False)
            lengths.append(sizes[codes])
            found.append(ragged(sizes, flat, codes))
            blocks.append(batch.column("block").to_numpy(zero_copy_only=False))
            places.append(batch.column("seq").to_numpy(zero_copy_only=False))
            waiting += batch.num_rows
            if waiting >= flush_rows:
                yield answers()
                blocks, places, lengths, found, waiting = [], [], [], [], 0
        if waiting:
            yield answers()

    return run


_ENCODERS: dict[tuple[int, str], tiktoken.Encoding] = {}  # of this Python worker


def _encoder(table: list[bytes], pattern: str) -> tiktoken.Encoding:
    key = xxhash.xxh64_intdigest(b"".join(b"%d:%b" % (len(token), token) for token in table)), pattern
    if key not in _ENCODERS:
        ranks = {token: rank for rank, token in enumerate(table) if token}
        _ENCODERS.clear()
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def _assemble(table: list[bytes], schema: pa.Schema, with_bytes: bool):
    """Task over rows sorted by (block, kind, seq): pre-token ids first, then the texts that use them.

    The ids of a text are decoded and compared with the text's hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(table, pa.large_binary())
        block, answers, lengths, values = None, [], None, None
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            begins = np.flatnonzero((np.diff(blocks, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0))
            for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                rows = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, answers, lengths, values = blocks[begin], [], None, None
                if kinds[begin] == WORD:
                    sizes = rows.column("size").to_pylist()
                    answers += [_unpack(p, n) for p, n in zip(rows.column("payload").to_pylist(), sizes, strict=True)]
                    continue
                if lengths is None:
                    lengths, values = _by_place(answers)
                    answers = []
                yield from _texts(rows, lengths, values, tokens)

    def _by_place(answers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids, the ids) of all words of a block, in the order of its list."""
        none = np.empty(0, dtype=np.int64)
        places = np.concatenate([none, *(np.cumsum(x[1 : 1 + x[0]]) for x in answers)])
        lengths = np.concatenate([none, *(x[1 + x[0] : 1 + 2 * x[0]] for x in answers)])
        flat = np.concatenate([none, *(x[1 + 2 * x[0] :] for x in answers)])
        order = np.argsort(places)
        return lengths[order], ragged(lengths, flat, order)

    def _texts(
        rows: pa.RecordBatch, lengths: np.ndarray, values: np.ndarray, tokens: pa.Array
    ) -> Iterator[pa.RecordBatch]:
        sizes = rows.column("size").to_numpy(zero_copy_only=False)
        before = np.cumsum(sizes, dtype=np.int64) - sizes
        begins = np.flatnonzero(np.diff(before // 500_000, prepend=-1))
        for begin, end in zip(begins, [*begins[1:], rows.num_rows], strict=True):
            some = rows.slice(begin, end - begin)
            picks = [
                _unpack(packed, size)
                for packed, size in zip(some.column("payload").to_pylist(), sizes[begin:end].tolist(), strict=True)
            ]
            flat = np.concatenate(picks)
            if len(flat) and flat.max() >= len(lengths):
                raise RuntimeError(CHANGED)
            ids = ragged(lengths, values, flat).astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(lengths[flat])])
            offsets = ends[np.concatenate([[0], np.cumsum([len(p) for p in picks])])]
            data, at = bytes_of(tokens.take(pa.array(ids)))
            if _hashes(data, at[offsets]) != some.column("hash").to_pylist():
                raise RuntimeError(CHANGED)
            made = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
            if with_bytes:
                made.append(binary_array(data, at[offsets]).cast(pa.binary()))
            yield pa.record_batch([*some.column("carried").flatten(), *made], schema=schema)

    return run


def encode(
    documents: DataFrame,
    table: list[bytes],
    pattern: str,
    text_column: str = "text",
    ids_column: str = "ids",
    block_tokens: int = BLOCK_TOKENS,
    decoded_column: str | None = None,
) -> DataFrame:
    """The documents with ``ids_column`` (array of int) in place of their text.

    The ids of every text are decoded in the task that puts them together, and
    compared with the text's hash. With ``decoded_column`` the bytes are kept, as
    ``decode`` would give them later.

    Every character has to be part of a match of ``pattern``, and its matches may
    not cross from letters to digits or marks, or from one of these to the next
    blank; a pattern for which that does not hold raises ValueError.

    One row comes out for each row that goes in, whatever ids it repeats; all
    other columns are carried along, null or not. A null or empty text has no
    ids. An older column named like ``ids_column`` is replaced.

    ``documents`` is read twice and has to give the same rows in the same order,
    as a scan of files does; write the result of a shuffle to a table first. A
    text whose ids do not decode to it, because a block differed, stops the job.
    """
    replaced = {text_column.lower(), ids_column.lower(), (decoded_column or ids_column).lower()}
    carried = [c for c in documents.columns if c.lower() not in replaced]
    part = unused_name("_part", documents.columns)
    docs = documents.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text_column}`").cast("string"))
    _check(pattern)
    docs = docs.withColumn(part, F.spark_partition_id().cast("long"))
    kept = StructType([field for field in docs.schema if field.name in carried])

    word_schema = "block long, seq int, word binary"
    words = docs.select(part, f"`{text_column}`").mapInArrow(
        tidy(_cut_blocks(WORD, text_column, part, pattern, block_tokens, arrow_schema(word_schema))), word_schema
    )
    answers = (
        words.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(tidy(_encode_sorted(table, pattern)), "block long, payload binary, size int")
    )

    text_schema = StructType(
        [*StructType.fromDDL("block long, seq int, payload binary, size int, hash long"), StructField("carried", kept)]
    )
    texts = docs.mapInArrow(
        tidy(_cut_blocks(TEXT, text_column, part, pattern, block_tokens, arrow_schema(text_schema))), text_schema
    )
    rows = answers.withColumns(
        {"kind": F.lit(WORD), "seq": F.lit(0), "hash": F.lit(None).cast("long"), "carried": F.lit(None).cast(kept)}
    ).unionByName(texts.withColumn("kind", F.lit(TEXT)))
    out = StructType([*kept.fields, StructField(ids_column, ArrayType(IntegerType(), True))])
    if decoded_column is not None:
        out = _with_bytes(out, decoded_column)
    task = _assemble(table, arrow_schema(out), decoded_column is not None)
    return rows.repartition("block").sortWithinPartitions("block", "kind", "seq").mapInArrow(tidy(task), out)


def _with_bytes(schema: StructType, column: str) -> StructType:
    return StructType([*schema.fields, StructField(column, BinaryType())])


def _decode_task(table: list[bytes], ids_column: str, schema: pa.Schema):
    """Task over rows with ids: the same rows and the bytes of the ids, joined from the token-byte table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(table, pa.large_binary())
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids_column)), 0).to_numpy(zero_copy_only=False)
            before = np.cumsum(sizes, dtype=np.int64) - sizes
            begins = np.flatnonzero(np.diff(before // 500_000, prepend=-1))
            for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                rows = batch.slice(begin, end - begin)
                flat = tokens.take(rows.column(ids_column).flatten())
                data, offsets = bytes_of(flat)
                at = offsets[np.concatenate([[0], np.cumsum(sizes[begin:end], dtype=np.int64)])]
                decoded = binary_array(data, at).cast(pa.binary())
                yield pa.record_batch([*rows.columns, decoded], schema=schema)

    return run


def decode(
    encoded: DataFrame, table: list[bytes], ids_column: str = "ids", bytes_column: str = "decoded"
) -> DataFrame:
    """Add ``bytes_column``: the joined bytes of the ids, looked up in the token-byte table.

    The table is the vocabulary and goes to every task. No ids, or null, gives
    empty bytes; an id outside the table stops the job. An older column named
    like ``bytes_column`` is replaced.
    """
    encoded = encoded.drop(bytes_column)
    schema = _with_bytes(encoded.schema, bytes_column)
    return encoded.mapInArrow(tidy(_decode_task(table, ids_column, arrow_schema(schema))), schema)


def digests(decoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids as decimal text, SHA-256 of the decoded bytes."""
    return decoded.select(
        id_column,
        F.coalesce(F.size("ids"), F.lit(0)).cast(LongType()).alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
