"""Substring deduplication by hashes of lines, paragraphs or sentences.

Texts are cut into units, and a unit's digest is taken of its words alone, in
lower case. Digests are grouped over the whole corpus; the occurrence that ranks
first stays, all others are removed, each with its place in the original text.

A unit of few words repeats by chance, so it is hashed together with the units that
follow it, until there are enough words, and once more with those before it. Each
unit begins such a stretch, and each short one ends one, whatever stands around: a
passage of short units has the same stretches wherever it is copied to, and they
cover it.

The occurrences of a digest are never gathered: an aggregation finds the first
one, combined before the shuffle, and only digests that occur again are joined
back, in a join that Spark can split where one unit is very frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearbook.llm.common import (
    IS_WHITE,
    arrow_schema,
    cased_words,
    text_bytes,
    text_slices,
    tidy,
    unused_name,
    word_hashes,
)
from clearbook.sources.staging import stage

MIN_WORDS = 6  # shorter units repeat by chance and are hashed with the next ones
JOINED_WORDS = 20  # that they need together: a few short units follow each other by chance more often than a long one recurs

SLICE = 1 << 19  # bytes of text at once; words of short units are held several times

UNITS = ("line", "paragraph", "sentence")

_PLACES = "no int, start int, end int, high long, low long"

_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _breaks(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Places where a unit begins, in ascending order, the beginnings of texts included."""
    feeds = data == 0x0A
    begins = np.zeros(len(data) + 1, dtype=bool)
    if unit == "paragraph":
        begins[2:] = feeds[1:] & feeds[:-1]
    else:
        begins[1:] = feeds
    if unit == "sentence" and len(data):
        ends = (data[:-1] == 0x2E) | (data[:-1] == 0x21) | (data[:-1] == 0x3F)  # . ! ?
        begins[1:-1] |= ends & IS_WHITE[data[1:]]
    begins[offsets[:-1]] = True
    return np.flatnonzero(begins[:-1])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _FACTORS[2]
    return x ^ (x >> np.uint64(29))


def units_of(texts: pa.Array, unit: str, min_words: int, joined_words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row, [number, start, end, high, low]) of all units, short ones with those behind or before them.

    ``start`` and ``end`` are code points of the text, from the first to behind the
    last character that is not white. A digest is 128 bits of the words and their
    order. Short units of a text that has fewer than ``joined_words`` have no row.
    """
    data, offsets = text_bytes(texts)
    words = cased_words(texts)
    begins = _breaks(data, offsets, unit)
    if not len(words.starts):
        return np.empty(0, dtype=np.int64), [np.empty(0, dtype=np.int64)] * 5
    of_word = np.searchsorted(begins, words.starts, side="right") - 1
    firsts = np.flatnonzero(np.diff(of_word, prepend=-1))  # first words of the units that have any
    ends = np.append(firsts[1:], len(of_word))
    texts_of = words.rows()[firsts]
    text_begin, text_end = words.first[texts_of], words.first[texts_of + 1]
    # long units alone; from each short one on as far as is needed, and to the end of it from as far back
    short = ends - firsts < min_words
    alone = np.flatnonzero(~short)
    ahead = np.flatnonzero(short & (firsts + joined_words <= text_end))
    back = np.flatnonzero(short & (ends - joined_words >= text_begin))
    begin = np.concatenate([alone, ahead, np.searchsorted(firsts, ends[back] - joined_words, side="right") - 1])
    last = np.concatenate([alone, np.searchsorted(ends, firsts[ahead] + joined_words), back])
    begin, last = np.divmod(np.unique(begin * (len(firsts) + 1) + last), len(firsts) + 1)
    firsts, counts = firsts[begin], ends[last] - firsts[begin]
    owner = np.repeat(np.arange(len(firsts)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = word_hashes(words, lower=True)[firsts[owner] + place]
    place = place.astype(np.uint64)
    begun = np.cumsum(counts) - counts
    with np.errstate(over="ignore"):
        digests = [
            np.add.reduceat(_mixed(hashes + (place + np.uint64(1)) * f), begun) if len(begun) else np.empty(0, dtype=np.uint64)
            for f in _FACTORS[:2]
        ]
    units = of_word[firsts]
    row = np.searchsorted(offsets, begins[units], side="right") - 1
    behind = np.append(begins[1:], len(data))[of_word[ends[last] - 1]]
    # trim white space at both ends
    ink = np.flatnonzero(~IS_WHITE[data])
    left = ink[np.searchsorted(ink, begins[units])]
    right = ink[np.searchsorted(ink, behind) - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base = points[offsets[row]]
    number = units - np.searchsorted(begins, offsets[row])
    found = [number, points[left] - base, points[right] - base]
    return row, [*found, *(d.view(np.int64) for d in digests)]


def units(
    documents: DataFrame,
    unit: str = "line",
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    joined_words: int = JOINED_WORDS,
) -> DataFrame:
    """(id, digest, no, start, end, high, low): the units of all texts; ``digest`` is the hash of the whole text."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    docs = documents.select(
        F.col(f"`{id_column}`").alias("id"),
        F.xxhash64(F.col(f"`{text_column}`").cast("string")).alias("digest"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    schema = StructType([docs.schema["id"], docs.schema["digest"], *StructType.fromDDL(_PLACES).fields])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                row, found = units_of(part.column("text"), unit, min_words, joined_words)
                at = pa.array(row)
                values = [pa.array(v, arrow.field(i + 2).type) for i, v in enumerate(_narrow(found))]
                yield pa.record_batch([part.column("id").take(at), part.column("digest").take(at), *values], schema=arrow)

    return docs.mapInArrow(tidy(run), schema)


def _narrow(found: list[np.ndarray]) -> list[np.ndarray]:
    return [v.astype(np.int32) for v in found[:3]] + found[3:]


def repeats(
    documents: DataFrame,
    unit: str = "line",
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    joined_words: int = JOINED_WORDS,
) -> DataFrame:
    """(id, digest, removed): for each document that loses something, the places of all units to remove, in order.

    The occurrence that stays is the one with the smallest id, then the smallest
    text hash, then the first in its text; null ids rank last. Rows that repeat id
    and text are one document and lose the same. Null and empty texts have no units.
    """
    # rows of a document that comes several times rank the same, so neither of them is later than the other
    rows = stage(units(documents, unit, min_words, id_column, text_column, joined_words), "units")
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "digest", "no")
    again = (
        rows.groupBy("high", "low")
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("high", "low", "first")
    )
    # staged, as Spark divides a hot digest only if both sides of the join come straight from a shuffle
    again = stage(again, "again")
    later = rows.join(again, ["high", "low"]).where(~rank.eqNullSafe(F.col("first")))
    places = later.groupBy("id", "digest").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed"))
    return places.mapInArrow(tidy(_united), places.schema)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over rows with sorted places: places that overlap become one."""
    for batch in batches:
        lists = batch.column("removed")
        flat = lists.flatten()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), sizes)
        start, end = (flat.field(name).to_numpy().astype(np.int64) for name in ("start", "end"))
        # rows stand one behind the other on one line, so that none reaches into the next
        shift = row * (int(end.max(initial=0)) + 1)
        furthest = np.maximum.accumulate(end + shift) if len(end) else end
        opens = np.ones(len(start), dtype=bool)
        opens[1:] = (start + shift)[1:] > furthest[:-1]
        firsts = np.flatnonzero(opens)
        lasts = np.append(firsts[1:], len(start)) - 1
        kind = flat.type
        values = [pa.array(start[firsts]).cast(kind[0].type), pa.array((furthest - shift)[lasts]).cast(kind[1].type)]
        offsets = np.searchsorted(row[firsts], np.arange(batch.num_rows + 1)).astype(np.int32)
        united = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, fields=list(kind)))
        yield pa.record_batch([batch.column("id"), batch.column("digest"), united.cast(lists.type)], names=["id", "digest", "removed"])


def remove(
    documents: DataFrame,
    unit: str = "line",
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    joined_words: int = JOINED_WORDS,
) -> DataFrame:
    """The documents without the units that occurred before, and ``removed``: their places in the original text.

    All rows stay, with all columns; a text that loses nothing is as it was and
    has no places. An older column ``removed`` is replaced.
    """
    lost_id, lost_digest = (unused_name(name, documents.columns) for name in ("_lost_id", "_lost_digest"))
    lost = repeats(documents, unit, min_words, id_column, text_column, joined_words).withColumnsRenamed(
        {"id": lost_id, "digest": lost_digest}
    )
    docs = documents.drop("removed")
    text = F.col(f"`{text_column}`")
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(lost_id)) & (F.xxhash64(text.cast("string")) == F.col(lost_digest))
    joined = docs.join(lost, same, "left").drop(lost_id, lost_digest)
    # what stands between two removed places, and before the first and behind the last
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    removed = F.coalesce("removed", nothing)
    edges = F.concat(removed, F.array(F.struct(F.length(text).alias("start"), F.length(text).alias("end"))))
    pieces = F.transform(
        edges,
        lambda e, i: F.substring(
            text,
            F.when(i == 0, 1).otherwise(F.get(removed, i - 1)["end"] + 1),
            e["start"] - F.when(i == 0, 0).otherwise(F.get(removed, i - 1)["end"]),
        ),
    )
    cleaned = F.when(F.size(removed) > 0, F.array_join(pieces, "")).otherwise(text)
    return joined.withColumns({text_column: cleaned, "removed": removed})
