"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has one bit per hash bit: the majority over the hashes of all
word shingles of a text. Two texts are linked if their fingerprints differ in
at most ``radius`` bits. The links are found without listing pairs:

* Texts with equal fingerprints are one class. Only distinct fingerprints go
  further, however many copies there are.
* Every bit position has a non-zero vector of ``radius + 1`` bits, and every
  non-zero vector v of that length makes a table: its mask holds the positions
  whose vector has an odd inner product with v. For any ``radius`` positions
  some v is orthogonal to all their vectors, so two fingerprints that differ in
  no more positions agree under that mask and meet in that table.
* Within a bucket the fingerprints differ only outside the mask. Each one names
  the points around it there; two within the radius share such a midpoint, and
  fingerprints that share one are linked to the smallest, a star in place of
  all pairs. A midpoint has no more members than there are points around it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clearbook.llm.common import (
    IS_WHITE,
    LOWER,
    arrow_schema,
    text_bytes,
    text_slices,
    tidy,
    unused_name,
    words_in,
)
from clearbook.llm.components import components
from clearbook.sources.staging import stage

BITS = 64
SEED = 42


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """Fingerprint of each text as unsigned 64-bit numbers; a text without words has 0."""
    raw, offsets = text_bytes(texts)
    words = words_in(raw, offsets)
    white = IS_WHITE[raw]
    # keep the words and one blank behind each of them
    keep = ~white
    behind = words.ends[words.ends < len(raw)]
    keep[behind] |= white[behind]
    place = np.cumsum(keep) - 1
    joined = np.where(white, np.uint8(0x20), LOWER[raw])[keep].tobytes()
    starts = place[words.starts] if len(words.starts) else words.starts
    ends = starts + (words.ends - words.starts)

    counts = words.counts()
    shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    result = np.zeros(len(texts), dtype=np.uint64)
    filled = np.flatnonzero(shingles)
    if not len(filled):
        return result
    per_text = shingles[filled]
    firsts = np.cumsum(per_text) - per_text
    begin = np.arange(int(per_text.sum())) + np.repeat(words.first[filled] - firsts, per_text)
    last = np.minimum(begin + shingle, np.repeat(words.first[filled + 1], per_text)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[begin].tolist(), ends[last].tolist(), strict=True)),
        dtype=np.uint64,
        count=len(begin),
    )
    for text, first, count in zip(filled.tolist(), firsts.tolist(), per_text.tolist(), strict=True):
        own = hashes[first : first + count].view(np.uint8).reshape(-1, 8)
        ones = np.zeros(BITS, dtype=np.int64)
        for at in range(0, count, 4096):
            ones += np.unpackbits(own[at : at + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        result[text] = np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0]
    return result


def with_fingerprints(
    documents: DataFrame, shingle: int, text_column: str = "text", column: str = "fingerprint"
) -> DataFrame:
    """All columns but the text, and the fingerprint as a signed long."""
    kept = [c for c in documents.columns if c.lower() not in (text_column.lower(), column.lower())]
    docs = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_column}`").cast("string"))
    fields = [field for field in docs.schema if field.name in kept]
    schema = StructType([*fields, StructField(column, LongType())])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, text_column):
                found = fingerprints_of(rows.column(text_column), shingle).view(np.int64)
                yield pa.record_batch([*rows.columns[:-1], pa.array(found)], schema=arrow)

    return docs.mapInArrow(tidy(run), schema)


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >= 1 << (BITS - 1) else number


def covering_masks(radius: int) -> list[int]:
    """Masks of which one avoids any given ``radius`` positions; there are 2 ** (radius + 1) - 1."""
    vectors = range(1, 1 << (radius + 1))
    position = [1 + bit % len(vectors) for bit in range(BITS)]
    return [sum(1 << bit for bit in range(BITS) if (position[bit] & v).bit_count() % 2) for v in vectors]


def _patterns(mask: int, radius: int) -> list[tuple[int, int]]:
    """(changed bits, their number) of all points up to half the radius away that agree under the mask."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    reach = (radius + 1) // 2
    return [(sum(1 << bit for bit in bits), n) for n in range(reach + 1) for bits in combinations(free, n)]


def near_links(fingerprints: DataFrame, radius: int, column: str = "fingerprint") -> DataFrame:
    """(a, b): links that join any two distinct fingerprints up to ``radius`` bits apart, directly or by others.

    Every link is itself within the radius. With a radius of 0 there is none.
    """
    spark = fingerprints.sparkSession
    masks = covering_masks(radius)
    reps = fingerprints.select(F.col(f"`{column}`").alias("f")).where("f IS NOT NULL").distinct()
    tables = F.array(
        *[
            F.struct(F.lit(number).alias("number"), F.col("f").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for number, mask in enumerate(masks)
        ]
    )
    placed = stage(reps.select("f", F.explode(tables).alias("t")).select("f", "t.number", "t.key"), "tables")
    met = placed.groupBy("number", "key").count().where("count > 1").drop("count")
    members = placed.join(met, ["number", "key"], "left_semi")

    near_reach = radius // 2
    changes = spark.createDataFrame(
        [(number, _signed(bits), n <= near_reach) for number, mask in enumerate(masks) for bits, n in _patterns(mask, radius)],
        "number int, change long, near boolean",
    )
    around = members.join(F.broadcast(changes), "number").select(  # as many rows as the radius gives
        "number", F.col("f").bitwiseXOR(F.col("change")).alias("midpoint"), "f", "near"
    )
    stars = around.groupBy("number", "midpoint").agg(
        F.min(F.when(F.col("near"), F.col("f"))).alias("hub"), F.collect_set("f").alias("members")
    )
    return (
        stars.where((F.size("members") > 1) & F.col("hub").isNotNull())
        .select(F.col("hub").alias("a"), F.explode("members").alias("b"))
        .where("a <> b")
        .distinct()
    )


def near_duplicates(
    documents: DataFrame, shingle: int, radius: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: (id, fingerprint as hex, component_id).

    ``component_id`` is the smallest id whose document can be reached over
    fingerprints at most ``radius`` bits apart, the document itself included.
    Documents without words, null texts among them, share the fingerprint 0 and
    are linked like any other. Repeated ids give repeated rows; a null id never
    names a component unless all ids of the component are null. Further columns
    are not looked at. No documents give no rows.
    """
    slim = documents.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    printed = stage(with_fingerprints(slim, shingle), "fingerprints")
    return classes_of(printed, radius).select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def classes_of(printed: DataFrame, radius: int) -> DataFrame:
    """(id, fingerprint, component_id) for rows (id, fingerprint)."""
    firsts = printed.groupBy("fingerprint").agg(F.min("id").alias("first"))
    roots = components(near_links(printed, radius)).select(F.col("node").alias("fingerprint"), "root")
    # a fingerprint without links is its own root
    rooted = firsts.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "component_id")
    return printed.join(named, "fingerprint").select("id", "fingerprint", "component_id")


def one_of_each(
    documents: DataFrame, shingle: int, radius: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents with one row left of each component: the smallest id, then the smallest text hash.

    All columns are kept as they are. Rows that repeat id and text count as one
    document and leave one row; null ids come last.
    """
    digest, group = unused_name("_digest", documents.columns), unused_name("_of", documents.columns)
    hashed = documents.withColumn(digest, F.xxhash64(F.col(f"`{text_column}`")))
    key = F.struct(F.col(f"`{id_column}`").isNull().alias("last"), F.col(f"`{id_column}`").alias("id"), F.col(digest).alias("digest"))
    slim = hashed.select(key.alias("id"), F.col(f"`{text_column}`").alias("text"))
    printed = stage(with_fingerprints(slim, shingle), "fingerprints")
    kept = classes_of(printed, radius).select(F.col("component_id").alias(group)).distinct()
    survivors = hashed.join(
        kept,
        F.col(f"`{id_column}`").eqNullSafe(F.col(f"{group}.id")) & F.col(digest).eqNullSafe(F.col(f"{group}.digest")),
        "left_semi",
    )
    return survivors.dropDuplicates([id_column, digest]).drop(digest)
