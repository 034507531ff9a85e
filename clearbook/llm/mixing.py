"""Mixing sources to target weights: blocks of equal size, apportioned by the method of Sainte-Lague.

The words of a source lie on a line, its documents one behind the other in a
seeded order. The line is cut into blocks of equally many words. A mix takes
blocks, and takes all of them once before it takes any again.

* Targets. Each source gets a share of the mix by its weight, but no more than a
  number of passes over all its words; what is cut there is shared among the
  others by weight, until none is above its bound.
* Quotas. The blocks of the mix go to the sources by highest quotients: a source
  of target t that has k blocks bids t / (2 k + 1) for its next one. The same rule
  then deals the quotas out to shards, so that every run of blocks has the
  sources in proportion. Quotas are whole numbers and add up exactly.
  A quota is the target over a common divisor, rounded, but for a few blocks; only
  the bids for those are listed, three for each source, not one for each block.
* Selection. In a pass over a source its blocks come in an order that a seeded
  permutation gives. It is computed for the blocks of a document where that
  document is, so no list of blocks exists anywhere. The last, shorter block of
  the line comes last in each pass.

A document's place on its line is the sum of the sizes before it: sums of the
ranges of the seeded hash, a fixed number for each source, and a running sum
within the range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from clearbook.llm.common import arrow_schema, tidy
from clearbook.operators.numbering import numbered
from clearbook.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 32  # words; small ones bring small sources near their targets
SHARDS = 64
SEED = 42
RANGE_BITS = 12  # the line of a source is summed up in so many ranges, as a power of two
ROUNDS = 6  # of the block cipher that permutes the blocks

PIECES = ArrayType(
    StructType(
        [
            StructField("shard", IntegerType()),
            StructField("seat", LongType()),
            StructField("begin", LongType()),
            StructField("end", LongType()),
        ]
    )
)


def by_rank(documents: DataFrame, weights: list[float], source_column: str = "source") -> DataFrame:
    """(source, weight): the sources in the order of their code points, null last, with ``weights`` over and over."""
    sources = documents.select(F.col(f"`{source_column}`").cast("string").alias("source")).distinct()
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "rank")
    # Spark compares texts by their bytes, which is the order of code points
    values = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.select("source", values[(F.col("rank") % len(weights)).cast("int")].alias("weight"))


def targets(sizes: DataFrame, share: float, passes: int) -> DataFrame:
    """Add ``target`` to (size, weight) rows: ``share`` of all sizes by weight, at most ``passes`` times each size.

    What the bound cuts goes to the others by weight, round by round until no
    more sources reach it. A source without a positive weight has the target 0.
    """
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    bound = F.when(weight > 0, F.col("size") * float(passes)).otherwise(0.0)
    level, full = 0.0, -1
    while True:
        capped = bound <= F.lit(level) * weight
        row = sizes.agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
            F.sum(F.when(capped, bound).otherwise(0.0)).alias("bounded"),
            F.sum(F.when(capped, 0.0).otherwise(weight)).alias("weight"),
            F.count(F.when(capped, 1)).alias("full"),
        ).first()
        if row.full == full:
            return sizes.withColumn("target", F.when(capped, bound).otherwise(F.lit(level) * weight))
        full = row.full
        level = (share * row.size - row.bounded) / row.weight if row.weight else level


def apportion(rows: DataFrame, houses: list[int], value: str) -> DataFrame:
    """(columns of ``rows``, number, quota): the seats of each house by highest quotients of ``value``.

    ``houses`` are numbers of seats, and ``number`` says which of them it is.
    ``rows`` has a column ``key``: of equal bids the one with the smaller key
    wins. With a house reduced, or raised, by the number of rows, rounding to
    the common divisor gives at most, or at least, the seats there are; the
    bids between the two are ranked, about three for each row.
    """
    total, count = rows.agg(F.sum(value), F.count(F.when(F.col(value) > 0, 1))).first()

    def rounded(house: Column) -> Column:
        return F.greatest(F.floor(F.col(value) * house / F.lit(float(total or 1)) + 0.5), F.lit(0))

    spread = rows.select("*", F.posexplode(F.array(*[F.lit(int(h)).cast("long") for h in houses])).alias("number", "house"))
    bids_at_all = F.col(value) > 0
    spread = spread.withColumns(
        {
            "least": F.when(bids_at_all & (F.col("house") > count), rounded(F.col("house") - count)).otherwise(0),
            "most": F.when(bids_at_all, rounded(F.col("house") + count)).otherwise(0),
        }
    )
    of_house = W.partitionBy("number")  # a row for each source
    spread = spread.withColumn("open", F.col("house") - F.sum("least").over(of_house))
    contested = F.when(F.col("most") > F.col("least"), F.sequence(F.col("least"), F.col("most") - 1))
    bids = spread.select("key", "number", "open", value, F.explode(contested).alias("seat"))
    place = F.row_number().over(of_house.orderBy((F.col(value) / (2 * F.col("seat") + 1)).desc(), "key", "seat"))
    won = bids.withColumn("place", place).where(F.col("place") <= F.col("open"))
    won = won.groupBy("key", "number").agg(F.count(F.lit(1)).alias("won"))
    quota = (F.col("least") + F.coalesce("won", F.lit(0))).cast("long")
    return spread.join(won, ["key", "number"], "left").select(*rows.columns, "number", quota.alias("quota"))


def quotas(sources: DataFrame, block: int, passes: int, shards: int) -> DataFrame:
    """Add ``quota``, the blocks of the mix, and ``by_shard``, those in the first 1, 2, ... shards, to the sources.

    ``sources`` is (key, size, target). No source gives more blocks than all
    its passes have: the seats it cannot fill are dealt among the others.
    """
    most = F.when(F.col("target") > 0, passes * F.ceil(F.col("size") / block)).otherwise(0).cast("long")
    rows = stage(sources.withColumns({"most": most, "settled": F.lit(None).cast("long")}), "sources")
    wanted, there = rows.agg(F.sum("target"), F.sum("most")).first()
    house = min(round((wanted or 0.0) / block), there or 0)
    while True:
        settled, still = rows.where("settled IS NOT NULL"), rows.where("settled IS NULL")
        seats = house - (settled.agg(F.sum("settled")).first()[0] or 0)
        dealt = stage(apportion(still, [seats], "target").drop("number"), "quotas")
        if dealt.where("quota > most").isEmpty():
            break
        full = dealt.withColumn("settled", F.when(F.col("quota") >= F.col("most"), F.col("most"))).drop("quota")
        rows = stage(settled.unionByName(full), "sources")
    dealt = dealt.unionByName(settled.withColumn("quota", F.col("settled"))).drop("most", "settled")
    # the quotas themselves, dealt out: the last house has them all
    houses = [house * (shard + 1) // shards for shard in range(shards)]
    seats = apportion(dealt.select("key", F.col("quota").cast("double").alias("blocks")), houses, "blocks")
    by_shard = seats.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("number", "quota")))["quota"].alias("by_shard"))
    return dealt.join(by_shard, "key")


def permuted(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """A permutation of 0 to ``count`` - 1, chosen by ``key``, at ``numbers``: a balanced cipher, repeated until inside."""
    half = np.uint64(max(1, (int(count - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    found = numbers.astype(np.uint64)
    outside = np.arange(len(found))
    while len(outside):
        left, right = found[outside] >> half, found[outside] & mask
        for number in range(ROUNDS):
            left, right = right, left ^ (_scrambled(right, key + number) & mask)
        found[outside] = (left << half) | right
        outside = outside[found[outside] >= count]
    return found.astype(np.int64)


def _scrambled(numbers: np.ndarray, key: int) -> np.ndarray:
    """64 well mixed bits of each number."""
    mixed = (numbers ^ np.uint64(key & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def pieces_of(
    place: np.ndarray, size: np.ndarray, line: int, quota: int, by_shard: np.ndarray, block: int, key: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row, [shard, seat, begin, end]) of what a mix takes of documents at ``place`` on a line of ``line`` words."""
    first = place // block
    blocks = np.where(size > 0, (place + size - 1) // block - first + 1, 0)
    row = np.repeat(np.arange(len(place)), blocks)
    number = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks) + first[row]
    whole, in_pass = line // block, -(-line // block)
    rank = np.full(len(number), whole, dtype=np.int64)
    full = number < whole
    rank[full] = permuted(number[full], whole, key)
    times = np.maximum(quota - rank + in_pass - 1, 0) // max(in_pass, 1)
    begin = np.maximum(number * block - place[row], 0)
    end = np.minimum((number + 1) * block - place[row], size[row])
    pick = np.repeat(np.arange(len(row)), times)
    again = np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
    seat = rank[pick] + again * in_pass
    return row[pick], [np.searchsorted(by_shard, seat, "right"), seat, begin[pick], end[pick]]


SLICE_WORDS = 1 << 22  # whose pieces are made at once; one longer document is a slice alone


def _pieces(schema: pa.Schema, block: int, seed: int):
    """Task over documents with their places: the pieces of each."""

    def of_slice(rows: pa.RecordBatch) -> pa.RecordBatch:
        place, size, line, quota = (rows.column(n).to_numpy() for n in ("place", "size", "source_size", "quota"))
        coded = rows.column("key").dictionary_encode()
        codes = coded.indices.to_numpy()
        owners, parts = [], []
        for code, key in enumerate(coded.dictionary.to_pylist()):
            own = np.flatnonzero(codes == code)
            by_shard = rows.column("by_shard")[int(own[0])].values.to_numpy()
            number = xxhash.xxh64_intdigest(key, seed)
            owner, part = pieces_of(place[own], size[own], int(line[own[0]]), int(quota[own[0]]), by_shard, block, number)
            owners.append(own[owner])
            parts.append(part)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(rows.num_rows + 1))
        columns = [pa.array(np.concatenate(c)[order]) for c in zip(*parts, strict=True)]
        fields = schema.field("pieces").type.value_type
        columns = [c.cast(f.type) for c, f in zip(columns, fields, strict=True)]
        pieces = pa.StructArray.from_arrays(columns, fields=list(fields))
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pieces)
        kept = [rows.column(n) for n in ("kept", "size", "source_size", "target")]
        return pa.record_batch([*kept, lists.cast(schema.field("pieces").type)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                size = batch.column("size").to_numpy()
                begins = np.flatnonzero(np.diff((np.cumsum(size) - size) // SLICE_WORDS, prepend=-1))
                for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                    yield of_slice(batch.slice(begin, end - begin))

    return run


def mix(
    documents: DataFrame,
    weights: DataFrame,
    share: float = 1.5,
    passes: int = 2,
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: int = SEED,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """All columns but the text, and ``size``, ``source_size``, ``target`` and ``pieces`` of every document.

    The size is in words. ``pieces`` are what the mix takes of the document, an
    empty list for nothing: words ``begin`` to before ``end``, once for each
    time, with the shard and the seat of the block among those of its source.
    A source's pieces come within two blocks of its target.

    ``weights`` is (source, weight); null is a source like others, and one
    without a weight gives nothing. A null or empty text has the size 0. The
    order of documents depends on the seed, the id and the text alone, so a
    rerun gives the same pieces, whatever the partitions; rows of equal id and
    text change places at most with each other. Older columns named like a new
    one are replaced.
    """
    made = {text_column.lower(), "size", "source_size", "target", "pieces"}
    kept = [c for c in documents.columns if c.lower() not in made]
    text = F.col(f"`{text_column}`").cast("string")
    hashed = F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), text)

    def key_of(column: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))

    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("kept"),
        key_of(source_column).alias("key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hashed.alias("hash"),
        F.shiftrightunsigned(hashed, 64 - RANGE_BITS).alias("range"),
    )
    rows = stage(rows, "sizes")
    sums = stage(rows.groupBy("key", "range").agg(F.sum("size").alias("size")), "sums")
    given = weights.select(key_of("source").alias("key"), F.col("weight").cast("double")).groupBy("key").agg(F.max("weight").alias("weight"))
    sources = sums.groupBy("key").agg(F.sum("size").alias("size")).join(given, "key", "left")
    sources = targets(stage(sources, "sources"), share, passes).select("key", "size", "target")
    sources = stage(quotas(sources, block, passes, shards).withColumnRenamed("size", "source_size"), "mix")

    def before(window) -> Column:
        return F.coalesce(F.sum("size").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    ranges = sums.select("key", "range", before(W.partitionBy("key").orderBy("range")).alias("range_place"))
    line = rows.withColumn("place", before(W.partitionBy("key", "range").orderBy("hash", "size")))
    line = line.join(ranges, ["key", "range"]).withColumn("place", F.col("place") + F.col("range_place"))
    line = line.join(sources, "key").select(
        "kept", "size", "source_size", "target", "place", "key", "quota", "by_shard"
    )
    schema = StructType([*line.schema.fields[:4], StructField("pieces", PIECES)])
    taken = line.mapInArrow(tidy(_pieces(arrow_schema(schema), block, seed)), schema)
    return taken.select(*[F.col("kept")[c].alias(c) for c in kept], "size", "source_size", "target", "pieces")


def words_taken(pieces: Column | str = "pieces") -> Column:
    """How many words the pieces have, repeats counted."""
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda total, piece: total + piece["end"] - piece["begin"])
