"""Benchmark decontamination by spaced-seed hashing.

A seed is a hash of some tokens of a short stretch; a fixed mask says which
positions count and which are ignored, so a seed survives substitutions at the
ignored ones. The masks below are lossless for their purpose: any 20 aligned
tokens with at least 16 equal ones share a seed of some mask, and so do shorter
items of at least 8 tokens if four fifths are equal (a test goes through all
patterns of substitutions). A long run of equal tokens counts as well, and holds
every mask. Items of 5 to 7 tokens have to occur whole.

Documents emit only seeds that may occur in the benchmark, told by a Bloom
filter of fixed size, and the tokens around them. These seeds are joined with those of the
benchmark, and every alignment that a shared seed proposes is verified on the
tokens themselves. What is shuffled grows with the overlaps, not with the corpus.

A phrase that many items share would propose every document that holds it for every
one of them. Its seeds are hot, and for them a proposal needs more evidence: of the
tokens around the seed some are what many items have at that distance, but not
enough of them for an overlap, so an overlap has a certain number of others in
common too. Those are joined, by seed, distance and token, each of which few items
have, and counted. Where the shared tokens alone make an overlap, all items do
overlap, and the seed is joined as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.llm.common import arrow_schema, letter_words, text_slices, tidy, unused_name, word_hashes
from clearbook.sources.staging import stage

MASKS = ("1101111", "1100010111", "1111011")
SHORT_MASKS = ("111011", "1101011", "1110011")  # further ones for items shorter than the window
WINDOW = 20  # aligned tokens that are compared, or all of a shorter item
SHARE = 0.8  # of them that have to be equal
RUN = 13  # equal tokens in a row that count whatever stands around them
MIN_SPACED = 8  # shorter items have to occur whole
MIN_ITEM = 5  # shorter ones are found in ordinary prose and are not looked for

SLOT_BITS = 24  # the bitmap of benchmark seeds has 2 ** SLOT_BITS bits (2 MB), whatever the benchmark
PROBES = 2  # bits that a seed sets and is looked up by

HOT = 16  # a seed, or a token at some distance from it, is common in the benchmark if more places have it

_HITS = "key long, region int, start int, tokens binary, hits array<struct<pos:int,seed:long>>"
_SEEDS = "item long, place int, span int, seed long"
_CHECKED = "key long, item long, begin int, size int, equal int"


def all_masks(lengths: list[int]) -> list[str]:
    """The masks that items of these lengths need; contiguous ones stand for whole items of their length."""
    short = SHORT_MASKS if any(MIN_SPACED <= n < WINDOW for n in lengths) else ()
    return [*MASKS, *short, *("1" * n for n in sorted(set(lengths)) if MIN_ITEM <= n < MIN_SPACED)]


def _uses(mask: str, counts: np.ndarray) -> np.ndarray:
    """Which items, by their number of tokens, have seeds of a mask."""
    if "0" not in mask:
        return counts == len(mask)
    return (counts >= MIN_SPACED) & ((counts < WINDOW) | (mask in MASKS))


def _factors(mask: str, number: int) -> list[tuple[int, np.uint64]]:
    """(offset, odd factor) of the positions that count."""
    rng = np.random.Generator(np.random.PCG64(1000 * number + len(mask)))
    return [(at, rng.integers(0, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) for at, c in enumerate(mask) if c == "1"]


def seeds_of(hashes: np.ndarray, rows: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, seed) at every place where the mask fits into one text."""
    span = len(mask)
    if len(hashes) < span:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    last = len(hashes) - span + 1
    fits = np.flatnonzero(rows[:last] == rows[span - 1 :])
    total = np.zeros(last, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at, factor in _factors(mask, number):
            total += hashes[at : at + last] * factor
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return fits, total[fits]


def _item_rows(masks: list[str] | None):
    """Task over (item, text): the tokens of each item; with masks also its seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = letter_words(part.column("text"))
                hashes, rows, counts = word_hashes(words), words.rows(), words.counts()
                items = part.column("item")
                if masks is None:
                    tokens = [hashes[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                    yield pa.record_batch(
                        [items, pa.array(counts.astype(np.int32)), pa.array(tokens, pa.binary())],
                        names=["item", "size", "tokens"],
                    )
                    continue
                for number, mask in enumerate(masks):
                    at, seeds = seeds_of(hashes, rows, mask, number)
                    used = _uses(mask, counts[rows[at]])
                    at, seeds = at[used], seeds[used]
                    yield pa.record_batch(
                        [
                            items.take(pa.array(rows[at])),
                            pa.array((at - words.first[rows[at]]).astype(np.int32)),
                            pa.array(np.full(len(at), len(mask), dtype=np.int32)),
                            pa.array(seeds.view(np.int64)),
                        ],
                        names=["item", "place", "span", "seed"],
                    )

    return run


def _document_rows(masks: list[str], bitmap: bytes):
    """Task over (key, text): for each text the stretches around seeds that may be in the benchmark."""
    reach = WINDOW - 1
    schema = arrow_schema(_HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = letter_words(part.column("text"))
                hashes, rows = word_hashes(words), words.rows()
                found, spans, seeds = [], [], []
                for number, mask in enumerate(masks):
                    at, seed = seeds_of(hashes, rows, mask, number)
                    for probe in range(PROBES):
                        may = there[(seed << np.uint64(SLOT_BITS * probe)) >> np.uint64(64 - SLOT_BITS)]
                        at, seed = at[may], seed[may]
                    found.append(at)
                    spans.append(np.full(len(at), len(mask)))
                    seeds.append(seed)
                at, span, seed = np.concatenate(found), np.concatenate(spans), np.concatenate(seeds)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, span, seed = at[order], span[order], seed[order]
                begin = np.maximum(at - reach, words.first[rows[at]])
                end = np.minimum(at + span + reach, words.first[rows[at] + 1])
                # stretches that overlap are one region; none reaches into the next text
                furthest = np.maximum.accumulate(end)
                opens = np.concatenate([[True], begin[1:] >= furthest[:-1]])
                firsts = np.flatnonzero(opens)
                keys = part.column("key")
                rows_out = {"key": [], "region": [], "start": [], "tokens": [], "hits": []}
                for number, (a, b) in enumerate(zip(firsts, [*firsts[1:], len(at)], strict=True)):
                    row, left = rows[at[a]], begin[a]
                    rows_out["key"].append(keys[int(row)].as_py())
                    rows_out["region"].append(number)
                    rows_out["start"].append(int(left - words.first[row]))
                    rows_out["tokens"].append(hashes[left : furthest[b - 1]].tobytes())
                    hits = zip((at[a:b] - words.first[row]).tolist(), seed[a:b].view(np.int64).tolist(), strict=True)
                    rows_out["hits"].append([{"pos": p, "seed": s} for p, s in hits])
                yield pa.RecordBatch.from_pydict(rows_out, schema=schema)

    return run


def best_overlap(text: np.ndarray, item: np.ndarray, offset: int) -> tuple[int, int, int] | None:
    """(equal tokens, first text token, size) of the overlap, the item's token 0 at text token ``offset``; None if none.

    It is the window with most equal tokens, if these are enough; else the longest run of equal ones, if that is.
    """
    size = min(WINDOW, len(item))
    low, high = max(0, offset), min(len(text), offset + len(item))
    if high - low < min(size, RUN):
        return None
    same = text[low:high] == item[low - offset : high - offset]
    equal = np.concatenate([[0], np.cumsum(same)])
    if high - low >= size:
        sums = equal[size:] - equal[:-size]
        best = int(sums.argmax())
        if sums[best] >= needed(size):
            return int(sums[best]), low + best, size
    unequal = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
    longest = int(np.diff(unequal).argmax())
    run = int(unequal[longest + 1] - unequal[longest]) - 1
    return (run, low + int(unequal[longest]) + 1, run) if run >= RUN else None


def needed(size: int) -> int:
    """Equal tokens that an overlap of this window size needs."""
    return size if size < MIN_SPACED else int(np.ceil(SHARE * size))


def _verifier():
    """Task over proposed alignments: those that hold."""
    schema = arrow_schema(_CHECKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                text, item = (np.frombuffer(x[c], dtype=np.uint64) for c in ("tokens", "item_tokens"))
                found = best_overlap(text, item, x["offset"] - x["start"])
                if found is not None:
                    equal, at, size = found
                    kept = {"key": x["key"], "item": x["item"]}
                    rows.append(kept | {"begin": x["start"] + at, "size": size, "equal": equal})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _slots(seeds: DataFrame) -> bytes:
    """A Bloom filter of all seeds, put together from at most 2 ** (SLOT_BITS - 15) pieces."""
    slots = [
        F.shiftrightunsigned(F.shiftleft("seed", SLOT_BITS * probe), 64 - SLOT_BITS) for probe in range(PROBES)
    ]
    pieces = (
        seeds.select(F.explode(F.array(*slots)).alias("slot"))
        .groupBy(F.shiftright("slot", 15).cast("int").alias("piece"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("bits"))
        .collect()
    )
    bitmap = bytearray(1 << (SLOT_BITS - 3))
    for piece, bits in pieces:
        bitmap[piece * 4096 : (piece + 1) * 4096] = bits
    return bytes(bitmap)


def overlaps(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, digest, item_id, begin, size, equal): every document and benchmark item that overlap, once.

    They overlap if at some alignment 20 tokens in a row, or all of a shorter
    item, have at least four fifths equal ones, or 13 in a row are equal; an item
    of 5 to 7 tokens has to occur whole, and shorter ones are not looked for.
    ``begin`` is the first token of the best such window or run in the document,
    ``size`` its length, ``digest`` the hash of the document's text. Tokens are lower-case runs of letters and digits. Items with equal
    tokens are one class under their smallest id; all texts of an id that repeats
    are looked for, and those of null ids. Null or empty texts overlap with
    nothing; null ids are carried along as they are.
    """
    # an item is known by its number among the classes: ids may repeat or be null
    named = benchmark.select(
        F.struct(
            F.col(f"`{item_column}`").cast("long").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text")
        ).alias("item"),
        F.col(f"`{item_text}`").cast("string").alias("text"),
    )
    tokens = "item struct<id:long,text:string>, size int, tokens binary"
    classes = stage(
        named.mapInArrow(tidy(_item_rows(None)), tokens)
        .where(F.col("size") >= MIN_ITEM)
        .groupBy("tokens", "size")
        .agg(F.min("item.id").alias("item_id"), F.min("item.text").alias("text"))
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    lengths = [row[0] for row in classes.where(F.col("size") < WINDOW).select("size").distinct().collect()]
    masks = all_masks(lengths)  # nine at most
    seeds = stage(classes.select("item", "text").mapInArrow(tidy(_item_rows(masks)), _SEEDS), "seeds")

    docs = documents.select(
        F.monotonically_increasing_id().alias("key"),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    found = _with_ids(docs, masks, _slots(seeds))
    regions = stage(found, "regions")
    checked = (
        proposals(regions, seeds, classes).join(regions.select("key", "region", "start", "tokens"), ["key", "region"])
        .join(classes.select("item", F.col("tokens").alias("item_tokens")), "item")
        .select("key", "item", "offset", "start", "tokens", "item_tokens")
        .mapInArrow(tidy(_verifier()), _CHECKED)
        .groupBy("key", "item")
        .agg(F.min_by(F.struct("begin", "size", "equal"), F.struct(-F.col("equal") / F.col("size"), "begin")).alias("best"))
    )
    ids = regions.select("key", "id", "digest").dropDuplicates(["key"])
    # two classes of one id are one item, with the better of their overlaps
    best = F.min_by("best", F.struct(-F.col("best.equal") / F.col("best.size"), "best.begin"))
    named_best = (
        checked.join(classes.select("item", "item_id"), "item").groupBy("key", "item_id").agg(best.alias("best"))
    )
    return named_best.join(ids, "key").select("id", "digest", "item_id", "best.*")


def proposals(regions: DataFrame, seeds: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, region, item, offset): the alignments that seeds propose, those of hot seeds if there is evidence beside them."""
    hits = regions.select("key", "region", F.inline("hits")).withColumnRenamed("pos", "at")
    alignment = ["key", "region", "item", (F.col("at") - F.col("place")).alias("offset")]
    hot = stage(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("seed"), "hot")
    if hot.isEmpty():
        return hits.join(seeds, "seed").select(alignment).distinct()

    # of every place of a hot seed the tokens around it, and which of them are common there
    places = seeds.join(hot, "seed").join(classes.select("item", "size", "tokens"), "item")
    around = stage(
        places.mapInArrow(tidy(_around(["seed", "item", "place", "span", "size"])), f"{_PLACE}, distance int, token long"), "around"
    )
    common = around.groupBy("seed", "distance", "token").agg((F.count(F.lit(1)) > HOT).alias("common"))
    marked = stage(around.join(common, ["seed", "distance", "token"]), "marked")
    shared = F.collect_list(F.when(F.col("common"), F.col("distance")))
    needs = stage(
        seeds.join(hot, "seed")
        .join(classes.select("item", "size"), "item")
        .join(marked.groupBy("seed", "item", "place").agg(shared.alias("shared")), ["seed", "item", "place"], "left")
        .select("seed", "item", "place", "span", "size", F.coalesce("shared", F.array().cast("array<int>")).alias("shared"))
        .mapInArrow(tidy(_further), "seed long, item long, place int, further int"),
        "further",
    )
    rest = seeds.join(hot, "seed", "left_anti").select("seed", "item", "place")
    alone = rest.unionByName(needs.where("further <= 0").select("seed", "item", "place"))
    rare = marked.where("NOT common").join(needs.where("further > 0"), ["seed", "item", "place"])

    found = hits.join(hot, "seed").join(regions.select("key", "region", "start", "tokens"), ["key", "region"])
    found = found.withColumn("place", F.col("at") - F.col("start"))
    beside = found.mapInArrow(tidy(_around(["seed", "key", "region", "at"])), f"{_FOUND}, distance int, token long")
    evident = (
        beside.join(rare, ["seed", "distance", "token"])
        .groupBy("seed", "key", "region", "at", "item", "place")
        .agg(F.count(F.lit(1)).alias("n"), F.first("further").alias("further"))
        .where("n >= further")
    )
    return hits.join(alone, "seed").select(alignment).unionByName(evident.select(alignment)).distinct()


_PLACE = "seed long, item long, place int, span int, size int"
_FOUND = "seed long, key long, region int, at int"


def _around(kept: list[str]):
    """Task over (tokens, place, ...): the tokens before and behind a place, a row for each, with their distances.

    Distances within a seed are left out where its span is known; elsewhere they find no partner.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = max(len(mask) for mask in (*MASKS, *SHORT_MASKS))
        for batch in batches:
            spans = batch.column("span").to_pylist() if "span" in kept else [0] * batch.num_rows
            owners, distances, found = [], [], []
            columns = zip(batch.column("tokens").to_pylist(), batch.column("place").to_pylist(), spans, strict=True)
            for row, (raw, place, span) in enumerate(columns):
                tokens = np.frombuffer(raw, dtype=np.int64)
                distance = np.arange(max(0, place - WINDOW + 1), min(len(tokens), place + longest + WINDOW)) - place
                distance = distance[(distance < 0) | (distance >= span)]
                owners.append(np.full(len(distance), row))
                distances.append(distance)
                found.append(tokens[distance + place])
            if owners:
                at = pa.array(np.concatenate(owners))
                made = [pa.array(np.concatenate(distances).astype(np.int32)), pa.array(np.concatenate(found))]
                yield pa.record_batch([*(batch.column(c).take(at) for c in kept), *made], names=[*kept, "distance", "token"])

    return run


def _further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over places with the distances of their common tokens: how many other tokens an overlap has in common at least."""
    for batch in batches:
        least = []
        for x in batch.select(["place", "span", "size", "shared"]).to_pylist():
            common = np.zeros(x["size"], dtype=np.int64)
            common[x["place"] : x["place"] + x["span"]] = 1  # those that a mask ignores may be equal as well
            common[[x["place"] + distance for distance in x["shared"]]] = 1
            before = np.concatenate([[0], np.cumsum(common)])
            window = min(WINDOW, x["size"])
            kinds = [(window, needed(window)), *([(RUN, RUN)] if x["size"] >= RUN else [])]
            lacking = []
            for size, enough in kinds:
                # windows that hold the seed
                first = np.arange(max(0, x["place"] + x["span"] - size), min(x["place"], x["size"] - size) + 1)
                lacking.extend((enough - (before[first + size] - before[first])).tolist())
            least.append(min(lacking, default=0))
        kept = [batch.column(c) for c in ("seed", "item", "place")]
        yield pa.record_batch([*kept, pa.array(least, pa.int32())], names=["seed", "item", "place", "further"])


def _with_ids(docs: DataFrame, masks: list[str], bitmap: bytes) -> DataFrame:
    """The regions of documents with id and text hash beside the key."""
    schema = docs.schema["id"].dataType.simpleString()
    inner = _document_rows(masks, bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            order = np.argsort(keys)
            for rows in inner(iter([batch])):
                at = pa.array(order[np.searchsorted(keys, rows.column("key").to_numpy(zero_copy_only=False), sorter=order)])
                extra = [batch.column("id").take(at), batch.column("digest").take(at)]
                yield pa.record_batch([*rows.columns, *extra], names=[*rows.schema.names, "id", "digest"])

    return docs.withColumn("digest", F.xxhash64("text")).mapInArrow(tidy(run), f"{_HITS}, id {schema}, digest long")


def contaminated(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **columns: str) -> DataFrame:
    """One row per contaminated document: its best item, where the overlap begins and how many items overlap.

    Rows that repeat an id and a text are one document. Clean documents have no row.
    """
    best = F.min_by(
        F.struct("item_id", "begin", "size", "equal"), F.struct(-F.col("equal") / F.col("size"), "item_id")
    )
    return (
        overlaps(documents, benchmark, id_column, **columns)
        .groupBy("id", "digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n_items"))
        .select(F.col("id").alias(id_column), "digest", "best.*", "n_items")
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that overlap with no benchmark item, all columns as they are."""
    bad_id, bad_digest = (unused_name(name, documents.columns) for name in ("_bad_id", "_bad_digest"))
    bad = contaminated(documents, benchmark, id_column, text_column=text_column).select(
        F.col(f"`{id_column}`").alias(bad_id), F.col("digest").alias(bad_digest)
    )
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(bad_id)) & (
        F.xxhash64(F.col(f"`{text_column}`").cast("string")) == F.col(bad_digest)
    )
    return documents.join(stage(bad, "contaminated"), same, "left_anti")
