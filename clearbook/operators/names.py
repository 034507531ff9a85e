"""Clustering of free-text company names without a list of the true names."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.functions.text import collapse_spaces, has_text, name_key
from clearbook.operators.numbering import numbered
from clearbook.sources.staging import stage

# Shorter keys are codes as often as names; one edit makes another of them.
MIN_FUZZY_LENGTH = 6

# A typo is rare next to its head: a key joins a neighbour that has at least so many times its rows.
RATIO = 3.0

# Keys that are linked over several steps are one name if the last one has at least this share of their rows.
HEAD_SHARE = 0.5

KEYS_OF_A_TASK = 2_000  # at least, unless there are fewer in all

_CHUNK = 1 << 20  # characters, or pairs of them, that a task works on at once

_PARTS = "rank long, high long, low long, kind int, at long, then long"

# What a part is: the whole key, the key without one or two of its characters (at the places ``at`` and ``then``), and
# once more the key without two, for a neighbour without one: ``at`` is where that one stood after the other was gone.
_WHOLE, _WITHOUT_ONE, _WITHOUT_TWO, _LONGER = range(4)


def _mixed(codes: np.ndarray, salt: int) -> np.ndarray:
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rests:
    """Hashes of keys, and of keys without one or two of their characters, each in constant time.

    A hash is a polynomial in the places of the characters. Left out of a key, a
    character takes its own term away and moves those behind it one place down.
    """

    def __init__(self, codes: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, distance: int) -> None:
        self.first, self.last = firsts, firsts + lengths
        self.sums = []  # for each of two hashes the running sums of the terms, 0, 1, ... places further down
        place = np.arange(len(codes)) - np.repeat(firsts, lengths)
        for salt, base in ((0x1234567, 0xD6E8FEB86659FD93), (0x89ABCDE, 0xA0761D6478BD642F)):
            with np.errstate(over="ignore"):
                values = _mixed(codes, salt)
                powers = np.full(int(lengths.max(initial=0)) + 1, base, dtype=np.uint64)
                powers[:1] = 1
                np.multiply.accumulate(powers, out=powers)
                terms = [
                    np.where(place >= down, values * powers[np.maximum(place - down, 0)], np.uint64(0))
                    for down in range(distance + 1)
                ]
                zero = np.zeros(1, dtype=np.uint64)
                self.sums.append([np.concatenate([zero, np.cumsum(t, dtype=np.uint64)]) for t in terms])

    def without(self, owner: np.ndarray, *lost: np.ndarray) -> np.ndarray:
        """Two hashes of the keys ``owner`` without the characters at the ascending positions ``lost``."""
        found = np.zeros((2, len(owner)), dtype=np.uint64)
        for hashes, sums in zip(found, self.sums, strict=True):
            with np.errstate(over="ignore"):
                begin = self.first[owner]
                for down, end in enumerate([*lost, self.last[owner]]):
                    hashes += sums[down][end] - sums[down][begin]
                    begin = end + 1
        return found.view(np.int64)


def _parts(distance: int):
    """Task over (rank, key): the parts of each key. Digits are never left out."""

    def of_rows(rows: pa.RecordBatch, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes = np.frombuffer("".join(rows.column("key").to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        firsts = np.cumsum(lengths) - lengths
        rests = _Rests(codes, firsts, lengths, distance)
        ranks = rows.column("rank").to_numpy()

        def part(kind: int, owner: np.ndarray, hashes: np.ndarray, at: np.ndarray, then: np.ndarray) -> pa.RecordBatch:
            kinds = np.full(len(owner), kind, dtype=np.int32)
            columns = [ranks[owner], *hashes, kinds, at, then]
            return pa.record_batch([pa.array(c) for c in columns], names=["rank", "high", "low", "kind", "at", "then"])

        every = np.arange(len(lengths))
        nowhere = np.full(len(lengths), -1)
        yield part(_WHOLE, every, rests.without(every), nowhere, nowhere)
        cut = np.flatnonzero((codes < ord("0")) | (codes > ord("9")))
        owner = np.repeat(every, lengths)[cut]
        place = cut - firsts[owner]
        yield part(_WITHOUT_ONE, owner, rests.without(owner, cut), place, np.full(len(cut), -1))
        if distance < 2 or not len(cut):
            return
        later = np.searchsorted(owner, owner, "right") - np.arange(len(cut)) - 1
        bounds = np.flatnonzero(np.diff((np.cumsum(later) - later) // _CHUNK, prepend=-1))
        for begin, end in zip(bounds, [*bounds[1:], len(cut)], strict=True):
            one = np.repeat(np.arange(begin, end), later[begin:end])
            two = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(later[begin:end]) - later[begin:end], later[begin:end])
            hashes = rests.without(owner[one], cut[one], cut[two])
            nothing = np.full(len(one), -1)
            yield part(_WITHOUT_TWO, owner[one], hashes, place[one], place[two])
            yield part(_LONGER, owner[one], hashes, place[one], nothing)
            apart = place[two] - 1 > place[one]  # else it is the same once more
            yield part(_LONGER, owner[one][apart], hashes[:, apart], place[two][apart] - 1, nothing[apart])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.utf8_length(batch.column("key")).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(sizes) - sizes
            begins = np.flatnonzero(np.diff(before // _CHUNK, prepend=-1))
            for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                yield from of_rows(batch.slice(begin, end - begin), sizes[begin:end])

    return run


def _spread(keys: DataFrame) -> DataFrame:
    """The keys dealt to tasks by their number: a key is small next to its parts, so files of keys make too few tasks."""
    most = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartition(max(1, min(most, keys.count() // KEYS_OF_A_TASK)), "rank")


def _best_neighbours(ranked: DataFrame, distance: int) -> DataFrame:
    """(rank, best): the smallest rank among the keys within ``distance`` edits, its own included.

    Two keys are one edit apart iff leaving out the character at the same place
    gives the same rest (a substitution), or leaving one out of the one gives
    the other. They are two apart iff the rests without two at the same places
    are equal; without two of the one and one of the other, at the same place
    once the other character is gone; without one each, wherever; or if the one
    without two is the other. So each group of equal rests is reduced to the
    best member of each kind, and pairs are never listed. A group has as many
    keys as there are ways to put the characters back.
    """
    parts = _spread(ranked.select("rank", "key")).mapInArrow(_parts(distance), _PARTS)
    # sorted once, as the finest of the windows needs it, which does for the others
    parts = parts.repartition("high", "low").sortWithinPartitions("high", "low", "at", "then")
    rank, kind = F.col("rank"), F.col("kind")
    same_rest = W.partitionBy("high", "low")
    same_place = W.partitionBy("high", "low", "at")
    same_places = W.partitionBy("high", "low", "at", "then")

    def best(which: int, group) -> Column:
        return F.min(F.when(kind == which, rank)).over(group)

    if distance == 1:
        near = {
            _WHOLE: [best(_WITHOUT_ONE, same_rest)],
            _WITHOUT_ONE: [best(_WHOLE, same_rest), best(_WITHOUT_ONE, same_place)],
        }
    else:
        near = {
            _WHOLE: [best(_WITHOUT_ONE, same_rest), best(_WITHOUT_TWO, same_rest)],
            _WITHOUT_ONE: [best(_WHOLE, same_rest), best(_WITHOUT_ONE, same_rest), best(_LONGER, same_place)],
            _WITHOUT_TWO: [best(_WHOLE, same_rest), best(_WITHOUT_TWO, same_places)],
            _LONGER: [best(_WITHOUT_ONE, same_place)],
        }
    candidate = functools.reduce(
        lambda found, which: found.when(kind == which, F.least(rank, *near[which])), near, F.when(F.lit(False), rank)
    )
    return parts.select("rank", candidate.alias("best")).groupBy("rank").agg(F.min("best").alias("best"))


def nearest_names(
    keys: DataFrame,
    min_length: int = MIN_FUZZY_LENGTH,
    ratio: float = RATIO,
    distance: int = 1,
    chains: bool = False,
    head_share: float = HEAD_SHARE,
) -> DataFrame:
    """(key, parent): the head of each key, which is the key itself or a far more frequent one near by.

    ``keys`` is (key, n) and optionally ``known``. Only keys of ``min_length``
    characters and more take part, and digits are never edited. A key looks at its
    best neighbour within ``distance`` edits (1 or 2) - known ones first, then the
    most frequent, then in key order - and wishes to join it if that is known or
    has at least ``ratio`` times its rows. Known keys stay as they are.

    Without ``chains`` a wish is granted if the neighbour is a head itself, so
    nothing is merged over more than ``distance`` edits. With ``chains`` wishes
    are followed from key to key up to the last one, and the component is one
    name if that head is known or has at least ``head_share`` of all its rows;
    else its keys are merged as without chains.

    Rests of keys are compared by 128-bit hashes, so a row stays small however
    long the key, and a wish is verified by the edit distance. The parts of a key
    are as many as its characters, for two edits as many as their square.
    """
    if distance not in (1, 2):
        raise ValueError("Names are compared within one edit or two.")
    if "known" not in keys.columns:
        keys = keys.withColumn("known", F.lit(False))
    known = F.coalesce("known", F.lit(False))
    keys = keys.select("key", F.col("n").cast("long").alias("n"), known.alias("known"))
    ranked = stage(numbered(keys, [F.desc("known"), F.desc("n"), "key"], "rank"), "keys")
    best = _best_neighbours(ranked.where(F.length("key") >= min_length), distance).where("best <> rank")

    mine = ranked.where("NOT known").select("rank", "key", "n").join(best, "rank")
    theirs = ranked.select(F.col("rank").alias("best"), *[F.col(c).alias(f"best_{c}") for c in ("key", "n", "known")])
    far_better = F.col("best_known") | (F.col("best_n") >= F.col("n") * ratio)
    # other texts of one hash are told apart; a threshold of 0 or more makes the distance -1 beyond it
    near = F.levenshtein("key", "best_key", distance) >= 0
    wishes = mine.join(theirs, "best").where(far_better & near).select("rank", F.col("best").alias("wish"))
    wished = stage(ranked.join(wishes, "rank", "left").select("rank", "key", "n", "known", "wish"), "wishes")
    heads = wished.where("wish IS NULL").select(F.col("rank").alias("wish"), F.col("key").alias("parent"))
    granted = wished.join(heads, "wish", "left")
    if not chains:
        return granted.select("key", F.coalesce("parent", "key").alias("parent"))

    roots = _roots(wished.select("rank", "wish"))
    rooted = stage(wished.join(roots, "rank"), "rooted")
    sizes = rooted.groupBy("root").agg(F.sum("n").alias("all_rows"))
    top = ranked.select(F.col("rank").alias("root"), F.col("key").alias("root_key"), F.col("n").alias("root_n"),
                        F.col("known").alias("root_known"))
    is_one = F.col("root_known") | (F.col("root_n") >= F.col("all_rows") * head_share)
    ends = sizes.join(top, "root").where(is_one).select("root", "root_key")
    followed = rooted.join(ends, "root", "left").select("rank", "root_key")
    parent = F.coalesce("root_key", "parent", "key")
    return granted.join(followed, "rank").select("key", parent.alias("parent"))


def _roots(wishes: DataFrame) -> DataFrame:
    """(rank, root): where following the wishes ends. Each round doubles how far every key has got.

    A wish leads to a smaller rank, so there are no circles, and as every wish
    needs ``ratio`` times the rows, chains are short.
    """
    reached = stage(wishes.select("rank", F.coalesce("wish", "rank").alias("root")), "roots")
    while True:
        further = reached.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        is_moved = (F.col("next") != F.col("root")).alias("moved")
        moved = stage(reached.join(further, "root").select("rank", F.col("next").alias("root"), is_moved), "roots")
        reached = moved.select("rank", "root")
        if moved.where("moved").isEmpty():
            return reached


def canonical_names(
    counts: DataFrame,
    known: DataFrame | None = None,
    min_length: int = MIN_FUZZY_LENGTH,
    ratio: float = RATIO,
    distance: int = 1,
    chains: bool = False,
    head_share: float = HEAD_SHARE,
) -> DataFrame:
    """Map every spelling to one name per company: (dirty, clean, n, merged_by).

    ``counts`` is (dirty, n), the distinct spellings with their frequency.
    Spellings with equal keys, and keys near a far more frequent key as
    ``nearest_names`` has it (within one edit, if not asked otherwise), are one
    company. Its name is the most frequent spelling of the head
    key, with white space collapsed. ``known`` (column ``clean``) holds names
    settled earlier: they are kept as they are and attract new spellings,
    however frequent those are. ``merged_by`` is ``same`` (the name itself),
    ``spelling`` (an equal key), ``edit`` (another key), or ``short`` where the
    key was too short to be compared and its spelling is the name.
    """
    counts = counts.where(has_text(F.col("dirty"))).select("dirty", F.col("n").cast("long").alias("n"))
    counts = counts.withColumn("is_known", F.lit(False))
    if known is not None:
        settled = known.select(F.col("clean").alias("dirty")).where(has_text(F.col("dirty"))).distinct()
        counts = counts.unionByName(settled.select("dirty", F.lit(0).cast("long").alias("n"), F.lit(True).alias("is_known")))
    spellings = stage(counts.withColumn("key", name_key(F.col("dirty"))), "spellings")
    keys = spellings.groupBy("key").agg(F.sum("n").alias("n"), F.bool_or("is_known").alias("known"))
    heads = stage(nearest_names(keys, min_length, ratio, distance, chains, head_share), "heads")

    name = collapse_spaces(F.col("dirty"))
    written = (
        spellings.groupBy("key", name.alias("clean"))
        .agg(F.sum("n").alias("n"), F.bool_or("is_known").alias("known"))
        .groupBy(F.col("key").alias("parent"))
        .agg(F.min_by("clean", F.struct(~F.col("known"), -F.col("n"), F.col("clean"))).alias("clean"))
    )
    named = heads.join(written, "parent")
    merged = (
        F.when(F.col("key") != F.col("parent"), "edit")
        .when(name != F.col("clean"), "spelling")
        .when(F.length("key") < min_length, "short")
        .otherwise("same")
    )
    rows = spellings.where("NOT is_known").join(named, "key")
    return rows.select("dirty", "clean", "n", merged.alias("merged_by"))
