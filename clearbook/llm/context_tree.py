"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions. A decision is made in the context of the bytes
before it, at every depth from none to DEPTH, and each context has a
Krichevsky-Trofimov estimate from its counts. The weighted probability of a
context is half its own estimate and half the product of those of the contexts
one byte longer; what a trained tree predicts is the mixture of the estimates
along the path, each with its posterior weight. The code length of a text is
minus the logarithm of its probability.

Training and scoring of a corpus are one set of passes:

1. Documents are dealt into blocks of some megabytes. For each block the distinct
   byte grams (DEPTH bytes and the next) and words are listed, with their counts in
   the training documents. A frequent gram has one row per block.
2. Counts of a gram are added over all blocks. Grams with the same last bytes make
   a subtree, of at most 2 ** 24 grams; subtrees are weighted where they stand, the
   few levels above them by aggregations, and every gram gets its probability.
3. Probabilities and word counts go back to the blocks that asked, as packed
   lists, and meet their texts, which add them up.

The texts follow a block's answers in a sorted stream, so memory is bounded by one
block. The model is never in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from clearbook.llm.common import LOWER, arrow_schema, pack, text_bytes, text_slices, tidy, unpack, words_in
from clearbook.sources.staging import stage

DEPTH = 5
SUBTREE = 2  # levels below the root of a subtree
BLOCK_BYTES = 32 << 20
SLICE = 2 << 20  # bytes of text that are worked on at once

AT_ONCE = 250_000  # grams that are weighted together, if their suffixes do not have more

EDGE = 0xFF  # stands before and behind every text; no byte of UTF-8

WORDS, GRAMS, TEXTS = 0, 1, 2

CHANGED = "The documents changed between two reads; write them to a table first."

_ASKED = "kind int, block long, place int, word binary, gram long, n long"
_ANSWER = "kind int, block long, payload binary, size int"


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series beyond a shift of eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of some zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log weighted probability, posterior weight of the own estimate, its probability of a one)."""
    own = kt(zeros, ones)
    weighted = np.logaddexp(own, below) - np.log(2)
    return weighted, 0.5 * np.exp(own - weighted), (ones + 0.5) / (zeros + ones + 1)


def grams_of(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram at every byte and behind the last one of each text, number of grams before each text and in all)."""
    data, offsets = text_bytes(texts)
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    pad = depth + 1
    padded = np.full(len(data) + pad * rows, EDGE, dtype=np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(rows) * pad + depth, lengths)
    padded[at] = LOWER[data]
    whole = np.zeros(len(padded) - depth if rows else 0, dtype=np.int64)
    for k in range(depth + 1):
        np.left_shift(whole, 8, out=whole)
        np.bitwise_or(whole, padded[k : k + len(whole)], out=whole)
    # windows that begin in the last places of a text reach into the next
    inside = np.ones(len(whole), dtype=bool)
    begins = offsets[1:-1] + pad * np.arange(1, rows)
    for k in range(1, depth + 1):
        inside[begins - k] = False
    return whole[inside], np.concatenate([[0], np.cumsum(lengths + 1)])


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each gram, the distinct ones in the order of their codes)."""
    coded = pa.array(grams).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False)


def _counted(grams: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct grams in order, how many of each are for training)."""
    keys = np.sort((grams << 1) | train)  # a gram has at most seven bytes
    begins = np.flatnonzero(np.diff(keys >> 1, prepend=-1))
    return keys[begins] >> 1, np.add.reduceat(keys & 1, begins) if len(begins) else begins


class _BlockWords:
    """The words of a block's slices, numbered in the order of their bytes; word 0, the empty one, is the end of a text.

    The numbers depend on the distinct words alone, so texts of a block that
    come in another order on the second read do no harm.
    """

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.firsts: list[np.ndarray] = []
        self.lists = [pa.array([b""], pa.large_binary())]

    def add(self, texts: pa.Array) -> None:
        data, offsets = text_bytes(texts)
        words = words_in(LOWER[data], offsets)
        codes, distinct = words.coded()
        self.codes.append(codes.astype(np.int32))
        self.firsts.append(words.first)
        self.lists.append(distinct)

    def numbered(self) -> tuple[pa.Array, list[np.ndarray]]:
        """(the distinct words, for each slice the number of each of its words)."""
        coded = pa.concat_arrays(self.lists).dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        places = rank[coded.indices.to_numpy(zero_copy_only=False)]
        before = np.cumsum([len(own) for own in self.lists])
        return coded.dictionary.take(order), [places[at:][codes] for at, codes in zip(before, self.codes, strict=False)]


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(block, number of the first row in the task, rows): consecutive rows, a new block after ``limit`` bytes."""
    part, number, size, rows_before = None, 0, 0, 0
    for batch in batches:
        for rows in text_slices(batch, "text", SLICE):
            if part is None:
                part = rows.column("part")[0].as_py()
            if size >= limit:
                number, size = number + 1, 0
            yield (part << 32) + number, rows_before, rows
            size += int(pc.fill_null(pc.sum(pc.binary_length(rows.column("text"))), 0).as_py())
            rows_before += rows.num_rows


def _list_blocks(depth: int, limit: int):
    """Task over documents: the distinct words and grams of each block, with their training counts."""
    schema = arrow_schema(_ASKED)

    def rows_of(
        block: int, words: _BlockWords, trains: list[np.ndarray], grams: list[tuple[np.ndarray, np.ndarray]]
    ) -> Iterator[pa.RecordBatch]:
        keys, numbers = words.numbered()
        keys = keys.cast(pa.binary())
        total = np.zeros(len(keys), dtype=np.int64)
        for own, first, train in zip(numbers, words.firsts, trains, strict=True):
            total += np.bincount(own[np.repeat(train, np.diff(first))], minlength=len(keys))
            total[0] += int(train.sum())
        found, number = (np.concatenate(part) for part in zip(*grams, strict=True))
        order = np.argsort(found)
        begins = np.flatnonzero(np.diff(found[order], prepend=-1))
        found, number = found[order][begins], np.add.reduceat(number[order], begins)
        nothing = np.zeros(len(found), dtype=np.int32)
        for kind, place, word, gram, n in (
            (WORDS, np.arange(len(keys), dtype=np.int32), keys, pa.nulls(len(keys), pa.int64()), total),
            (GRAMS, nothing, pa.nulls(len(found), pa.binary()), pa.array(found), number),
        ):
            for begin in range(0, len(n), 100_000):
                some = slice(begin, begin + 100_000)
                size = len(n[some])
                yield pa.record_batch(
                    [
                        pa.array(np.full(size, kind, dtype=np.int32)),
                        pa.array(np.full(size, block)),
                        pa.array(place[some]),
                        word[some],
                        gram[some],
                        pa.array(n[some]),
                    ],
                    schema=schema,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words, trains, grams = None, None, [], []
        for block, _, rows in _blocks(batches, limit):
            if block != last:
                if words:
                    yield from rows_of(last, words, trains, grams)
                last, words, trains, grams = block, _BlockWords(), [], []
            train = rows.column("train").to_numpy(zero_copy_only=False).astype(bool)
            words.add(rows.column("text"))
            trains.append(train)
            own, first = grams_of(rows.column("text"), depth)
            grams.append(_counted(own, np.repeat(train, np.diff(first))))
        if words:
            yield from rows_of(last, words, trains, grams)

    return run


class _Subtrees:
    """All nodes below some suffixes, by level; ``grams`` are distinct, with their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> None:
        byte, context = grams & 0xFF, grams >> 8
        bits = (byte[:, None] >> np.arange(7, -1, -1)) & 1
        nodes = (1 << np.arange(8)) | (byte[:, None] >> np.arange(8, 0, -1))
        keys, at = np.unique(((context[:, None] << 8) | nodes).ravel(), return_inverse=True)
        weights = np.repeat(counts, 8).astype(np.float64)
        ones = np.bincount(at, weights * bits.ravel(), len(keys))
        zeros = np.bincount(at, weights, len(keys)) - ones
        self.at, self.bits = at.reshape(-1, 8), bits
        self.leaf = (ones + 0.5) / (zeros + ones + 1)
        weighted = kt(zeros, ones)
        self.levels, path = [], np.arange(len(keys))
        for level in range(depth - 1, top - 1, -1):
            parents, up = np.unique(((keys >> 8 & (1 << 8 * level) - 1) << 8) | (keys & 0xFF), return_inverse=True)
            zeros, ones, below = (np.bincount(up, v, len(parents)) for v in (zeros, ones, weighted))
            weighted, own, probability = weigh(zeros, ones, below)
            path, keys = up[path], parents
            self.levels.append((path, own, probability))
        self.keys, self.zeros, self.ones, self.weighted, self.path = keys, zeros, ones, weighted, path

    def predicted(self, mass: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """log10 probability of every gram's last byte, given for each top node what the levels above put on a one
        and the weight they leave."""
        ones = self.leaf
        for path, own, probability in self.levels:
            ones = own[path] * probability[path] + (1 - own[path]) * ones
        ones = mass[self.path] + rest[self.path] * ones
        chosen = ones[self.at]
        return np.log10(np.where(self.bits == 1, chosen, 1 - chosen)).sum(axis=1)


def _by_suffix(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Rows sorted by the column ``suffix``, some whole suffixes at a time, at least AT_ONCE rows if there are."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if sum(len(h[0]) for h in held) > AT_ONCE and held[-1][0][-1] != columns[0][-1]:
            cut = int(np.searchsorted(columns[0], held[-1][0][-1], side="right"))
            held.append([c[:cut] for c in columns])
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held, columns = [], [c[cut:] for c in columns]
        if len(columns[0]):
            held.append(columns)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _upwards(depth: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, grams, counts in _by_suffix(batches, ["suffix", "gram", "n"]):
            tree = _Subtrees(grams, counts, depth, top)
            yield pa.record_batch(
                [pa.array(tree.keys), pa.array(tree.zeros), pa.array(tree.ones), pa.array(tree.weighted)],
                names=["key", "zeros", "ones", "weighted"],
            )

    return run


def _downwards(depth: int, top: int):
    """Task over grams and the answers from above, sorted by suffix: (gram, logp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["suffix", "kind", "gram", "n", "mass", "rest"]
        for _, kind, grams, counts, mass, rest in _by_suffix(batches, names):
            own = kind == GRAMS
            tree = _Subtrees(grams[own], counts[own], depth, top)
            order = np.argsort(grams[~own])
            above = order[np.searchsorted(grams[~own][order], tree.keys)]
            found = tree.predicted(mass[~own][above], rest[~own][above])
            yield pa.record_batch([pa.array(grams[own]), pa.array(found)], names=["gram", "logp"])

    return run


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over nodes with the sums of their children: weighted probability, own weight, probability of a one."""
    for batch in batches:
        zeros, ones, below = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("zeros", "ones", "below"))
        yield pa.record_batch(
            [batch.column("key"), batch.column("zeros"), batch.column("ones"), *map(pa.array, weigh(zeros, ones, below))],
            names=["key", "zeros", "ones", "weighted", "own", "probability"],
        )


def _suffix(key, levels: int):
    """The last ``levels`` context bytes of a key whose lowest byte is a symbol or node."""
    return F.shiftright(key, 8).bitwiseAND(F.lit((1 << 8 * levels) - 1))


def probabilities(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, logp): log10 of the probability of each gram's last byte after the others.

    ``counts`` is (gram, n) with distinct grams; those with a count of 0 are not
    learned from. Subtrees of the last ``depth - SUBTREE`` bytes are weighted by one
    task each; the levels above them are aggregated, most rows being added before
    they move.
    """
    top = max(0, depth - SUBTREE)
    counts = counts.withColumn("suffix", _suffix(F.col("gram"), top))
    node_type = "key long, zeros double, ones double, weighted double"
    nodes = stage(
        counts.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(tidy(_upwards(depth, top)), node_type), "nodes"
    )
    above = nodes.select("key", F.lit(0.0).alias("mass"), F.lit(1.0).alias("rest"))
    level, levels = nodes, []
    for size in range(top - 1, -1, -1):
        node = F.col("key").bitwiseAND(F.lit(0xFF))
        key = F.shiftleft(_suffix(F.col("key"), size), 8).bitwiseOR(node)
        summed = level.groupBy(key.alias("key")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
        )
        level = stage(summed.mapInArrow(tidy(_weighed), f"{node_type}, own double, probability double"), "nodes")
        levels.append((size, level))
    for size, level in reversed(levels):
        node = F.col("key").bitwiseAND(F.lit(0xFF))
        up = F.shiftleft(_suffix(F.col("key"), size), 8).bitwiseOR(node)
        joined = above.withColumn("up", up).join(level.select(F.col("key").alias("up"), "own", "probability"), "up")
        above = joined.select(
            "key",
            (F.col("mass") + F.col("rest") * F.col("own") * F.col("probability")).alias("mass"),
            (F.col("rest") * (1 - F.col("own"))).alias("rest"),
        )
    rows = counts.select(
        "suffix", F.lit(GRAMS).alias("kind"), "gram", "n", F.lit(0.0).alias("mass"), F.lit(0.0).alias("rest")
    ).unionByName(
        above.select(
            _suffix(F.col("key"), top).alias("suffix"),
            F.lit(WORDS).alias("kind"),
            F.col("key").alias("gram"),
            F.lit(0).cast("long").alias("n"),
            "mass",
            "rest",
        )
    )
    ordered = rows.repartition("suffix").sortWithinPartitions("suffix")
    return ordered.mapInArrow(tidy(_downwards(depth, top)), "gram long, logp double")


def _pack_answers(kind: int):
    """Task over (block, place, value): the values of each block in few packed rows, by place.

    The place of a word is its number, that of a gram the gram itself. Word rows also say which row of a word is its first; their task adds a row
    of block -1 with the number of distinct training words and of all of them.
    """
    schema = arrow_schema(_ANSWER)

    def packed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        block, place, value = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((place, block))
        block, place, value = block[order], place[order], value[order]
        begins = np.flatnonzero(np.diff(block, prepend=-2))
        payload, sizes = [], []
        for a, b in zip(begins, [*begins[1:], len(block)], strict=True):
            payload.append(pack(np.concatenate([np.diff(place[a:b], prepend=0).astype(np.int64), value[a:b].view(np.int64)])))
            sizes.append(2 * (b - a))
        kinds = np.full(len(begins), kind, dtype=np.int32)
        return pa.record_batch(
            [pa.array(kinds), pa.array(block[begins]), pa.array(payload, pa.binary()), pa.array(sizes, pa.int32())], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, distinct, total = [], 0, 0
        for batch in batches:
            block, place, value = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("block", "place", "value"))
            if kind == WORDS:
                firsts = value[batch.column("first").to_numpy(zero_copy_only=False).astype(bool)]
                distinct, total = distinct + int((firsts > 0).sum()), total + int(firsts.sum())
            parts.append([block, place, value])
            if sum(len(p[0]) for p in parts) >= 500_000:
                yield packed(parts)
                parts = []
        if parts:
            yield packed(parts)
        if kind == WORDS and total:
            counts = pack(np.array([distinct, total], dtype=np.int64))
            yield pa.RecordBatch.from_pylist([{"kind": kind, "block": -1, "payload": counts, "size": 2}], schema=schema)

    return run


def _mark_blocks(limit: int, schema: pa.Schema):
    """Task over documents: every row with its block and its number in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, before, rows in _blocks(batches, limit):
            numbers = np.arange(before, before + rows.num_rows, dtype=np.int64)
            yield pa.record_batch(
                [pa.array(np.full(rows.num_rows, block)), pa.array(numbers), rows.column("id"), rows.column("text")],
                schema=schema,
            )

    return run


def _score(schema: pa.Schema, depth: int, train_tokens: int, train_words: int):
    """Task over rows sorted by (block, kind, seq): a block's word counts and probabilities, then its texts."""

    def by_place(answers: list[np.ndarray], kind) -> tuple[np.ndarray, np.ndarray]:
        none = np.empty(0, dtype=np.int64)
        places = np.concatenate([none, *(np.cumsum(x[: len(x) // 2]) for x in answers)])
        values = np.concatenate([none, *(x[len(x) // 2 :] for x in answers)])
        order = np.argsort(places)
        return places[order], values[order].view(kind)

    base = np.log10(train_tokens + train_words + 1)

    def scored(
        rows: list[pa.RecordBatch], words: _BlockWords, answers: dict[int, list[np.ndarray]]
    ) -> Iterator[pa.RecordBatch]:
        """The texts of a block, slice by slice."""
        _, counts = by_place(answers[WORDS], np.int64)
        keys, logs = by_place(answers[GRAMS], np.float64)
        listed, numbers = words.numbered()
        if len(listed) != len(counts) or not len(keys):
            raise RuntimeError(CHANGED)
        end_count = int(counts[0])
        for some, own_numbers, first in zip(rows, numbers, words.firsts, strict=True):
            own, first_gram = grams_of(some.column("text"), depth)
            codes, distinct = _distinct(own)
            at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
            if (keys[at] != distinct).any():
                raise RuntimeError(CHANGED)
            count = counts[own_numbers]
            known = _sums((count > 0).astype(np.int64), first) + int(end_count > 0)
            tokens = np.diff(first) + 1
            basic = _sums(np.log10(count + 1.0), first) + np.log10(end_count + 1.0) - tokens * base
            score = _sums(logs[at][codes], first_gram)
            yield pa.record_batch(
                [
                    some.column("id"),
                    pa.array(tokens.astype(np.int64)),
                    pa.array(known),
                    pa.array(basic),
                    pa.array(score),
                    pa.array(-score * np.log2(10) / np.diff(first_gram)),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, words, answers = None, [], _BlockWords(), {WORDS: [], GRAMS: []}
        for batch in batches:
            blocks, kinds = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("block", "kind"))
            begins = np.flatnonzero((np.diff(blocks, prepend=-2) != 0) | (np.diff(kinds, prepend=-1) != 0))
            for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
                rows = batch.slice(begin, end - begin)
                if blocks[begin] != last:
                    if held:
                        yield from scored(held, words, answers)
                    last, held, words, answers = blocks[begin], [], _BlockWords(), {WORDS: [], GRAMS: []}
                if kinds[begin] != TEXTS:
                    packed = zip(rows.column("payload").to_pylist(), rows.column("size").to_pylist(), strict=True)
                    answers[kinds[begin]] += [unpack(p, n) for p, n in packed]
                    continue
                for some in text_slices(rows.select(["id", "text"]), "text", SLICE):
                    held.append(some)
                    words.add(some.column("text"))
        if held:
            yield from scored(held, words, answers)

    return run


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, added text by text."""
    filled = np.flatnonzero(np.diff(first))
    sums = np.zeros(len(first) - 1, dtype=values.dtype)
    if len(filled):
        sums[filled] = np.add.reduceat(values, first[filled])
    return sums


def score(
    documents: DataFrame,
    train,
    id_column: str = "doc_id",
    text_column: str = "text",
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``train`` is a condition on a document's columns; documents for which it is true
    are learned from, all are scored. ``score`` is log10 of the probability of the
    text and its end under the tree, ``bits_per_byte`` its code length by byte, the
    end counted as one; the base columns are those of single words with add-one
    smoothing. Letters A to Z are lower-cased for both. A null or empty text is its
    end alone. Repeated ids give repeated rows. With no training documents every
    bit has probability one half.

    ``documents`` is read twice and has to give the same rows in the same order,
    as a scan of files does; write the result of a shuffle to a table first.
    """
    docs = documents.select(
        F.spark_partition_id().cast("long").alias("part"),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    asked = stage(docs.drop("id").mapInArrow(tidy(_list_blocks(depth, block_bytes)), _ASKED), "asked", "kind")

    per_word = W.partitionBy("word")  # a row for each block that has the word
    words = asked.where(F.col("kind") == WORDS).select(
        "block",
        "place",
        F.sum("n").over(per_word).alias("value"),
        (F.col("block") == F.min("block").over(per_word)).alias("first"),
    )
    word_answers = stage(words.mapInArrow(tidy(_pack_answers(WORDS)), _ANSWER), "word-counts")
    totals = [unpack(r.payload, 2) for r in word_answers.where("block = -1").collect()]  # one row for each task
    train_words, train_tokens = (int(sum(t[i] for t in totals)) for i in (0, 1))

    pairs = asked.where(F.col("kind") == GRAMS).select("block", "gram", "n")
    counts = stage(pairs.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    model = probabilities(counts, depth)
    found = pairs.drop("n").join(model, "gram").select("block", F.col("gram").alias("place"), F.col("logp").alias("value"))
    gram_answers = found.mapInArrow(tidy(_pack_answers(GRAMS)), _ANSWER)

    text_schema = StructType(
        [*StructType.fromDDL("block long, seq long").fields, docs.schema["id"], docs.schema["text"]]
    )
    texts = docs.mapInArrow(tidy(_mark_blocks(block_bytes, arrow_schema(text_schema))), text_schema)
    id_type = docs.schema["id"].dataType
    answers = word_answers.where("block >= 0").unionByName(gram_answers).withColumns(
        {"seq": F.lit(0).cast("long"), "id": F.lit(None).cast(id_type), "text": F.lit(None).cast("string")}
    )
    rows = answers.unionByName(
        texts.withColumns(
            {"kind": F.lit(TEXTS), "payload": F.lit(None).cast("binary"), "size": F.lit(None).cast("int")}
        )
    )
    out = StructType(
        [
            StructField("id", id_type),
            *StructType.fromDDL(
                "n_tokens long, n_known long, base_score double, score double, bits_per_byte double"
            ).fields,
        ]
    )
    scored = (
        rows.repartition("block")
        .sortWithinPartitions("block", "kind", "seq")
        .mapInArrow(tidy(_score(arrow_schema(out), depth, train_tokens, train_words)), out)
    )
    return scored.withColumn("train_tokens", F.lit(train_tokens).cast("long")).withColumnRenamed("id", id_column)
