"""How quality filters interact: what each removes after any others, in every order of them.

A document is reduced to a mask with a bit for each filter that it fails, and
the documents of a part (a source, say) to cells: how many documents have which
mask. There are at most 2 ** k cells for k filters, so all questions about
subsets and orders of filters are answered from the cells.

The subsets are walked in Gray-code order: each step toggles one filter. Every
cell has a counter of its failures among the filters switched on; a toggle
changes the counters of the cells with its bit, and the running survivors gain
or lose the cells whose counter reaches or leaves zero. The survivors of all
2 ** k states are stored, and a step of an order is the difference of two.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from clearbook.llm.common import arrow_schema, text_bytes, text_slices, tidy, unused_name, words_in
from clearbook.sources.staging import stage

STATISTICS = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_distinct", LongType()),
        StructField("n_upper", LongType()),
        StructField("n_points", LongType()),
        StructField("has_symbol", BooleanType()),
    ]
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#$%&*|"]] = True

CELL = StructType([StructField("part", StringType())] + [StructField(n, LongType()) for n in ("mask", "n", "good", "toxic")])
STEP = StructType(
    [StructField("part", StringType()), StructField("filter_order", StringType())]
    + [
        StructField(name, LongType())
        for name in ("step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    ]
)


def statistics_of(texts: pa.Array) -> list[np.ndarray]:
    """Of each text: words, distinct words (as written), letters A to Z, code points, and whether it holds a symbol."""
    data, offsets = text_bytes(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    words = words_in(data, offsets)
    codes, distinct = words.coded()
    pairs = np.sort(words.rows() * max(len(distinct), 1) + codes)
    first = np.ones(len(pairs), dtype=bool)
    first[1:] = pairs[1:] != pairs[:-1]
    counts = np.bincount(pairs[first] // max(len(distinct), 1), minlength=len(texts))
    return [
        words.counts(),
        counts,
        per_text((data >= 65) & (data <= 90)),
        per_text((data & 0xC0) != 0x80),  # bytes that begin a character
        per_text(_SYMBOL[data]) > 0,
    ]


def with_statistics(documents: DataFrame, text_column: str = "text", digest: str = "digest") -> DataFrame:
    """All columns but the text, the columns of STATISTICS, and the SHA-256 of the text; a null text is empty.

    Older columns named like a new one are replaced.
    """
    made = {text_column.lower(), digest.lower(), *(f.name for f in STATISTICS)}
    kept = [c for c in documents.columns if c.lower() not in made]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    docs = documents.select(*[F.col(f"`{c}`") for c in kept], F.unhex(F.sha2(text, 256)).alias(digest), text.alias(text_column))
    schema = StructType([f for f in docs.schema.fields if f.name != text_column] + STATISTICS.fields)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, text_column):
                made = [pa.array(column) for column in statistics_of(rows.column(text_column))]
                yield pa.record_batch([*rows.drop_columns([text_column]).columns, *made], schema=arrow)

    return docs.mapInArrow(tidy(run), schema)


def mark_copies(rows: DataFrame, column: str, digest: str = "digest", id_column: str = "doc_id") -> DataFrame:
    """Add ``column``: whether a row with a smaller id, anywhere in the table, has the same digest.

    Equal ids do not make each other copies. A null id is neither smaller nor
    greater than any other, so such a row is no copy and makes none. ``rows`` is
    read twice. The smallest ids of the digests are joined by digest and id at
    once, so a text with any number of copies is no hot key of the join.
    """
    digest_, id_, first = F.col(f"`{digest}`"), F.col(f"`{id_column}`"), unused_name("first", rows.columns)
    known = [unused_name(n, rows.columns) for n in ("first_digest", "first_id")]
    firsts = rows.where(id_.isNotNull()).groupBy(digest_.alias(known[0])).agg(F.min(id_).alias(known[1]))
    firsts = firsts.withColumn(first, F.lit(True))
    joined = rows.join(firsts, (digest_ == F.col(known[0])) & (id_ == F.col(known[1])), "left")
    return joined.withColumn(column, id_.isNotNull() & F.col(first).isNull()).drop(first, *known)


def masks(rows: DataFrame, filters: Mapping[str, str], column: str = "mask") -> DataFrame:
    """Add the mask: bit i is set where the i-th filter's condition, in SQL, is true; null counts as not failing."""
    bits = [F.when(F.expr(failing), F.lit(1 << i)).otherwise(F.lit(0)) for i, failing in enumerate(filters.values())]
    return rows.withColumn(column, sum(bits, F.lit(0)).cast("long"))


def cells(rows: DataFrame, part: Column, good: Column, toxic: Column, mask: str = "mask") -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part by mask, and those of them that are good or toxic."""

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    grouped = rows.groupBy(part.alias("part"), F.col(f"`{mask}`").alias("mask"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), count(good).alias("good"), count(toxic).alias("toxic"))


def walk(cell_counts: np.ndarray, k: int) -> np.ndarray:
    """Survivors of every subset of ``k`` filters: row S has the sums of the rows of ``cell_counts`` whose mask misses S.

    ``cell_counts`` has 2 ** k rows, one for each mask, and any number of columns.
    """
    active = np.zeros(1 << k, dtype=np.int64)
    survivors = cell_counts.sum(axis=0)
    states = np.empty_like(cell_counts)
    states[0] = survivors
    having = [np.flatnonzero(np.arange(1 << k) >> bit & 1) for bit in range(k)]
    state = 0
    for step in range(1, 1 << k):
        bit = (step & -step).bit_length() - 1
        state ^= 1 << bit
        touched = having[bit]
        if state >> bit & 1:
            fallen = touched[active[touched] == 0]
            active[touched] += 1
            survivors = survivors - cell_counts[fallen].sum(axis=0)
        else:
            active[touched] -= 1
            risen = touched[active[touched] == 0]
            survivors = survivors + cell_counts[risen].sum(axis=0)
        states[state] = survivors
    return states


def steps(counted: DataFrame, names: str) -> DataFrame:
    """What each filter does at each step of each order of all filters, by part: rows of STEP.

    ``counted`` is what ``cells`` gives, its masks with a bit for each letter of
    ``names``. Each part has k * k! rows, so ``names`` should be short. A part
    without documents has none.
    """
    k, columns = len(names), ["n", "good", "toxic"]
    orders = ["".join(order) for order in permutations(names)]

    def of_part(frame):
        import pandas as pd

        table = np.zeros((1 << k, 3), dtype=np.int64)
        np.add.at(table, frame["mask"].to_numpy(), frame[columns].to_numpy(dtype=np.int64))
        states = walk(table, k)
        everything = (1 << k) - 1
        fails = {f: states[0, 0] - states[1 << i, 0] for i, f in enumerate(names)}
        alone = {f: states[everything ^ 1 << i, 0] - states[everything, 0] for i, f in enumerate(names)}
        rows, removed_in_all = [], dict.fromkeys(names, 0)
        for order in orders:
            state = 0
            for step, letter in enumerate(order, start=1):
                after = state | 1 << names.index(letter)
                removed, good, toxic = states[state] - states[after]
                removed_in_all[letter] += removed
                rows.append([order, step, states[after, 0], removed, fails[letter] - removed, alone[letter], good, toxic])
                state = after
        made = pd.DataFrame(rows, columns=STEP.names[1:-1])
        made.insert(0, "part", frame["part"].iloc[0])
        filters = [order[step - 1] for order, step in zip(made["filter_order"], made["step"], strict=True)]
        return made.assign(shapley=[removed_in_all[f] for f in filters])

    return counted.groupBy("part").applyInPandas(of_part, STEP)


def label_flags(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, is_good, is_toxic), one row for each id: whether any of its labels says so."""
    said = [F.max(F.col(c) == 1).alias(name) for c, name in (("quality", "is_good"), ("toxic", "is_toxic"))]
    return labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("label_id")).agg(*said)


def judged(
    documents: DataFrame, filters: Mapping[str, str], copies: str | None = None, id_column: str = "doc_id"
) -> DataFrame:
    """All columns but the text, the statistics, and ``mask`` by ``filters``, whose conditions use the statistics.

    With ``copies`` one more filter of that letter comes last: texts equal to
    one with a smaller id. The rows are staged, as copies are found in two
    passes; a null text is empty.
    """
    rows = stage(with_statistics(documents), "statistics")
    if copies is not None:
        seen = unused_name("is_copy", rows.columns)
        rows = mark_copies(rows, seen, id_column=id_column)
        return masks(rows, {**filters, copies: seen}).drop(seen)
    return masks(rows, filters)


def audit(
    documents: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, str],
    copies: str | None = None,
    part_column: str = "source",
    id_column: str = "doc_id",
) -> DataFrame:
    """The steps of all orders of ``filters`` (and ``copies``) for each value of ``part_column``; null is the empty part.

    ``labels`` has quality and toxic marks by id; a document without one is
    neither good nor toxic.
    """
    wanted = documents.select(id_column, "text", F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"))
    rows = judged(wanted, filters, copies, id_column)
    rows = rows.join(label_flags(labels, id_column), F.col(id_column) == F.col("label_id"), "left")
    counted = cells(rows, F.col("part"), F.col("is_good"), F.col("is_toxic"))
    return steps(counted, "".join([*filters, *([copies] if copies else [])]))
