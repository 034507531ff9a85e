"""Periodic runs: stretches of a text that repeat themselves word by word, found by seeds and diagonals.

A run of period q is a longest stretch in which words q apart are equal; q is its
smallest period, and it holds at least two of them. On the diagonal of lag q, on
which word i meets word i + q, a run of length L is a stretch of L - q equal
pairs, bounded by unequal ones.

* Seeds. Such a stretch has at least q pairs, and at least ``shortest`` - q. So
  the k-grams at its first pair are equal, for k half of ``shortest`` as well as
  for every doubling of it up to q. Grams of length k are indexed by doubling
  (a gram of 2k words is a pair of grams), and those of level k make the seeds
  of lags from k to 2k; the first level makes those of all shorter lags too.
* Pairs. Occurrences of a gram that follow each other by k / 2 words or less
  make a progression, whose members all but the first have the same word before
  them. Two such members have a seed on their lag one word to the left, so that
  the stretch is entered further left. Hence only pairs with the head of a
  progression are listed: a few times as many as the text has words at most,
  even if it is one word over and over.
* Extension. A diagonal is followed to the right by jumps of equal grams, the
  longest first. A table has for each lag the furthest pair covered so far, and
  a seed that it covers is not extended again.
* Of the stretches between the same two ends the one of smallest period is the
  run; the others have multiples of its period.

A slice of many documents is searched at once: equal words of different documents
have different numbers, so no gram recurs in another document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from clearbook.llm.common import arrow_schema, text_bytes, text_slices, tidy, words_in

SHORTEST = 12  # words of the shortest run

RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))


def _codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of pairs of numbers; equal pairs have equal ones. -1, for what occurs once, in a part or as a pair."""
    codes = np.full(len(left), -1, dtype=np.int32)
    both = np.flatnonzero((left >= 0) & (right >= 0))
    if len(both):
        width = int(right[both].max()) + 1
        numbers, _ = pd.factorize(left[both].astype(np.int64) * width + right[both])
        again = np.bincount(numbers)[numbers] > 1
        codes[both[again]] = numbers[again]
    return codes


def _later(codes: np.ndarray, by: int) -> np.ndarray:
    """The code ``by`` places further on; -1 beyond the end."""
    return np.concatenate([codes[by:], np.full(min(by, len(codes)), -1, dtype=codes.dtype)])


def _gram(words: np.ndarray, size: int) -> np.ndarray:
    """Codes of all grams of ``size`` words."""
    made, known, whole, at = {1: words}, 1, None, 0
    while 2 * known <= size:
        made[2 * known] = _codes(made[known], _later(made[known], known))
        known *= 2
    for length in sorted(made, reverse=True):
        if at + length <= size:
            whole = made[length] if whole is None else _codes(whole, _later(made[length], at))
            at += length
    return whole


def _ranges(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, member) of all members of the ranges from ``lows`` to before ``highs``."""
    sizes = np.maximum(highs - lows, 0)
    owner = np.repeat(np.arange(len(lows)), sizes)
    return owner, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lows[owner]


def _seeds(codes: np.ndarray, size: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of the pairs of equal grams, ``least`` to ``most`` - 1 words apart, with the head of a progression."""
    places = np.flatnonzero(codes >= 0)
    order = np.argsort(codes[places], kind="stable")
    places = places[order]
    grams = codes[places].astype(np.int64)
    span = len(codes) + most + 1
    keys = grams * span + places  # ascending
    gaps = np.diff(keys, prepend=-span)
    heads = np.flatnonzero(gaps > size // 2)
    is_head = np.zeros(len(keys), dtype=bool)
    is_head[heads] = True
    # a head and what follows it
    owner, after = _ranges(np.searchsorted(keys, keys[heads] + least), np.searchsorted(keys, keys[heads] + most))
    first, second = heads[owner], after
    # what stands before a head, unless it is one itself
    owner, before = _ranges(np.searchsorted(keys, keys[heads] - most, "right"), np.searchsorted(keys, keys[heads] - least, "right"))
    rest = ~is_head[before]
    first, second = np.concatenate([first, before[rest]]), np.concatenate([second, heads[owner][rest]])
    return places[first], places[second] - places[first]


def _reach(levels: list[tuple[int, np.ndarray]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many words from ``left`` on equal those from ``right`` on; ``levels`` are (gram size, codes), longest first."""
    moved = np.zeros(len(left), dtype=np.int64)
    for size, codes in levels:
        going = np.arange(len(left))
        while len(going):
            a, b = left[going] + moved[going], right[going] + moved[going]
            inside = b < len(codes)
            going, a, b = going[inside], a[inside], b[inside]
            going = going[(codes[a] >= 0) & (codes[a] == codes[b])]
            moved[going] += size
    return moved


def find_runs(words: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.

    ``words`` are numbers of words, from 0, different ones for each document;
    what occurs once may be -1.
    """
    seed = shortest // 2
    singles = words.astype(np.int32)
    levels, found = [(1, singles)], []
    size, codes = seed, _gram(singles, seed)
    while (codes >= 0).any():
        levels.insert(0, (size, codes))
        place, lag = _seeds(codes, size, size if size > seed else 1, 2 * size)
        # one word to the left the diagonal is unequal, or else it covers the seed already
        begun = place > 0
        begun[begun] = singles[place[begun] - 1] == singles[(place + lag)[begun] - 1]
        begun[begun] = singles[place[begun] - 1] >= 0
        place, lag = place[~begun], lag[~begun]
        order = np.lexsort((place, lag))
        found.append((place[order], lag[order]))
        size, codes = 2 * size, _codes(codes, _later(codes, size))
    if not found:
        nothing = np.empty(0, dtype=np.int64)
        return nothing, nothing, nothing
    place, lag = (np.concatenate(part).astype(np.int64) for part in zip(*found, strict=True))
    pairs = _reach(levels, place, place + lag)
    length = pairs + lag
    # the furthest pair covered on each lag by the seeds before
    order = np.lexsort((place, lag))
    place, lag, pairs, length = place[order], lag[order], pairs[order], length[order]
    table = pd.Series(place + pairs).groupby(lag).cummax().groupby(lag).shift(fill_value=-1).to_numpy()
    good = (place >= table) & (length >= np.maximum(shortest, 2 * lag))
    place, length, lag = place[good], length[good], lag[good]
    order = np.lexsort((lag, length, place))
    place, length, lag = place[order], length[order], lag[order]
    smallest = np.ones(len(place), dtype=bool)
    smallest[1:] = (place[1:] != place[:-1]) | (length[1:] != length[:-1])
    place, length, lag = place[smallest], length[smallest], lag[smallest]
    order = np.lexsort((lag, place))
    return place[order], length[order], lag[order]


def collapsed(texts: pa.Array, shortest: int = SHORTEST) -> tuple[pa.Array, pa.Array]:
    """(runs of each text as lists of start, length and period; the text's words without the repetitions)."""
    data, offsets = text_bytes(texts)
    words = words_in(data, offsets)
    rows = words.rows()
    codes, distinct = words.coded()
    width = max(len(distinct), 1)
    numbers, _ = pd.factorize(rows * width + codes)
    start, length, period = find_runs(numbers, shortest)
    lost = np.zeros(len(numbers) + 1, dtype=np.int64)
    np.add.at(lost, start + period, 1)
    np.add.at(lost, start + length, -1)
    kept = np.cumsum(lost)[:-1] == 0
    own = rows[start] if len(start) else start
    bounds = np.searchsorted(own, np.arange(len(texts) + 1))
    values = pa.StructArray.from_arrays(
        [pa.array(start - words.first[own]), pa.array(length), pa.array(period)], names=["start", "length", "period"]
    )
    runs = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
    raw = data.tobytes()
    joined = []
    for text in range(len(texts)):
        found = raw[offsets[text] : offsets[text + 1]].split()  # bytes are split at the same white space
        if bounds[text] < bounds[text + 1]:
            stays = kept[words.first[text] : words.first[text + 1]]
            found = [found[i] for i in np.flatnonzero(stays).tolist()]
        joined.append(b" ".join(found))
    return runs, pa.array(joined, pa.binary()).cast(pa.string())


def collapse_runs(
    documents: DataFrame, text_column: str = "text", runs_column: str = "runs", shortest: int = SHORTEST
) -> DataFrame:
    """The documents with ``runs_column`` (start, length and period of each, in words) and the text without repetitions.

    Words are maximal stretches of other characters than blanks, tabs, line
    feeds, vertical tabs, form feeds and carriage returns. A word goes if any
    run holds it behind that run's first period; the others are joined by one
    blank. A null text has no runs and becomes empty. Each row is judged alone,
    so repeated rows and ids do not matter. An older column named like
    ``runs_column`` is replaced.
    """
    kept = [c for c in documents.columns if c.lower() not in (text_column.lower(), runs_column.lower())]
    docs = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_column}`").cast("string"))
    fields = [f for f in docs.schema.fields if f.name in kept]
    schema = StructType([*fields, StructField(runs_column, RUNS), StructField(text_column, StringType())])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, text_column):
                runs, texts = collapsed(rows.column(text_column), shortest)
                others = rows.drop_columns([text_column]).columns
                yield pa.record_batch([*others, runs.cast(arrow.field(runs_column).type), texts], schema=arrow)

    order = [*documents.drop(runs_column).columns, runs_column]
    return docs.mapInArrow(tidy(run), schema).select([F.col(f"`{c}`") for c in order])
