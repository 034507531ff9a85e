"""Quality by robust multivariate outliers: minimum covariance determinant per language and source.

Each text becomes a vector of transformed statistics. For each group of texts the
centre and scatter are those of the most concentrated three quarters, so junk
cannot hide by shifting them; a text is rejected if its Mahalanobis distance from
the centre is beyond a chi-square bound.

Concentration starts from medians and quartile ranges and repeats one step: the
distances of all texts of all groups, then mean and covariance of the nearest
share of each group. A step is one aggregation of sums per group and distance
bin, combined before the shuffle, so a group may hold any share of the rows. All
texts count in every step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearbook.llm.common import arrow_schema, binary_array, text_bytes, text_slices, tidy, unused_name, words_in
from clearbook.sources.staging import stage

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words in repeated windows

NEAREST = 0.75  # share of a group that its estimate rests on
STEPS = 6
REWEIGHT = 0.975  # rows within this chi-square quantile make the final estimate
REJECT = 1e-6  # share of a normal group that is rejected by chance
MIN_GROUP = 100  # smaller groups of a language are pooled, and what is small then is pooled over all languages
BINS = 64  # distance bins for each factor of e

# Transformed statistics and the least standard deviation each is taken to have.
FLOORS = {"word_length": 0.05, "symbols": 0.15, "dup_lines": 0.1, "repeats": 0.08, "upper": 0.2, "punctuation": 0.15}
DIM = len(FLOORS)
_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_punctuation long"
)

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_PUNCTUATION = np.array([b < 128 and chr(b).isprintable() and not chr(b).isalnum() and b != 32 for b in range(256)])


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets])


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them equal to an earlier one) of each text."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    # lines begin with a text and behind every line feed; the line feed stays out of the compared piece
    begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    owner = np.searchsorted(offsets, begins, side="right") - 1
    # a line feed at the end of a text opens a line that is empty, but searchsorted gives it to the next text
    seen = np.concatenate([[0], np.cumsum(inside)])
    following = np.append(begins[1:], len(data))
    words = seen[np.maximum(following, begins)] - seen[begins] > 0
    ends = following - ((following > begins) & (data[np.maximum(following - 1, 0)] == 0x0A) if len(data) else 0)
    begins, ends, owner = begins[words], ends[words], owner[words]
    bounds = np.empty(2 * len(begins), dtype=np.int64)
    bounds[0::2], bounds[1::2] = begins, ends
    if not len(begins):
        return np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
    codes = binary_array(data, bounds).dictionary_encode().indices.to_numpy(zero_copy_only=False)[0::2]
    lines = np.bincount(owner, minlength=rows)
    distinct = np.unique(owner * (int(codes.max()) + 1) + codes) // (int(codes.max()) + 1)
    return lines, lines - np.bincount(distinct, minlength=rows)


def _repeated_words(codes: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of three found twice or more in it."""
    texts = len(first) - 1
    if len(codes) < 3:
        return np.zeros(texts, dtype=np.int64)
    size = int(codes.max()) + 1
    _, pairs = np.unique(codes[:-1] * size + codes[1:], return_inverse=True)
    at = np.flatnonzero(rows[:-2] == rows[2:])
    _, triples = np.unique(pairs[at] * size + codes[at + 2], return_inverse=True)
    keys = rows[at] * (int(triples.max(initial=0)) + 1) + triples
    _, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = at[counts[number] > 1]
    covered = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        covered[twice + shift] = True
    return _per_text(covered, first)


def statistics_of(texts: pa.Array) -> list[np.ndarray]:
    """The columns of STATS for some texts."""
    data, offsets = text_bytes(texts)
    words = words_in(data, offsets)
    codes, _ = words.coded()
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    # a character is counted at its first byte
    chars = _per_text(inside & ((data & 0xC0) != 0x80), offsets)
    lines, duplicates = _duplicate_lines(data, offsets, inside)
    accented = np.zeros(len(data), dtype=bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)  # À to Þ
    upper = _per_text(((data >= 65) & (data <= 90)) | accented, offsets)
    return [
        words.counts(),
        chars,
        _per_text(_SYMBOL[data], offsets),
        duplicates,
        _repeated_words(codes.astype(np.int64), words.first, words.rows()),
        lines,
        upper,
        _per_text(_PUNCTUATION[data], offsets),
    ]


def statistics(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns but the text, and the statistics of the text; a null text has none of anything.

    Older columns named like a statistic are replaced.
    """
    made = {field.name for field in StructType.fromDDL(STATS)} | {text_column}
    kept = [c for c in documents.columns if c not in made]
    docs = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_column}`").cast("string"))
    schema = StructType([*[f for f in docs.schema.fields if f.name in kept], *StructType.fromDDL(STATS).fields])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, text_column):
                found = [pa.array(x.astype(np.int64)) for x in statistics_of(rows.column(text_column))]
                yield pa.record_batch([*rows.columns[:-1], *found], schema=arrow)

    return docs.mapInArrow(tidy(run), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _vector() -> list[Column]:
    """The transformed statistics, in the order of FLOORS; only for texts with words."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return [
        F.log(chars / words),
        F.log1p(20 * F.col("n_symbols") / words),
        F.col("n_dup_lines") / F.col("n_lines"),
        F.col("n_repeat_words") / words,
        F.log(F.col("n_upper") / chars + 0.02),
        F.log(F.col("n_punctuation") / chars + 0.02),
    ]


def chi_square_share(x: float, dim: int) -> float:
    """Share of a chi-square distribution below x, for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dim // 2))


def chi_square_bound(share: float, dim: int) -> float:
    """The x below which lies this share of a chi-square distribution, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, dim) < share else (low, middle)
    return high


def consistency(share: float) -> float:
    """Factor that makes the covariance of the nearest ``share`` of a normal group that of the whole group."""
    return share / chi_square_share(chi_square_bound(share, DIM), DIM + 2)


def _starts(vectors: DataFrame) -> DataFrame:
    """(group, centre, precision): medians, and quartile ranges as standard deviations, from exact histograms."""
    values = vectors.select(
        "group",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("at"), F.round(F.col("x")[i], 2).alias("value")) for i in range(DIM)])
        ).alias("v"),
    )
    counts = values.groupBy("group", "v.at", "v.value").count()
    so_far = W.partitionBy("group", "at").orderBy("value")
    ranked = counts.withColumns({"below": F.sum("count").over(so_far), "all": F.sum("count").over(W.partitionBy("group", "at"))})

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("below") >= share * F.col("all"), F.col("value")))

    normal = 2 * NormalDist().inv_cdf(0.75)
    floor = F.element_at(F.array(*map(F.lit, FLOORS.values())), F.col("at") + 1)
    each = ranked.groupBy("group", "at").agg(
        quantile(0.5).alias("centre"), ((quantile(0.75) - quantile(0.25)) / normal).alias("sd")
    )
    each = each.withColumn("precision", 1 / (F.col("sd") ** 2 + floor**2))
    ordered = each.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("at", "centre", "precision"))).alias("e"))
    diagonal = F.array(
        *[F.col("e")[i]["precision"] if i == j else F.lit(0.0) for i, j in _PAIRS]
    )
    return ordered.select("group", F.col("e.centre").alias("centre"), diagonal.alias("precision"))


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` by ``centre`` and ``precision``."""
    gaps = [F.col("x")[i] - F.col("centre")[i] for i in range(DIM)]
    terms = [
        gaps[i] * gaps[j] * F.col("precision")[k] * (1.0 if i == j else 2.0) for k, (i, j) in enumerate(_PAIRS)
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _estimates(factor: float):
    """Task over (group, n, sums, products): centre and inverse of the floored, corrected covariance."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for group, n, sums, products in zip(frame["group"], frame["n"], frame["sums"], frame["products"], strict=True):
                centre = np.array(sums) / n
                scatter = np.zeros((DIM, DIM))
                for (i, j), product in zip(_PAIRS, products, strict=True):
                    scatter[i, j] = scatter[j, i] = product / n - centre[i] * centre[j]
                scatter = factor * scatter + np.diag(np.square(list(FLOORS.values())))
                precision = np.linalg.inv(scatter)
                out.append((group, centre.tolist(), [float(precision[i, j]) for i, j in _PAIRS]))
            yield pd.DataFrame(out, columns=["group", "centre", "precision"])

    return run


def _step(vectors: DataFrame, estimates: DataFrame, share: float | None, bound: float | None) -> DataFrame:
    """New estimates from the nearest ``share`` of each group, or from all rows within ``bound``.

    The nearest share ends with the distance bin in which it is reached.
    """
    d = _distance()
    binned = vectors.join(estimates, "group").withColumn("d", d)
    bin_ = F.floor(F.log(F.greatest(F.col("d"), F.lit(1e-6))) * BINS).cast("int")
    if bound is not None:
        binned = binned.where(F.col("d") <= bound)
        bin_ = F.lit(0)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(DIM)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{k}") for k, (i, j) in enumerate(_PAIRS)]
    per_bin = binned.groupBy("group", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    if share is not None:
        before = W.partitionBy("group").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
        per_bin = per_bin.withColumns(
            {"before": F.coalesce(F.sum("n").over(before), F.lit(0)), "all": F.sum("n").over(W.partitionBy("group"))}
        ).where(F.col("before") < F.ceil(F.col("all") * share))
    names = [f"s{i}" for i in range(DIM)], [f"p{k}" for k in range(len(_PAIRS))]
    total = per_bin.groupBy("group").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for part in names for c in part])
    packed = total.select("group", "n", F.array(*names[0]).alias("sums"), F.array(*names[1]).alias("products"))
    factor = consistency(share if share is not None else REWEIGHT)
    made = packed.mapInPandas(_estimates(factor), "group string, centre array<double>, precision array<double>")
    return stage(made, "estimates")


def _text_of(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _grouped(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Rows with ``group``: language and source, or a pool of the small ones."""
    fine = F.concat_ws("\u0001", _text_of(F.col(f"`{lang}`")), _text_of(F.col(f"`{source}`")))
    keyed = rows.withColumns({"_fine": fine, "_lang": _text_of(F.col(f"`{lang}`"))})
    counts = keyed.groupBy("_fine", "_lang").count()
    small = counts.where(F.col("count") < MIN_GROUP).groupBy("_lang").agg(F.sum("count").alias("pooled"))
    names = counts.join(small, "_lang", "left").select(
        "_fine",
        F.when(F.col("count") >= MIN_GROUP, F.col("_fine"))
        .when(F.col("pooled") >= MIN_GROUP, F.col("_lang"))
        .otherwise("")
        .alias("group"),
    )
    return keyed.join(names, "_fine").drop("_fine", "_lang")


def judge(measured: DataFrame, lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """Add ``base_failed``, ``distance`` (squared, null if base_failed) and ``kept`` to measured documents.

    Texts that fail the base rules are rejected and have no part in the
    estimates. Null languages and sources are values like any other. Groups of
    fewer than MIN_GROUP texts are pooled; a pool of very few texts still has an
    estimate, because every deviation has a floor.
    """
    measured = measured.drop("base_failed", "distance", "kept")
    key = unused_name("key", measured.columns)
    rows = stage(
        measured.withColumn("base_failed", base_failed()).withColumn(key, F.monotonically_increasing_id()), "measured"
    )
    able = rows.where(~F.col("base_failed"))
    vectors = stage(
        _grouped(able.select(key, F.array(*_vector()).alias("x"), lang_column, source_column), lang_column, source_column)
        .select(F.col(key).alias("key"), "group", "x"),
        "vectors",
    )
    estimates = stage(_starts(vectors), "estimates")
    for _ in range(STEPS):
        estimates = _step(vectors, estimates, NEAREST, None)
    estimates = _step(vectors, estimates, None, chi_square_bound(REWEIGHT, DIM))
    distances = vectors.join(estimates, "group").select(F.col("key").alias(key), _distance().alias("distance"))
    limit = chi_square_bound(1 - REJECT, DIM)
    return (
        rows.join(distances, key, "left")
        .withColumn("kept", F.coalesce(F.col("distance") <= limit, F.lit(False)))
        .drop(key)
    )


def keep_quality(documents: DataFrame, lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """(all columns but the text, the statistics, base_failed, distance, kept) for every document, in any order."""
    return judge(statistics(documents), lang_column, source_column)
