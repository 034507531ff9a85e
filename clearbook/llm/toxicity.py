"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training sees a bounded sample of labelled documents in one sequential task, as
the online algorithm wants it; every coordinate has a learning rate of its own,
and the L1 term sets the weight of everything without steady evidence to zero.
What is left is a short list of weights that goes to every scoring task. Scoring
reads every document whole, in place, without a shuffle.

A feature is present in a document or not, however often it occurs and however
long the document is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clearbook.llm.common import arrow_schema, letter_words, text_slices, tidy, unused_name, word_hashes

SAMPLE_ROWS = 20_000  # labelled documents that training reads, about
FEATURE_BITS = 20  # weights number 2 ** FEATURE_BITS at most
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 1.0

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % folds


def features_of(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all distinct features of some texts, or of the ``wanted`` ones, ordered by row."""
    words = letter_words(texts)
    hashes = word_hashes(words)
    rows = words.rows()

    shift = np.uint64(64 - FEATURE_BITS)
    keys = []
    for distance in (0, 1, 2):  # the word, it and the next, it and the next but one
        with np.errstate(over="ignore"):
            first, second = hashes[: len(hashes) - distance], hashes[distance:]
            mixed = first * _MIX[distance] + (second * _MIX[3] if distance else 0)
            slot = ((mixed ^ (mixed >> np.uint64(29))) * _MIX[0]) >> shift
        same = rows[: len(rows) - distance] == rows[distance:]
        if wanted is not None:
            same &= wanted[slot]
        keys.append((rows[: len(rows) - distance][same] << FEATURE_BITS) | slot[same].astype(np.int64))
    found = np.unique(np.concatenate(keys))
    return found >> FEATURE_BITS, found & ((1 << FEATURE_BITS) - 1)


class _Ftrl:
    """Weights as sums of gradients; the bias is the last one and is not regularised."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << FEATURE_BITS) + 1)
        self.n = np.zeros((1 << FEATURE_BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 1 << FEATURE_BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, 1 << FEATURE_BITS)
        w = self.weights(at)
        gradient = _sigmoid(w.sum()) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient * gradient


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, seen = _Ftrl(), []
    for batch in batches:
        for part in text_slices(batch, "text"):
            rows, features = features_of(part.column("text"))
            bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
            for a, b, label in zip(bounds[:-1], bounds[1:], part.column("label").to_pylist(), strict=True):
                seen.append((features[a:b].astype(np.int32), label))
                model.learn(features[a:b], label)
    for _ in range(EPOCHS - 1):
        for features, label in seen:
            model.learn(features, label)
    every = np.arange((1 << FEATURE_BITS) + 1)
    weights = model.weights(every)
    kept = np.flatnonzero(weights)
    yield pa.record_batch([pa.array(kept), pa.array(weights[kept])], names=["feature", "weight"])


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> list[tuple[int, float]]:
    """The weights that are not zero, at most 2 ** FEATURE_BITS + 1 of them; the last slot is the bias.

    ``labels`` are the rows to learn from: (id, 0 or 1). Null ids and labels are
    left out, the larger of repeated labels counts. About ``sample_rows`` of the
    ids are taken, by their hash, so the same ones whatever the partitions. Rows
    that repeat id and text are learned from once. No labels give no weights, and
    every score is one half.
    """
    known = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    total = known.count()
    ticks = 1 << 30
    order = F.pmod(F.xxhash64("id"), F.lit(ticks))
    share = min(ticks, ticks * sample_rows // max(total, 1))
    sample = known.where(order < share)
    docs = documents.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    # the sample has about sample_rows small rows, whatever the input; rows that repeat id and text are one example,
    # combined before they move
    rows = docs.join(F.broadcast(sample), "id").groupBy("id", F.xxhash64("text").alias("digest"))
    rows = rows.agg(F.first("text").alias("text"), F.first("label").alias("label")).withColumn("order", order)
    learned = (
        rows.repartition(1)
        .sortWithinPartitions("order", "id", "digest")
        .select("text", "label")
        .mapInArrow(tidy(_train), "feature long, weight double")
    )
    return [(row.feature, row.weight) for row in learned.collect()]


def score(
    documents: DataFrame, weights: list[tuple[int, float]], text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """All columns and the probability that a document is toxic; an empty or null text has that of the bias.

    An older column named like ``score_column`` is replaced.
    """
    kept = documents.drop(score_column)
    schema = StructType([*kept.schema.fields, StructField(score_column, DoubleType())])
    arrow = arrow_schema(schema)
    slots = np.array([slot for slot, _ in weights], dtype=np.int64)
    values = np.array([value for _, value in weights], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << FEATURE_BITS) + 1)
        table[slots] = values
        wanted = table != 0
        for batch in batches:
            for part in text_slices(batch, text_column):
                rows, features = features_of(part.column(text_column), wanted)
                sums = np.bincount(rows, weights=table[features], minlength=part.num_rows) + table[-1]
                yield pa.record_batch([*part.columns, pa.array(_sigmoid(sums))], schema=arrow)

    return kept.mapInArrow(tidy(run), schema)


def toxicity(
    documents: DataFrame,
    labels: DataFrame,
    held_out_fold: int = 0,
    folds: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``; labels of the held-out fold are not read.

    A null id is held out. ``predicted`` is 1 from a score of 0.5 on.
    """
    weights = train(documents, labels.where(fold(id_column, folds) != held_out_fold), id_column, text_column)
    scored = score(documents, weights, text_column)
    return scored.withColumns(
        {
            "held_out": F.coalesce(fold(id_column, folds) == held_out_fold, F.lit(True)),
            "predicted": F.when(F.col("score") >= 0.5, 1).otherwise(0),
        }
    )


def keep_harmless(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents that score below 0.5, all columns as they are; all labels are learned from."""
    found = unused_name("_score", documents.columns)
    scored = score(documents, train(documents, labels, id_column, text_column), text_column, found)
    return scored.where(F.col(found) < 0.5).drop(found)
