import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from conftest import SMALL
from pyspark.sql import functions as F

from clearbook.llm import queries, toxicity


def labels_of(spark):
    return spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def test_held_out_accuracy(spark):
    rows = queries.op6_toxicity(spark, "/root/testdata/sf0.1").collect()
    truth = {r.doc_id: r.toxic for r in labels_of(spark).collect()}
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    assert sum(p > t for p, t in held) == 0


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    first = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}


def ftrl_by_definition(examples):
    """Weights by feature after all epochs: the update of each coordinate, one after the other."""
    bias = 1 << toxicity.FEATURE_BITS
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0 if i == bias else toxicity.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for features, label in examples:
            present = [*features, bias]
            own = {i: weight(i) for i in present}
            gradient = 1 / (1 + math.exp(-sum(own.values()))) - label
            for i in present:
                sigma = (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += gradient - sigma * own[i]
                n[i] += gradient**2
    return {i: weight(i) for i in z if weight(i)}


def test_weights_against_the_definition(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = docs.join(labels, "doc_id").orderBy(order, "doc_id").select("text", "toxic").collect()
    examples = [(toxicity.features_of(pa.array([r.text]))[1].tolist(), r.toxic) for r in rows]
    expected = ftrl_by_definition(examples)
    found = dict(toxicity.train(docs, labels))
    assert set(found) == set(expected) and len(found) > 20
    np.testing.assert_allclose([found[i] for i in sorted(found)], [expected[i] for i in sorted(found)], rtol=1e-9)
    # repeated rows of one labelled document are one example
    hot = docs.join(labels, "doc_id").limit(1).drop("quality", "toxic").crossJoin(spark.range(500)).drop("id")
    assert dict(toxicity.train(docs.unionByName(hot), labels)) == found


def test_messy_rows(spark, messy, empty):
    labels = messy.selectExpr("doc_id", "CASE WHEN text LIKE '%idiot%' THEN 1 ELSE 0 END AS toxic")
    labels = labels.unionByName(spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    rows = toxicity.toxicity(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    kept = toxicity.keep_harmless(messy, labels)
    assert kept.columns == messy.columns
    assert toxicity.keep_harmless(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(messy, labels.where("toxic > 1")).collect()} == {0.5}


def test_features_are_words_pairs_and_skips_once_per_text():
    rows, found = toxicity.features_of(pa.array(["a b c a b", "A b", None, ""]))
    counts = np.bincount(rows, minlength=4).tolist()
    # a b c; ab bc ca; a_c b_a c_b - and a, b, ab
    assert counts == [9, 3, 0, 0]
    assert set(found[rows == 1]) <= set(found[rows == 0])
