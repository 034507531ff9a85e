import random

import pytest
from pyspark.sql import functions as F

from clearbook.functions.text import fallback_match
from clearbook.operators import containment


def brute(values, vocabulary):
    found = {}
    for value in values:
        folded = value.lower()
        hits = [
            (ordinal, entry)
            for ordinal, entry in vocabulary
            if entry and folded.strip() and (entry.lower() in folded or folded in entry.lower())
        ]
        found[value] = min(hits, default=(None, None))[::-1]
    return found


@pytest.mark.parametrize("gram", [2, 3, 6])
def test_against_all_pairs(spark, gram):
    rng = random.Random(gram)

    def text(most):
        return "".join(rng.choices("abAB é-", k=rng.randint(0, most)))

    values = sorted({text(12) for _ in range(300)})
    vocabulary = [(n, text(rng.choice([2, 4, 9, 14]))) for n in range(120)]
    rows = spark.createDataFrame([(v,) for v in values + values[:9] + [None]], "dirty string")
    entries = spark.createDataFrame(vocabulary, "ordinal int, entry string")
    found = containment.first_containing(rows, entries, gram).collect()
    assert {r.dirty: (r.entry, r.ordinal) for r in found} == brute(values, vocabulary)
    assert len(found) == len(values)
    matched = {r.dirty: r.clean for r in containment.match_vocabulary(rows, entries, gram).collect()}
    first = min((n, e) for n, e in vocabulary if e)[1]
    assert matched == {v: (e or first) if v.strip() else v for v, (e, _) in brute(values, vocabulary).items()}


def test_equals_the_rule_for_literal_lists(spark):
    vocabulary = ["Northeast", "West", "Southwest"]
    rows = spark.createDataFrame([("NE",), ("west coast",), ("thwe",), ("WEST",), ("x",)], "dirty string")
    entries = spark.createDataFrame(list(enumerate(vocabulary)), "ordinal int, entry string")
    found = containment.match_vocabulary(rows, entries)
    expected = rows.select("dirty", fallback_match(F.col("dirty"), vocabulary).alias("clean"))
    assert sorted(found.collect()) == sorted(expected.collect())
    assert sorted(r.dirty for r in containment.outside_vocabulary(rows, entries).collect()) == sorted(
        ["NE", "west coast", "thwe", "WEST", "x"]
    )


def test_common_grams_make_few_candidates(spark):
    """All texts share a long word; the anchors are what tells them apart."""
    rows = spark.range(3000).select(F.format_string("please ship Supplier#%09d today", "id").alias("dirty"))
    entries = spark.range(3000).select("id", F.format_string("Supplier#%09d", "id").alias("entry")).withColumnRenamed("id", "ordinal")
    found = containment.first_containing(rows, entries)
    assert found.where("dirty = concat('please ship ', entry, ' today')").count() == 3000
    folded = [df.select(F.lower(c).alias("folded")) for df, c in ((entries, "entry"), (rows, "dirty"))]
    joined = containment._pairs(*folded, 6)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_nothing_to_match(spark):
    rows = spark.createDataFrame([("a",), (" ",), (None,)], "dirty string")
    entries = spark.createDataFrame([], "ordinal int, entry string")
    assert {tuple(r) for r in containment.match_vocabulary(rows, entries).collect()} == {("a", None), (" ", " ")}
    assert containment.first_containing(rows.where("false"), entries).count() == 0
