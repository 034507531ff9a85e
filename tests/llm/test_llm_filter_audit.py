import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from conftest import SMALL
from oracle_check import compare, connect
from pyspark.sql import functions as F

from clearbook.llm import filter_audit, queries

FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_upper > 5 * n_points",
    "D": "has_symbol",
}


def mask_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        (len(words) < 50)
        + 2 * (100 * len(set(words)) < 65 * len(words))
        + 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        + 8 * bool(re.search(r"[#$%&*|]", text))
    )


def test_statistics_of_random_texts():
    rng = random.Random(4)
    pieces = ["a", "b", " ", "\n", "é", "É", "\x1c", "A", "Word", "#", "|", "^", "中", "a b a b", ""]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(2000)] + [None, ""]
    found = filter_audit.statistics_of(pa.array(texts))
    for i, text in enumerate(t or "" for t in texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        truth = (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), bool(re.search(r"[#$%&*|]", text)))
        assert tuple(column[i].item() for column in found) == truth


def test_walk_against_all_subsets():
    rng = np.random.default_rng(1)
    for k in range(1, 7):
        cells = rng.integers(0, 9, (1 << k, 2))
        states = filter_audit.walk(cells, k)
        for state in range(1 << k):
            assert (states[state] == sum(cells[m] for m in range(1 << k) if not m & state)).all()


def brute(rows, good, toxic):
    """Every order, applied one filter after the other to the documents themselves."""
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    parts = {}
    for doc_id, text, source in rows:
        copy = doc_id is not None and doc_id > smallest[text or ""]
        parts.setdefault(source or "", []).append((mask_of(text or "") + 16 * copy, doc_id in good, doc_id in toxic))
    found = {}
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [d for d in left if d[0] & bit]
                redundant = sum(bool(d[0] & bit) for d in docs) - len(gone)
                left = [d for d in left if not d[0] & bit]
                shapley[letter] += len(gone)
                alone = sum(d[0] == bit for d in docs)
                found[part, "".join(order), step] = [
                    len(left), len(gone), redundant, alone, sum(d[1] for d in gone), sum(d[2] for d in gone)
                ]
        for (own, order, step), row in found.items():
            if own == part:
                row.append(shapley[order[step - 1]])
    return found


def test_messy_rows(spark, messy, empty):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 3 // 2) for i in range(0, 120, 2)] + [(4, 1, 1), (None, 1, 1), (7, None, 1)],
        "doc_id long, quality long, toxic long",
    )
    marks = labels.collect()
    good = {r.doc_id for r in marks if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in marks if r.toxic == 1 and r.doc_id is not None}
    rows = filter_audit.audit(messy, labels, FILTERS, copies="E").collect()
    found = {tuple(r)[:3]: list(r)[3:] for r in rows}
    assert len(rows) == len(found)
    assert found == brute([(r.doc_id, r.text, r.source) for r in messy.collect()], good, toxic)
    assert filter_audit.audit(empty, labels, FILTERS, copies="E").count() == 0
    assert filter_audit.audit(messy, labels.where("doc_id < 0"), FILTERS).agg(F.sum("good_lost")).first()[0] == 0


def test_copies_by_id(spark):
    rows = [(1, "x"), (2, "x"), (2, "x"), (3, "y"), (None, "x"), (None, "y"), (1, "x"), (4, "z")]
    df = spark.createDataFrame(rows, "doc_id int, digest string")
    marked = filter_audit.mark_copies(df, "copy").collect()
    assert sorted((str(r.doc_id), r.digest, r.copy) for r in marked) == sorted(
        (str(i), d, i == 2) for i, d in rows
    )


def test_query_against_sql(spark):
    with connect(SMALL) as connection:
        count, difference = compare(queries.op12_filter_audit(spark, SMALL), connection, queries.ORACLES["op12_filter_audit"])
    assert difference is None and count == 20 * 600
