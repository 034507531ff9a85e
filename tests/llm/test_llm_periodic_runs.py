import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from clearbook.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words, shortest=12):
    """By the definition: every lag, every stretch of equal pairs, the smallest period of each."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(shortest, 2 * q):
                found.setdefault((i, length), q)  # lags ascend, so the first is the smallest
            i = j
    return sorted(((i, length, q) for (i, length), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_of(words, runs):
    lost = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in lost]


def random_words(rng):
    """Few words, loops, loops in loops, and broken loops: texts with many runs that touch and overlap."""
    words = []
    while len(words) < rng.randint(0, 150):
        kind = rng.random()
        if kind < 0.3:
            words += rng.choices("ab", k=rng.randint(1, 12))
        elif kind < 0.7:
            unit = rng.choices("abc", k=rng.randint(1, 14)) * rng.randint(1, 3)
            words += unit * rng.randint(1, 6) + unit[: rng.randint(0, len(unit))]
        elif kind < 0.9 and words:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(1, 60)]
        else:
            words += [f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 10))]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_the_definition(seed):
    rng = random.Random(seed)
    lists = [random_words(rng) for _ in range(150)]
    texts = pa.array([rng.choice([" ", "\n", "\t "]).join(words) for words in lists])
    runs, joined = periodic_runs.collapsed(texts)
    for words, own, text in zip(lists, runs.to_pylist(), joined.to_pylist(), strict=True):
        expected = runs_of(words)
        assert [(r["start"], r["length"], r["period"]) for r in own] == expected
        assert text == " ".join(kept_of(words, expected))


@pytest.mark.parametrize("shortest", [2, 3, 5, 8, 13, 30])
def test_other_shortest_lengths(shortest):
    rng = random.Random(shortest)
    for _ in range(80):
        words = random_words(rng)
        found = periodic_runs.find_runs(np.unique(words, return_inverse=True)[1].astype(np.int64), shortest)
        assert list(zip(*(x.tolist() for x in found), strict=True)) == runs_of(words, shortest)


def test_fibonacci_words_and_squares_at_the_border():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    for text in (b, b[:377], "aabaabaa" * 2 + "c" + "baabaabaa" * 2, "ab" * 6, "a" * 12, "a" * 11, "abcdef" * 2, "abcde" * 2):
        found = periodic_runs.find_runs(np.array([ord(c) - 97 for c in text]))
        assert list(zip(*(x.tolist() for x in found), strict=True)) == runs_of(text)


def test_a_long_loop_takes_few_seeds(monkeypatch):
    listed = []
    seeds = periodic_runs._seeds

    def counted(*args):
        found = seeds(*args)
        listed.append(len(found[0]))
        return found

    monkeypatch.setattr(periodic_runs, "_seeds", counted)
    n = 300_000
    loop = np.arange(n) % 3
    assert [x.tolist() for x in periodic_runs.find_runs(loop)] == [[0], [n], [3]]
    assert sum(listed) < 2 * n
    blocks = np.where(np.arange(n) % 1000 == 999, 1, 0)  # one word 999 times, another once, over and over
    listed.clear()
    start, length, period = periodic_runs.find_runs(blocks)
    assert (start[0], length[0], period[0]) == (0, 999, 1) and (0, n, 1000) in zip(start, length, period, strict=True)
    assert sum(listed) < 8 * n


def test_messy_rows(messy, empty):
    rows = periodic_runs.collapse_runs(messy).collect()
    truth = []
    for r in messy.collect():
        words = WORD.findall(r.text or "")
        runs = [] if len(words) > 5000 else runs_of(words)  # the long ones are of random words
        truth.append((str(r.doc_id), r.lang, str(runs), " ".join(kept_of(words, runs))))
    assert sorted(map(str, truth)) == sorted(str((str(r.doc_id), r.lang, str([tuple(x) for x in r.runs]), r.text)) for r in rows)
    assert set(messy.columns) < set(rows[0].asDict())
    assert periodic_runs.collapse_runs(empty).count() == 0


def looped(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SMALL).collect()}
    assert len(found) == len(docs)
    some = 0
    for doc in docs:
        words = looped(doc.doc_id, WORD.findall(doc.text or ""))
        runs = runs_of(words)
        row = found[doc.doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        some += bool(runs)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row.collapsed_sha256 == sha(" ".join(kept_of(words, runs)))
    assert some > 20


def test_query_without_rows_or_texts(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, None, None, None) for i, t in ((None, "a " * 20), (5, None), (6, ""), (7, " \n"), (13, "b"), (None, None))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "some" / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path / "some")).collect()
    assert sorted(r.n_runs for r in found) == [0, 0, 0, 0, 0, 1]
    assert {r.collapsed_sha256 for r in found if r.doc_id in (5, 6, 7)} == {sha("")}
