import random
import re
from itertools import combinations

import numpy as np
import pytest
from conftest import SMALL

from clearbook.llm import decontaminate as d
from clearbook.llm import queries


def tokens(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def overlaps(text, item):
    """Whether some alignment has a window with enough equal tokens, or a long run of them, by trying all of them."""
    size = min(d.WINDOW, len(item))
    if len(item) < d.MIN_ITEM:
        return False
    for p in range(len(text) - size + 1):
        for q in range(len(item) - size + 1):
            if sum(a == b for a, b in zip(text[p : p + size], item[q : q + size])) >= d.needed(size):
                return True
    runs = {tuple(item[q : q + d.RUN]) for q in range(len(item) - d.RUN + 1)}
    return any(tuple(text[p : p + d.RUN]) in runs for p in range(len(text) - d.RUN + 1))


@pytest.mark.parametrize("size", range(d.MIN_SPACED, d.WINDOW + 1))
def test_the_masks_are_lossless(size):
    masks = [m for m in d.all_masks([size]) if d._uses(m, np.array([size]))[0]]
    assert masks
    for gone in combinations(range(size), size - d.needed(size)):
        equal = [i not in gone for i in range(size)]
        assert any(
            all(equal[at + k] for k, c in enumerate(mask) if c == "1")
            for mask in masks
            for at in range(size - len(mask) + 1)
        )


def test_every_mask_of_long_items_fits_into_a_run():
    assert all(len(mask) <= d.RUN for mask in d.MASKS)


def test_short_items_changed_items_and_excerpts(spark):
    """A whole item of 7 tokens, one of 19 with a changed token, and 19 tokens of an item of 30."""
    names = lambda name, n: [f"{name}{i}" for i in range(n)]
    bench = spark.createDataFrame([(7, " ".join(names("a", 7))), (19, " ".join(names("b", 19))), (30, " ".join(names("c", 30)))],
                                  "item_id long, text string")
    changed = names("b", 19)
    changed[9] = "x"
    docs = [
        (1, names("a", 7), 7), (2, changed, 19), (3, names("c", 30)[5:24], 30), (4, names("a", 6), None),
        (5, names("b", 12), None), (6, names("c", 30)[5:17], None), (7, [*names("a", 3), "x", *names("a", 7)[4:]], None),
        (8, names("b", 13), 19),
    ]
    rows = spark.createDataFrame([(i, " ".join(["some", *t, "more"])) for i, t, _ in docs], "doc_id long, text string")
    found = {r.doc_id: r.item_id for r in d.contaminated(rows, bench).collect()}
    assert found == {i: item for i, _, item in docs if item}


def test_planted_overlaps_against_all_alignments(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    items = [[rng.choice(words) for _ in range(rng.randint(5, 45))] for _ in range(25)] + [[]]
    texts = []
    for n in range(120):
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        item = rng.choice(items)
        begin = rng.randint(0, max(0, len(item) - 12))
        piece = list(item[begin : begin + rng.randint(10, 40)])
        for _ in range(rng.randint(0, 6)):
            if piece:
                piece[rng.randrange(len(piece))] = rng.choice(words)
        at = rng.randint(0, len(text))
        texts.append((n, ", ".join(text[:at] + [w.upper() for w in piece] + text[at:])))
    texts += [(500, None), (501, ""), (None, " ".join(items[0]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(
        [(i, " ".join(t)) for i, t in enumerate(items)] + [(99, " ".join(items[3])), (100, None)], "item_id long, text string"
    )
    found = {(r.id, r.item_id) for r in d.overlaps(docs, bench).collect()}
    expected = {(i, k) for i, t in texts for k, item in enumerate(items) if overlaps(tokens(t), item)}
    assert found == expected and len(found) > 30


def proposed_and_found(spark, monkeypatch, texts, items):
    """(number of proposed alignments, pairs found) for lists of tokens."""
    counts = []
    proposals = d.proposals

    def counted(*args):
        made = d.stage(proposals(*args), "proposals")
        counts.append(made.count())
        return made

    monkeypatch.setattr(d, "proposals", counted)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = {(r.id, r.item_id) for r in d.overlaps(docs, bench).collect()}
    return counts[0], found


def test_a_phrase_that_many_items_share_proposes_few_alignments(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    phrase = "which of the following best describes the main idea".split()

    def around():
        return [*rng.choices(words, k=rng.randint(5, 20)), *phrase, *rng.choices(words, k=rng.randint(5, 20))]

    items, texts = [around() for _ in range(400)], [around() for _ in range(400)]
    for text in range(0, 400, 10):
        item = rng.randrange(400)
        piece = list(items[item])
        for at in rng.sample(range(len(piece)), 3):
            piece[at] = rng.choice(words) if at % 2 else piece[at]
        texts[text] = [*rng.choices(words, k=9), *piece, *rng.choices(words, k=9)]
    count, found = proposed_and_found(spark, monkeypatch, texts, items)
    near = [(t, i) for t in range(400) for i in range(400) if len({*texts[t]} & {*items[i]}) >= 11]
    expected = {(t, i) for t, i in near if overlaps(texts[t], items[i])}
    assert found == expected and len(found) >= 40
    assert count < 2_000


def test_a_long_template_overlaps_with_all_its_items(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    long = [f"t{i}" for i in range(18)]
    items = [[*long, *rng.choices(words, k=12)] for _ in range(30)] + [[*rng.choices(words, k=6), *long[:9], *rng.choices(words, k=8)] for _ in range(30)]
    texts = [[*rng.choices(words, k=10), *long, *rng.choices(words, k=10)] for _ in range(12)]
    texts += [[*rng.choices(words, k=4), *long[:9], *rng.choices(words, k=20)] for _ in range(12)]
    changed = [t if i % 6 else "x" for i, t in enumerate(long)]
    texts += [[*changed, *rng.choices(words, k=3)], list(items[40]), [*items[41][2:]]]
    _, found = proposed_and_found(spark, monkeypatch, texts, items)
    expected = {(t, i) for t in range(len(texts)) for i in range(len(items)) if overlaps(texts[t], items[i])}
    assert found == expected and len(found) > 300


@pytest.mark.parametrize("seed", range(3))
def test_hot_seeds_against_all_alignments(spark, monkeypatch, seed):
    """Few words, so that nearly all seeds are hot and many tokens around them common."""
    monkeypatch.setattr(d, "HOT", 2)
    rng = random.Random(seed)
    words = ["a", "b", "c", "d", "e", "f", "g", "h"]
    phrases = [rng.choices(words, k=rng.randint(6, 14)) for _ in range(4)]
    bit = lambda: rng.choice(phrases) if rng.random() < 0.6 else rng.choices(words, k=rng.randint(1, 6))
    items = [sum((bit() for _ in range(rng.randint(1, 4))), []) for _ in range(40)]
    texts = [sum((bit() for _ in range(rng.randint(1, 6))), []) for _ in range(40)]
    _, found = proposed_and_found(spark, monkeypatch, texts, items)
    first = {}
    for i, item in enumerate(items):
        first.setdefault(tuple(item), i)
    expected = {(t, i) for t in range(len(texts)) for i in first.values() if overlaps(texts[t], items[i])}
    assert found == expected and len(expected) > 20


def test_filter_keeps_clean_rows_and_columns(spark, messy, empty):
    leak = " ".join(f"leak{i}" for i in range(30))
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    dirty = messy.limit(1).selectExpr(*[f"'{leak}' AS text" if c == "text" else c for c in messy.columns])
    kept = d.decontaminate(messy.unionByName(dirty), bench)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    assert d.decontaminate(empty, bench).count() == 0
    nothing = bench.where("item_id < 0")
    assert d.decontaminate(messy, nothing).count() == messy.count()


def test_query_against_all_alignments(spark):
    found = {r.doc_id for r in queries.op1_decontaminate(spark, SMALL).collect()}
    number = {}
    coded = lambda text: np.array([number.setdefault(w, len(number)) for w in tokens(text)], dtype=np.int64)
    items = [coded(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    expected = set()
    for doc in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        text = coded(doc.text)
        for item in items:
            if len(np.intersect1d(text, item)) >= d.MIN_ITEM and any(
                d.best_overlap(text, item, at) for at in range(-len(item), len(text))
            ):
                expected.add(doc.doc_id)
                break
    assert found == expected


def test_items_whose_ids_repeat_or_are_null_are_looked_for(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(25)) for name in "abc")
    bench = spark.createDataFrame([(1, a), (1, b), (1, "aa"), (None, c)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {a} y"), (2, f"x {b} y"), (3, f"x {c} y"), (4, "x y"), (5, f"{a} {b} {c}")], "doc_id long, text string")
    found = {r.doc_id: (r.item_id, r.n_items) for r in d.contaminated(docs, bench).collect()}
    assert found.keys() == {1, 2, 3, 5} and (found[1], found[2], found[3]) == ((1, 1), (1, 1), (None, 1))
    assert found[5][1] == 2 and [r.doc_id for r in d.decontaminate(docs, bench).collect()] == [4]
