import random
import re
from collections import defaultdict

import pytest
from conftest import SMALL

from clearbook.llm import line_dedup, queries

CUTS = {"line": r"(?<=\n)", "paragraph": r"(?<=\n\n)", "sentence": r"(?<=\n)|(?<=[.!?])(?=[\x20\x09-\x0D])"}


def lost(docs, unit, min_words, joined_words):
    """Places that later occurrences leave, documents by id; a document that comes twice counts once.

    A short unit is compared together with the next ones until there are enough words, and with those before it.
    """
    seen, places = set(), defaultdict(list)
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        text = text or ""
        cuts = sorted({0, len(text), *(m.end() for m in re.finditer(CUTS[unit], text))})
        pieces = []
        for a, b in zip(cuts, cuts[1:]):
            words = tuple(w.lower() for w in re.findall(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", text[a:b]))
            left = b - a - len(text[a:b].lstrip(" \t\n\v\f\r"))
            if words:
                pieces.append((words, a + left, a + len(text[a:b].rstrip(" \t\n\v\f\r"))))
        count = lambda a, b: sum(len(words) for words, *_ in pieces[a:b])
        stretches = set()
        for at in range(len(pieces)):
            if count(at, at + 1) >= min_words:
                stretches.add((at, at + 1))
                continue
            ahead = [b for b in range(at + 1, len(pieces) + 1) if count(at, b) >= joined_words]
            back = [a for a in range(at + 1) if count(a, at + 1) >= joined_words]
            stretches |= {(at, ahead[0])} if ahead else set()
            stretches |= {(back[-1], at + 1)} if back else set()
        found = []
        for a, b in sorted(stretches):
            words = sum((words for words, *_ in pieces[a:b]), ())
            if words in seen:
                found.append((pieces[a][1], pieces[b - 1][2]))
            seen.add(words)
        for start, end in sorted(found):
            if places[doc_id] and start <= places[doc_id][-1][1]:
                places[doc_id][-1] = (places[doc_id][-1][0], max(end, places[doc_id][-1][1]))
            else:
                places[doc_id].append((start, end))
    return {doc_id: own for doc_id, own in places.items() if own}


def without(text, places):
    if not places:
        return text
    kept, at = [], 0
    for a, b in sorted(places):
        kept.append(text[at:a])
        at = b
    return "".join([*kept, text[at:]])


@pytest.mark.parametrize("unit", line_dedup.UNITS)
def test_random_texts(spark, unit):
    rng = random.Random(4)
    pieces = ["A ", "b ", "c. ", "D\n", "\n", "\n\n", "é ", "x!? ", "y.", "  ", "Ω ", "#"]
    pool = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(150)]
    ends = [" ", "\n", "\n\n", "", ". "]
    docs = [(i, "".join(rng.choice(pool) + rng.choice(ends) for _ in range(rng.randint(0, 8)))) for i in range(400)]
    docs += [(900, None), (901, "")]
    expected = lost(docs, unit, 3, 5)
    found = line_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string"), unit, 3, joined_words=5).collect()
    assert len(found) == len(docs) and len(expected) > 50
    for row in found:
        assert [(p.start, p.end) for p in row.removed] == sorted(expected.get(row.doc_id, []))
    texts = dict(docs)
    assert {r.doc_id: r.text for r in found} == {i: without(texts[i], expected.get(i)) for i in texts}


def test_messy_rows(messy, empty):
    found = line_dedup.remove(messy, "line", 2, joined_words=3)
    assert sorted(found.columns) == sorted(messy.columns)
    expected = lost([(r.doc_id, r.text) for r in messy.collect() if r.doc_id != 7], "line", 2, 3)
    rows = line_dedup.remove(messy.where("doc_id <> 7 OR doc_id IS NULL"), "line", 2, joined_words=3).collect()
    assert len(rows) == messy.where("doc_id <> 7 OR doc_id IS NULL").count()
    for row in rows:
        assert [(p.start, p.end) for p in row.removed] == sorted(expected.get(row.doc_id, []) if row.text else [])
    assert line_dedup.remove(empty).count() == line_dedup.repeats(empty).count() == 0
    with pytest.raises(ValueError):
        line_dedup.units(messy, "page")


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected = lost(docs, "sentence", line_dedup.MIN_WORDS, line_dedup.JOINED_WORDS)
    found = {r.doc_id: r for r in queries.op9_line_dedup(spark, SMALL).collect()}
    assert {i: r.removed for i, r in found.items()} == {
        i: ",".join(f"{a}:{b}" for a, b in sorted(places)) for i, places in expected.items()
    }
    assert all(r.chars_removed == sum(b - a for a, b in expected[i]) for i, r in found.items())


def test_a_passage_inside_lines_is_found(spark):
    passage = "Once upon a midnight dreary I pondered. Over many a quaint and curious volume. Of forgotten lore all the night."
    docs = [(1, f"First words here {passage} and more."), (2, f"Other beginning of it.\nSomething {passage} else.")]
    row = line_dedup.repeats(spark.createDataFrame(docs, "doc_id long, text string"), "sentence").first()
    assert row.id == 2 and [docs[1][1][p.start : p.end] for p in row.removed] == [
        "Over many a quaint and curious volume.", "Of forgotten lore all the night.",
    ]


@pytest.mark.parametrize("unit", line_dedup.UNITS)
def test_a_passage_of_short_units_is_found(spark, unit):
    glue = {"line": "\n", "paragraph": "\n\n", "sentence": " "}[unit]
    rng = random.Random(1)
    passage = glue.join(" ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(1, 4))) + "." for _ in range(50))
    docs = [(1, f"Begins like this.{glue}{passage}{glue}Ends so."), (2, f"Yes.{glue}No.{glue}{passage}{glue}And on.")]
    found = line_dedup.remove(spark.createDataFrame(docs, "doc_id long, text string"), unit).collect()
    kept = {r.doc_id: r.text for r in found}
    assert kept[1] == docs[0][1]
    assert kept[2].split() == ["Yes.", "No.", "And", "on."]


def test_short_units_that_repeat_by_chance_stay(spark):
    docs = [(1, "Yes. It was a long day in the valley."), (2, "Yes. Nobody had come to the old mill."), (3, "A b. C d.")]
    assert line_dedup.repeats(spark.createDataFrame(docs, "doc_id long, text string"), "sentence").count() == 0
