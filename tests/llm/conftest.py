import random

import pytest

SMALL = "/root/testdata/sf0.001"

# Columns beside the documents' own, named like those that the operators make or use.
EXTRA = "ids string, _part int, score string, fingerprint int, removed int, spans string, kept int, digest string, key int"

PIECES = [
    "the", "of", "and", "Thing", "é", "ß", "中文", "word", "idiot", "x.y", "a@b.c", "10.0.0.1", "'s", "...", "#$", "№5",
    "\n", "\n\n", "\t", "  ", " ", "\x1c", " ", " ", "😀", "A B. C d! ", "<|endoftext|>",
]


def messy_rows():
    """(doc_id, text, lang, source, n_chars) with nulls everywhere, repeated rows, empty and very long texts."""
    rng = random.Random(11)
    rows = []
    for i in range(120):
        text = rng.choice(["", " "]).join(rng.choice(PIECES) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(text)))
    long = " ".join(f"word{rng.randint(0, 5000)}" for _ in range(60_000))
    rows += [(200, long, "en", "a", len(long)), (201, "x" * 300_000, "en", "a", None)]
    rows += [(300, None, "en", "a", None), (301, "", None, None, 0), (302, " \n\t ", "en", "b", 4)]
    rows += [(None, "no id at all", "en", "a", 12), (None, None, None, None, None), (None, "no id at all", "en", "a", 12)]
    rows += [rows[3]] * 5 + [(7, "same id, other text", "en", "a", 19)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    """The rows as a table of several files, with extra columns."""
    path = str(tmp_path_factory.mktemp("messy") / "documents")
    rows = [(*row, "old", 1, None, 2, 3, "s", None, "d", 4) for row in messy_rows()]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("doc_id = -1")
