import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from clearbook.llm import queries, token_files

VOCABULARY = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(VOCABULARY)


def test_messy_rows(spark, messy, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(token_files.tokenize(messy, VOCABULARY, 2, shards=4), path)
    rows = token_files.with_starts(token_files.read(spark, path)).collect()
    expected = sorted(
        (str(r.doc_id), tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in messy.collect()
    )
    assert sorted((str(r.doc_id), r.ids) for r in rows) == expected
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert (row.start, row.n_tokens) == (at, len(row.ids))
        at += row.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert {"lang", "source", "n_chars"} <= set(rows[0].asDict())


def test_special_strings_in_texts(spark, tokenizer):
    rng = random.Random(5)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "<|ENDOFTEXT|>", "<", "|>", "a", "'s", " ", "É", "\n"]
    texts = ["a text <|endoftext|> more"] + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.ids for r in token_files.tokenize(rows, VOCABULARY, 2, shards=1).collect()}
    assert found[0] == [320, 4160, 49407, 750, 2]
    for number, text in enumerate(texts):
        assert found[number] == tokenizer.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("dictionary", [False, True])
def test_layout_of_the_files(spark, messy, tmp_path, dictionary):
    path = tmp_path / "tokens"
    token_files.write(token_files.tokenize(messy, VOCABULARY, 2, shards=2), str(path), dictionary)
    files = sorted(path.glob("*.parquet"))
    assert len(files) == 2
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        wanted = "RLE_DICTIONARY" if dictionary else "DELTA_BINARY_PACKED"
        assert wanted in columns["ids.list.element"].encodings and columns["ids.list.element"].has_offset_index
        assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
    # metadata alone, and one document alone
    rows = token_files.read(spark, str(path))
    plan = rows.groupBy("shard").sum("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in (
        rows.where("doc_id = 5")._jdf.queryExecution().executedPlan().toString()
    )


def test_query(spark, tokenizer):
    found = {r.doc_id: r for r in queries.op10_token_files(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    assert len(found) == len(docs)
    at = 0
    for doc in docs:
        ids = tokenizer.encode(doc.text, add_special_tokens=False).ids + [2]
        row = found[doc.doc_id]
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)


def test_no_documents(spark, empty, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(token_files.tokenize(empty, VOCABULARY, 2), path)
    assert token_files.with_starts(token_files.checksums(token_files.read(spark, path))).count() == 0
