import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from conftest import SMALL

from clearbook.llm import bpe, queries
from clearbook.llm.common import text_bytes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def table():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_messy_rows_encode_as_in_the_library(spark, messy, table, encoding):
    encoded = bpe.encode(messy, table, public_tokenizers.PATTERN, block_tokens=500)
    assert encoded.columns == [c for c in messy.columns if c not in ("text", "ids")] + ["ids"]
    found = sorted((str(r.doc_id), r.ids) for r in encoded.collect())
    assert found == sorted((str(r.doc_id), encoding.encode_ordinary(r.text or "")) for r in messy.collect())
    at_once = bpe.encode(messy, table, public_tokenizers.PATTERN, block_tokens=500, decoded_column="decoded")
    for decoded in (bpe.decode(encoded, table), at_once):
        assert sorted((str(r.doc_id), bytes(r.decoded)) for r in decoded.select("doc_id", "decoded").collect()) == sorted(
            (str(r.doc_id), (r.text or "").encode()) for r in messy.collect()
        )


def test_white_space_runs_are_cut_as_the_pattern_does(spark, tmp_path, table, encoding):
    rng = random.Random(5)
    pieces = [" ", "  ", "\n", "\n ", " \n", " ", "  ", "\x1c", "\x85", "a", "B1", "'s", "'ll", "é", "!", " x", "\t"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(1500)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    found = {r.doc_id: r.ids for r in bpe.encode(docs, table, public_tokenizers.PATTERN, block_tokens=3000).collect()}
    assert found == {i: encoding.encode_ordinary(t) for i, t in enumerate(texts)}


def test_pieces_of_random_texts_are_those_of_the_pattern():
    rng = random.Random(9)
    signs = "abZ019.,;#$-_()'\"/ \n\r\t\x0b\x1c\x85\xa0éÀß÷×²½中文٣ª\u0301\u200b\u2028😀" + "   eee" + "'"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(20_000)]
    compiled = regex.compile(public_tokenizers.PATTERN)
    data, offsets = text_bytes(pa.array(texts))
    bounds = bpe._pieces(data, offsets, compiled)
    raw = data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [piece for text in texts for piece in compiled.findall(text)]


@pytest.mark.parametrize("pattern", [r"\w+|\W+", r"\p{L}+", r" ?[a-z0-9]+|\s+|.", r"\S+\s?|\s+"])
def test_other_patterns_are_refused(messy, table, pattern):
    with pytest.raises(ValueError, match="pattern"):
        bpe.encode(messy, table, pattern)


def test_documents_that_change_between_reads_stop_the_job(table):
    """The words of a block come in another order on the second read, or one text is another."""
    pattern, kept = public_tokenizers.PATTERN, pa.schema([])
    words = pa.schema([("block", pa.int64()), ("seq", pa.int32()), ("word", pa.binary())])
    texts = pa.schema(
        [("block", pa.int64()), ("seq", pa.int32()), ("payload", pa.binary()), ("size", pa.int32()), ("hash", pa.int64()),
         ("carried", pa.struct(kept))]
    )

    def batch(*rows):
        return pa.record_batch([pa.array(rows), pa.array([0] * len(rows), pa.int64())], names=["text", "part"])

    def joined(first, second):
        word_rows = bpe._cut_blocks(bpe.WORD, "text", "part", pattern, 100, words)(iter([first]))
        rows = sorted((r["word"], r["block"], r["seq"]) for b in word_rows for r in b.to_pylist())
        ordered = pa.RecordBatch.from_pylist([{"block": b, "seq": s, "word": w} for w, b, s in rows], schema=words)
        answers = pa.Table.from_batches(bpe._encode_sorted(table, pattern)(iter([ordered]))).to_pylist()
        asked = [r for b in bpe._cut_blocks(bpe.TEXT, "text", "part", pattern, 100, texts)(iter([second])) for r in b.to_pylist()]
        schema = pa.schema([("kind", pa.int32()), *texts])
        rows = [{"kind": bpe.WORD, "seq": 0, "carried": {}, **r} for r in answers] + [{"kind": bpe.TEXT, **r} for r in asked]
        out = pa.schema([("ids", pa.list_(pa.int32()))])
        found = bpe._assemble(table, out, False)(iter([pa.RecordBatch.from_pylist(rows, schema=schema)]))
        return [r["ids"] for b in found for r in b.to_pylist()]

    same = batch("one two three", "four five", "", None)
    assert [bool(ids) for ids in joined(same, same)] == [True, True, False, False]
    for other in (batch("two one three", "four five", "", None), batch("one two three", "four four", "", None),
                  batch("six", "four five", "", None)):
        with pytest.raises(RuntimeError, match="changed between two reads"):
            joined(same, other)


def test_no_documents(empty, table):
    encoded = bpe.decode(bpe.encode(empty, table, public_tokenizers.PATTERN), table)
    assert encoded.count() == 0


def test_query(spark, encoding):
    found = {r.doc_id: r for r in queries.op2_byte_bpe(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = encoding.encode_ordinary(doc.text)
        assert found[doc.doc_id].n_tokens == len(ids)
        assert found[doc.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc.doc_id].decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()
