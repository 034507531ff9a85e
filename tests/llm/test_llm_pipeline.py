import hashlib
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import tiktoken
from conftest import SMALL

from clearbook.llm import bpe, pii, simhash
from clearbook.sources.staging import shared_folder


def test_stages_and_their_effects(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    schema, before = docs.schema, {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    texts = {}
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, SMALL), name)
        if name != "byte_bpe":
            assert docs.schema == schema
        texts[name] = {r.doc_id: getattr(r, "text", None) for r in docs.collect()}
    assert set(before) > set(texts["toxicity"]) > set(texts["simhash_near_duplicates"]) >= set(texts["decontamination"])
    assert not [i for i in set(before) - set(texts["toxicity"]) if labels.get(i) == 0]
    kept = spark.createDataFrame(list(texts["simhash_near_duplicates"].items()), "doc_id long, text string")
    classes = simhash.near_duplicates(kept, 3, 2).collect()
    assert len({r.component_id for r in classes}) == len(classes)
    redacted = texts["personal_data"]
    assert set(redacted) == set(texts["decontamination"]) == set(texts["byte_bpe"])
    assert not [t for t in redacted.values() if pii.base_spans(t)]
    assert all(redacted[i] == t for i, t in texts["decontamination"].items() if not pii.candidates(t) and not pii.base_spans(t))

    table = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ranks = {token: rank for rank, token in enumerate(table)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for row in docs.collect():
        assert row.ids == encoding.encode_ordinary(redacted[row.doc_id]) and row.n_tokens == len(row.ids)
        assert row.decoded_sha256 == hashlib.sha256(redacted[row.doc_id].encode()).hexdigest()


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 100 and "ids" in rows.columns


def test_the_job_deletes_what_it_staged(spark, tmp_path):
    root = Path(shared_folder(spark).removeprefix("file:")) / "clearbook"
    before = set(root.iterdir()) if root.exists() else set()
    corpus_pipeline.write(spark, SMALL, str(tmp_path / "corpus"))
    assert spark.read.parquet(str(tmp_path / "corpus")).count() > 100
    assert set(root.iterdir()) == before


def test_messy_rows_pass_through(spark, messy, empty):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    for docs in (messy, empty):
        columns = docs.columns
        for name, function in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stage(function(spark, docs, SMALL), name)
            assert docs.columns == columns
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert tokens.count() == docs.count()
