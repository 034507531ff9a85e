"""The registered queries of this package: each operator over the whole of its table, reduced to digests."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.llm import (
    bpe,
    context_tree,
    decontaminate,
    filter_audit,
    line_dedup,
    mixing,
    outliers,
    periodic_runs,
    pii,
    revisits,
    simhash,
    token_files,
    toxicity,
)
from clearbook.llm.common import documents
from clearbook.sources.staging import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op2_byte_bpe(spark, folder):
    table = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = documents(spark, folder).select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, table, public_tokenizers.PATTERN, decoded_column="decoded"))


@query
def op4_simhash(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, radius=2)


@query
def op6_toxicity(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query
def op1_decontaminate(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "begin", "size", "equal", "n_items")


@query
def op8_pii(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return pii.digests(pii.find(docs, pii.train(docs)))


@query
def op3_quality_outliers(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text", "lang", "source")
    return outliers.keep_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op10_token_files(spark, folder):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    path = fresh_path(spark, "tokens")
    token_files.write(token_files.tokenize(documents(spark, folder).select("doc_id", "text"), vocabulary, end_id=2), path)
    rows = token_files.with_starts(token_files.read(spark, path))
    return token_files.checksums(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op9_line_dedup(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    # passages are copied into the middle of lines, so the units are sentences
    lost = line_dedup.repeats(docs, unit="sentence")
    places = F.transform("removed", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string")))
    chars = F.aggregate("removed", F.lit(0), lambda total, r: total + r["end"] - r["start"])
    return lost.select(
        F.col("id").alias("doc_id"),
        F.size("removed").alias("n_removed"),
        chars.alias("chars_removed"),
        F.array_join(places, ",").alias("removed"),
    )


@query
def op7_revisits(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return revisits.resolve(revisits.captures_of(pages)).select(
        "record_id", "response_id", "verdict", "payload_digest", F.array_join(lines, "\n").alias("headers")
    )


ORACLES["op7_revisits"] = r"""
WITH crawl AS (
  SELECT page_id, url, md5(html) AS digest, '"' || left(md5(html), 16) || '"' AS tag,
         'day ' || page_id AS day, length(html) AS size,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages
), parts AS (
  SELECT *,
         regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)?$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$'))) AS params
  FROM crawl
), placed AS (
  SELECT *, CASE WHEN host <> '' THEN host || path ||
         CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS page
  FROM parts
), revisit AS (
  SELECT 2 * page_id + 1 AS record_id, page, page_id + 1000 * (1 + page_id % 3) AS time,
         CASE WHEN page_id % 7 = 3 OR page_id % 11 = 5 THEN NULL WHEN page_id % 5 = 4 THEN '"old"' ELSE tag END AS tag,
         CASE WHEN page_id % 11 <> 5 THEN day END AS day
  FROM placed
), matched AS (
  SELECT v.record_id, v.time, v.tag AS sent_tag, v.day AS sent_day, r.page_id, r.tag, r.day, r.digest, r.size
  FROM revisit v ASOF LEFT JOIN placed r ON v.page = r.page AND v.time > r.page_id
), judged AS (
  SELECT *, CASE WHEN page_id IS NULL THEN 'missing'
                 WHEN sent_tag IS NOT NULL THEN CASE WHEN sent_tag = tag THEN 'resolved' ELSE 'mismatch' END
                 WHEN sent_day IS NOT NULL THEN CASE WHEN sent_day = day THEN 'resolved' ELSE 'mismatch' END
                 ELSE 'unverified' END AS verdict
  FROM matched
)
SELECT record_id, 2 * page_id AS response_id, verdict,
       CASE WHEN verdict = 'resolved' THEN digest END AS payload_digest,
       CASE WHEN verdict = 'resolved' THEN
         'Content-Type: text/html' || chr(10) || 'Content-Length: ' || size || chr(10) || 'ETag: ' || tag || chr(10) ||
         'Date: ' || time || chr(10) || 'Cache-Control: max-age=60' END AS headers
FROM judged
"""


@query
def op5_context_tree(spark, folder):
    held_out = F.coalesce(toxicity.fold("doc_id", 7) == 2, F.lit(True))
    scored = context_tree.score(documents(spark, folder).select("doc_id", "text"), ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "bits_per_byte",
    )


@query
def op11_mixing(spark, folder):
    docs = documents(spark, folder).select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.by_rank(docs, [3, 1, 2]), share=1.5, passes=2)
    return mixed.select(
        "doc_id", "size", "source_size", "target", mixing.words_taken().alias("taken"), F.size("pieces").alias("n_pieces")
    )


@query
def op12_filter_audit(spark, folder):
    filters = {
        "A": "n_words < 50",
        "B": "100 * n_distinct < 65 * n_words",
        "C": "100 * n_upper > 5 * n_points",
        "D": "has_symbol",
    }
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return filter_audit.audit(documents(spark, folder), labels, filters, copies="E")


ORACLES["op12_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marked AS (
  SELECT part, t.doc_id,
         CAST(len(words) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
         + 16 * CAST(coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS INT) AS mask
  FROM texts t
), flags AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY 1
), cells AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM marked LEFT JOIN flags USING (doc_id) GROUP BY 1, 2
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), walks AS (
  SELECT filter_order, step, letter, bit,
         coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM orders, range(1, 6) r(step), letters WHERE letter = filter_order[step]
), told AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & (CAST(earlier AS INT) | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & CAST(earlier AS INT) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, walks GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS BIGINT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM told
"""


def _looped(doc_id: Column, text: Column) -> Column:
    """The text, or for every tenth document by checksum its words with a tail that goes in circles."""
    number = F.crc32(doc_id.cast("string"))

    def in_circles(words: Column) -> Column:
        n, g = F.greatest(F.size(words), F.lit(1)), F.floor(number / 10)
        at = g % n
        period = 1 + F.floor((n - at) / (3 + g % 8))
        places = F.transform(
            F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
            lambda i: F.when(i < at, i).otherwise(at + (i - at) % period),
        )
        return F.array_join(F.transform(places, lambda i: F.get(words, i.cast("int"))), " ")

    # the words become a variable of the lambda, or they would be cut out of the text anew for every place
    words = F.array(F.regexp_extract_all(text, F.lit(mixing.WORD), F.lit(0)))
    looped = F.transform(words, lambda own: F.when(F.size(own) > 0, in_circles(own)))[0]
    return F.when(number % 10 == 0, F.coalesce(looped, text)).otherwise(text)


@query
def op13_periodic_runs(spark, folder):
    docs = documents(spark, folder).select("doc_id", _looped(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.collapse_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    longest = F.struct(longest["length"].alias("length"), (-longest["col2"]).alias("start"), (-longest["col3"]).alias("period"))
    lines = F.transform(
        "runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        longest["length"].alias("length"),
        longest["period"].alias("period"),
        F.floor(1000 * longest["length"] / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"),
    )
