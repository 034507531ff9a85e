import random

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from clearbook.llm import queries, revisits

SCHEMA = (
    "record_id long, url string, time long, kind string, status int, etag string, last_modified string, "
    f"payload_digest string, headers {revisits.HEADERS}, payload string, page string, range int, found string"
)


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://WWW.Example.com:80/a/b/?b=2&a=1&utm_source=x#top", "example.com/a/b?a=1&b=2"),
        ("https://example.com", "example.com"), ("https://user:pw@example.com:443/", "example.com"),
        ("https://example.com:8080/x?ref=y", "example.com:8080/x"), ("example.com/A", "example.com/A"),
        ("https://example.com/?reference=1&&", "example.com?reference=1"), ("", None), ("   ", None), (None, None), ("#x", None),
    ],
)
def test_canonical_urls(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(revisits.canonical_url(F.col("url"))).first()[0] == expected


def record(number, url, time, kind, status, etag, modified):
    headers = [("Content-Type", "text/html"), ("ETag", etag), ("Set-Cookie", "a"), ("Set-Cookie", "b")]
    if kind == "revisit":
        headers = [("Date", str(time)), ("etag", etag), ("Content-Length", "0")]
    return (number, url, time, kind, status, etag, modified, f"d{number}", headers, f"body {number}", "old", 1, None)


def expected(records):
    rows = []
    for r in records:
        if r[3] != "revisit":
            continue
        full = [q for q in records if q[3] == "response" and q[4] == 200 and q[1] and q[1] == r[1]
                and None not in (q[2], r[2]) and q[2] < r[2]]
        best = max(full, key=lambda q: (q[2], q[0]), default=None)
        if best is None:
            rows.append((r[0], None, "missing"))
        elif r[5] is not None and best[5] is not None:
            rows.append((r[0], best[0], "resolved" if r[5].removeprefix("W/") == best[5].removeprefix("W/") else "mismatch"))
        elif r[6] is not None and best[6] is not None:
            rows.append((r[0], best[0], "resolved" if r[6] == best[6] else "mismatch"))
        else:
            rows.append((r[0], best[0], "unverified"))
    return sorted(rows)


def random_records(count, urls, seed):
    rng = random.Random(seed)
    return [
        record(
            n, rng.choice(urls), rng.choice([None, *range(count // 3)]), rng.choice(["response", "revisit", "other", None]),
            rng.choice([200, 200, 304, 404, None]), rng.choice([None, "1", "2", "W/1"]), rng.choice([None, "x", "y"]),
        )
        for n in range(count)
    ]


@pytest.mark.parametrize("urls", [["a/b"], ["a/b", "c", "c", "c", "d/e", None, ""]])
def test_against_all_pairs(spark, separate_partitions, urls):
    records = random_records(600, urls, len(urls))
    resolved = revisits.resolve(spark.createDataFrame(records, SCHEMA))
    assert sorted((r.record_id, r.response_id, r.verdict) for r in resolved.collect()) == expected(records)


def test_headers_and_payloads(spark):
    records = [record(1, "a", 1, "response", 200, "t", None), record(2, "a", 5, "revisit", 304, "W/t", None)]
    frame = spark.createDataFrame(records, SCHEMA)
    resolved = revisits.resolve(frame)
    row = revisits.with_payloads(resolved, frame).first()
    assert row.payload == "body 1" and row.payload_digest == "d1"
    assert [tuple(h) for h in row.headers] == [
        ("Content-Type", "text/html"), ("Set-Cookie", "a"), ("Set-Cookie", "b"), ("Date", "5"), ("etag", "W/t"),
    ]


def test_null_headers_repeated_records_and_none(spark):
    plain = record(1, "a", 1, "response", 200, "t", None)
    bare = (2, "a", 5, "revisit", 304, "t", None, None, None, None, None, None, None)
    rows = revisits.resolve(spark.createDataFrame([plain, plain, bare, bare], SCHEMA)).collect()
    assert [(r.record_id, r.response_id, r.verdict) for r in rows] == [(2, 1, "resolved")] * 2
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_its_sql_twin(spark):
    rows = queries.op7_revisits(spark, SMALL).select("record_id", "response_id", "verdict", "payload_digest", "headers")
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
        twin = connection.execute(queries.ORACLES["op7_revisits"]).fetchall()
    assert sorted(map(tuple, rows.collect())) == sorted(twin) and len(twin) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
