"""Not-modified revisits of a web archive, resolved to the full response they stand for.

A revisit record says that a page had not changed and carries no payload. It is
resolved to the latest earlier full response of the same canonical URL, if their
validators agree, and gets that response's headers with those replaced that a
not-modified answer may update.

The as-of join is a sort, not a join of all pairs of a URL: records are dealt by
ranges of (URL, time), the last response is carried forward within each range,
and one row per range carries it across ranges. A URL with any share of all
records so spreads over as many ranges as it fills. Payloads stay where they are;
only keys, validators and headers move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.sources.staging import stage

# Header fields that a 304 answer sends and so may update (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

# Parameters that do not choose what a page shows.
_TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$"

HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without trailing slash, sorted parameters.

    Scheme, user, fragment and tracking parameters are dropped. A blank or null
    URL, or one without a host, is null.
    """
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, r"^([^/?]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":(80|443)?$", ""))
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    wanted = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(_TRACKING)))
    tail = F.when(F.size(wanted) > 0, F.concat(F.lit("?"), F.array_join(wanted, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def _merged(response: Column, revisit: Column) -> Column:
    """The response's headers, the permitted ones of the revisit in place of its own."""
    none = F.array().cast(HEADERS)
    response, revisit = F.coalesce(response, none), F.coalesce(revisit, none)
    updates = F.filter(revisit, lambda h: F.lower(h["name"]).isin(*PERMITTED))
    names = F.transform(updates, lambda h: F.lower(h["name"]))
    kept = F.filter(response, lambda h: ~F.array_contains(names, F.lower(F.coalesce(h["name"], F.lit("")))))
    return F.concat(kept, updates)


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: (record_id, response_id, verdict, payload_digest, headers).

    ``records`` has record_id, url, time (any ordered type), kind ('response' or
    'revisit'), status, etag, last_modified, payload_digest and headers; other
    columns are not looked at. A full response has kind 'response' and status
    200. Of several at the latest earlier time, the largest record_id counts; a
    response at the time of the revisit itself is not earlier.

    The verdict is ``resolved`` if the entity tags agree (weakly), or, where one
    side has none, the modification dates do; ``mismatch`` if they differ;
    ``unverified`` if there is nothing to compare; ``missing`` without an earlier
    response, or without URL or time. Only a resolved revisit has digest and
    headers. Repeated records are rows of their own; no records give no rows.
    """
    none = F.lit(None).cast(HEADERS)
    is_response = (F.col("kind") == "response") & (F.col("status") == 200)
    slim = records.where(is_response | (F.col("kind") == "revisit")).select(
        "record_id",
        canonical_url(F.col("url")).alias("page"),
        "time",
        is_response.alias("full"),
        "etag",
        "last_modified",
        "payload_digest",
        F.coalesce(F.col("headers").cast(HEADERS), none).alias("headers"),
    )
    placed = F.col("page").isNotNull() & F.col("time").isNotNull()
    # at equal times a revisit comes before a response, so that it does not see it
    order = ["page", "time", "full", "record_id"]
    ranged = stage(slim.where(placed).repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "captures")

    response = F.struct("record_id", "etag", "last_modified", "payload_digest", "headers")
    bounds = ranged.groupBy("range").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    last_seen = (
        ranged.where("full")
        .groupBy("range", "page")
        .agg(F.max_by(response, F.struct("time", "record_id")).alias("seen"))
    )
    # a page goes on in the next range only if it is the last of its range: one row for each range
    tails = bounds.join(last_seen, (bounds["range"] == last_seen["range"]) & (bounds["last"] == last_seen["page"]), "left")
    ends = tails.select(bounds["range"], F.col("last").alias("page"), "seen")
    heads = bounds.select("range", F.col("first").alias("page"), F.lit(None).cast(ends.schema["seen"].dataType).alias("seen"))
    before = W.partitionBy("page").orderBy("range", "is_end").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        ends.withColumn("is_end", F.lit(1))
        .unionByName(heads.withColumn("is_end", F.lit(0)))
        .withColumn("carried", F.last("seen", ignorenulls=True).over(before))
        .where("is_end = 0 AND carried IS NOT NULL")
        .select("range", "page", "carried")
    )
    earlier = W.partitionBy("range", "page").orderBy("time", "full", "record_id").rowsBetween(W.unboundedPreceding, -1)
    followed = ranged.withColumn("seen", F.last(F.when(F.col("full"), response), ignorenulls=True).over(earlier)).where("NOT full")
    matched = followed.join(carried, ["range", "page"], "left").withColumn("found", F.coalesce("seen", "carried"))
    lost = slim.where(~placed & ~F.col("full")).withColumn("found", F.lit(None).cast(ends.schema["seen"].dataType))
    columns = ["record_id", "etag", "last_modified", "headers", "found"]
    return _judged(matched.select(columns).unionByName(lost.select(columns)))


def _judged(matched: DataFrame) -> DataFrame:
    found = F.col("found")
    both_tags = F.col("etag").isNotNull() & found["etag"].isNotNull()
    both_dates = F.col("last_modified").isNotNull() & found["last_modified"].isNotNull()
    same_tag, same_date = _strong(F.col("etag")) == _strong(found["etag"]), F.col("last_modified") == found["last_modified"]
    verdict = (
        F.when(found.isNull(), "missing")
        .when(both_tags, F.when(same_tag, "resolved").otherwise("mismatch"))
        .when(both_dates, F.when(same_date, "resolved").otherwise("mismatch"))
        .otherwise("unverified")
    )
    resolved = F.col("verdict") == "resolved"
    return matched.withColumn("verdict", verdict).select(
        "record_id",
        found["record_id"].alias("response_id"),
        "verdict",
        F.when(resolved, found["payload_digest"]).alias("payload_digest"),
        F.when(resolved, _merged(found["headers"], F.col("headers"))).alias("headers"),
    )


def with_payloads(resolved: DataFrame, records: DataFrame, payload_column: str = "payload") -> DataFrame:
    """The resolved revisits as full records: the payload of the response beside the merged headers.

    A response that very many revisits stand for is a join key that Spark can split.
    """
    payloads = records.select(F.col("record_id").alias("response_id"), payload_column)
    return resolved.where(F.col("verdict") == "resolved").join(payloads, "response_id", "left")


def captures_of(pages: DataFrame) -> DataFrame:
    """Records out of plain pages: every page as a response, and a later visit to it that found it unchanged.

    A crawl of the pages in the order of their ids. The visit comes some
    thousand captures later, under the URL with another scheme, host in capitals
    and a fragment; one in five sends a tag that no longer holds, one in seven
    sends a date in place of a tag, one in eleven sends neither.
    """
    number = F.col("page_id")
    tag = F.concat(F.lit('"'), F.left(F.md5("html"), F.lit(16)), F.lit('"'))
    date = F.concat(F.lit("day "), number.cast("string"))

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    response = pages.select(
        (2 * number).alias("record_id"),
        "url",
        number.alias("time"),
        F.lit("response").alias("kind"),
        F.lit(200).alias("status"),
        tag.alias("etag"),
        date.alias("last_modified"),
        F.md5("html").alias("payload_digest"),
        F.array(
            header("Content-Type", F.lit("text/html")),
            header("Content-Length", F.length("html").cast("string")),
            header("ETag", tag),
            header("Date", date),
        ).alias("headers"),
    )
    later = number + 1000 * (1 + number % 3)
    url = F.concat(F.lit("HTTP://"), F.upper(F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1)), F.regexp_extract("url", r"^[^:]*://[^/?#]*([^#]*)", 1), F.lit("#again"))
    old = (number % 5 == 4) & (number % 7 != 3)
    sent = F.when((number % 7 == 3) | (number % 11 == 5), F.lit(None)).when(old, F.lit('"old"')).otherwise(F.concat(F.lit("W/"), tag))
    revisit = pages.select(
        (2 * number + 1).alias("record_id"),
        url.alias("url"),
        later.alias("time"),
        F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        sent.alias("etag"),
        F.when(number % 11 != 5, date).alias("last_modified"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.array(header("Date", later.cast("string")), header("Content-Length", F.lit("0")), header("Cache-Control", F.lit("max-age=60"))).alias("headers"),
    )
    return response.unionByName(revisit)
