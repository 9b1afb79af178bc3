"""Not-modified revisits of web captures, resolved to the full response they stand for.

A revisit record says that a page had not changed. It is resolved to the latest full response of
the same canonical URL before it, if the validators of both agree; headers that a not-modified
response may update replace the stored ones.

The as-of join is made without collecting a URL: captures are cut into time slices of ``slice_s``
seconds; within a slice a running last value finds the response, and for the first revisits of a
slice it is the last response of an earlier slice, found over one row per URL and slice. A URL
with very many captures is thus spread over as many tasks as it has slices, and none of it is
dropped.

Defined results: a record without URI or date is never resolved nor a target; of full responses of
one URL and time the one of the greater record_id counts, and a response of the same time as the
revisit is not earlier; equal rows are records of their own; null headers are none; no records give
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumflow.llm.staging import staged

SLICE_S = 6 * 3600
# Headers a not-modified response may bring up to date, and parameters that do not
# tell pages apart.
UPDATABLE = (
    "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary",
)
TRACKING = "^utm_"
DEFAULT_PORT = r"^(http://[^/]*):80$|^(https://[^/]*):443$"


def canonical_url(uri: str) -> Column:
    """Scheme and host in lower case without default port, path without trailing slashes, and the
    parameters that remain, sorted; no fragment."""
    whole = F.regexp_replace(F.col(uri), "#.*$", "")
    address = F.regexp_replace(whole, r"\?.*$", "")
    site = F.lower(F.regexp_extract(address, "^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1))
    path = F.substring(address, F.length(site) + 1, F.length(address))
    path = F.regexp_replace(path, "/+$", "")
    query = F.split(F.regexp_extract(whole, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    site = F.regexp_replace(site, DEFAULT_PORT, "$1$2")
    return F.when(F.size(kept) == 0, F.concat(site, path)).otherwise(
        F.concat(site, path, F.lit("?"), F.array_join(kept, "&"))
    )


def header(headers: str, name: str) -> Column:
    """The first value of a header, null if there is none."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def _etag(headers: str) -> Column:
    return F.regexp_replace(header(headers, "etag"), "^W/", "")


def latest_earlier(records: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """(record_id, target_id) of every revisit that has an earlier full response of its URL.

    ``records`` has record_id, url (canonical), date and full (whether it is a full response).
    """
    slice_ = F.floor(F.unix_micros(F.col("date").cast("timestamp")) / (slice_s * 1_000_000))
    rows = records.filter(F.col("url").isNotNull() & F.col("date").isNotNull()).select(
        "record_id",
        "url",
        "date",
        slice_.alias("slice"),
        F.when(F.col("full"), F.struct("date", "record_id")).alias("response"),
        F.col("full").cast("int").alias("full"),
    )
    last = rows.groupBy("url", "slice").agg(F.max("response").alias("last"))
    earlier = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url", "slice", F.max("last").over(earlier).alias("before"))
    # At one time revisits come first: a response of that time is not earlier.
    inside = (
        Window.partitionBy("url", "slice")
        .orderBy("date", "full", "record_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = rows.withColumn("own", F.last("response", ignorenulls=True).over(inside))
    return (
        found.filter("full = 0")
        .join(carried, ["url", "slice"])
        .select("record_id", F.coalesce("own", "before")["record_id"].alias("target_id"))
        .filter(F.col("target_id").isNotNull())
    )


def resolve_revisits(records: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """Every revisit with its target, how the validators compare, and the merged response.

    ``records`` has record_id (unique), type (``response`` or ``revisit``), uri, date, status,
    headers (array of name and value) and payload_digest. ``verdict`` is one of ``etag``,
    ``last-modified`` and ``digest`` for what agreed, ``differs``, ``no validator``, and
    ``no response``. Other types of records are left out.
    """
    full = (F.col("type") == "response") & (F.col("status") == 200)
    known = staged(
        records.filter(full | (F.col("type") == "revisit")).select(
            "record_id",
            "uri",
            canonical_url("uri").alias("url"),
            "date",
            full.alias("full"),
            "headers",
            "payload_digest",
        ),
        "warc-records",
    )
    target = staged(latest_earlier(known.select("record_id", "url", "date", "full"), slice_s), "warc-targets")
    revisits = known.filter(~F.col("full")).select(
        "record_id", "uri", "url", "date", "headers", F.col("payload_digest").alias("digest")
    )
    stored = known.filter("full").select(
        F.col("record_id").alias("target_id"),
        F.col("headers").alias("stored"),
        F.col("payload_digest").alias("stored_digest"),
    )
    both = revisits.join(target, "record_id", "left").join(stored, "target_id", "left")
    none = F.array().cast("array<struct<name:string,value:string>>")
    both = both.withColumns(
        {"headers": F.coalesce("headers", none), "stored": F.coalesce("stored", none)}
    )
    pairs = (
        ("etag", _etag("headers"), _etag("stored")),
        ("last-modified", header("headers", "last-modified"), header("stored", "last-modified")),
        ("digest", F.col("digest"), F.col("stored_digest")),
    )
    verdict = F.lit("no validator")
    for name, a, b in reversed(pairs):  # the strongest validator both have decides
        present = a.isNotNull() & b.isNotNull()
        verdict = F.when(present, F.when(a == b, name).otherwise("differs")).otherwise(verdict)
    verdict = F.when(F.col("target_id").isNull(), "no response").otherwise(verdict)
    new = F.filter("headers", lambda h: F.lower(h["name"]).isin(*UPDATABLE))
    names = F.transform(new, lambda h: F.lower(h["name"]))
    old = F.filter("stored", lambda h: ~F.array_contains(names, F.lower(h["name"])))
    resolved = F.col("verdict").isin("etag", "last-modified", "digest")
    return both.withColumn("verdict", verdict).select(
        "record_id",
        "uri",
        "url",
        "date",
        "target_id",
        "verdict",
        F.when(resolved, F.concat(old, new)).alias("headers"),
        F.when(resolved, F.col("stored_digest")).alias("payload_digest"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures that follow from the pages: each page as a full response, and a revisit later.

    Times, validators and the form of the revisit's URI follow from page_id by rule, so that URLs,
    validators and headers of all kinds meet.
    """
    n = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    day = F.date_format(F.timestamp_seconds(1_700_000_000 + (n % 50) * 86_400), "yyyy-MM-dd")

    def headers(*pairs: tuple[str, Column]) -> Column:
        made = [F.struct(F.lit(k).alias("name"), v.cast("string").alias("value")) for k, v in pairs]
        return F.filter(F.array(*made), lambda h: h["value"].isNotNull())

    response = pages.select(
        (2 * n).alias("record_id"),
        F.lit("response").alias("type"),
        F.col("url").alias("uri"),
        F.timestamp_seconds(1_700_000_000 + n * 600).alias("date"),
        F.lit(200).alias("status"),
        headers(
            ("Content-Type", F.lit("text/html")),
            ("Content-Length", F.octet_length("html")),
            ("ETag", F.when(n % 4 != 0, tag)),
            ("Last-Modified", F.when(n % 3 != 0, day)),
            ("Cache-Control", F.lit("max-age=60")),
        ).alias("headers"),
        F.sha1("html").alias("payload_digest"),
    )
    suffix = F.element_at(F.array(*[F.lit(x) for x in ("", "#top", "/")]), (n % 3 + 1).cast("int"))
    revisit = pages.select(
        (2 * n + 1).alias("record_id"),
        F.lit("revisit").alias("type"),
        F.concat("url", F.when(F.col("url").contains("?") | F.col("url").contains("#"), "").otherwise(suffix)).alias("uri"),
        F.timestamp_seconds(1_700_000_000 + n * 600 + (n % 40) * 601).alias("date"),
        F.lit(304).alias("status"),
        headers(
            ("Content-Length", F.lit(0)),
            ("ETag", F.when(n % 5 == 0, F.lit('"other"')).when(n % 2 == 0, F.concat(F.lit("W/"), tag)).when(n % 7 != 0, tag)),
            ("last-modified", F.when(n % 11 != 0, day)),
            ("Cache-Control", F.when(n % 2 == 0, F.lit("max-age=120"))),
        ).alias("headers"),
        F.when(n % 13 != 0, F.sha1("html")).alias("payload_digest"),
    )
    return response.unionByName(revisit)


def page_revisits(pages: DataFrame) -> DataFrame:
    """Every revisit of the pages' captures (target -1: none), its headers as one digest."""
    lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    found = resolve_revisits(page_captures(pages))
    return found.select(
        "record_id",
        "url",
        F.coalesce("target_id", F.lit(-1)).alias("target_id"),
        "verdict",
        F.size(F.coalesce("headers", F.array())).cast("long").alias("n_headers"),
        F.sha2(F.array_join(lines, "\n"), 256).alias("headers_sha256"),
        "payload_digest",
    )
