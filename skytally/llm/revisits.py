"""Revisit records of web archives: what a not-modified answer stands for.

DataFrame operations only. A revisit is joined as of its time to the latest earlier full response of its canonical URL. Time is
cut into chunks, so that one URL's captures are not ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.common import stored

CHUNK_ROWS = 20_000  # rows of a chunk if all records were of one URL
# Headers a not-modified answer may not change: they describe its own message or connection (RFC 9110 7.6.1, RFC 9111 3.2).
FIXED_HEADERS = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, www., default port, closing slash and utm parameters; host in lower case, parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z]+://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    given = F.regexp_extract(bare, "^[^?]*[?](.*)$", 1)
    kept = F.array_sort(F.filter(F.split(given, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _opaque(tag: Column) -> Column:
    """Entity tags are compared weakly."""
    return F.regexp_replace(tag, "^W/", "")


def _lowered(headers: str) -> Column:
    """Lower-case names without empty values; of names that differ in case only the last by name stays."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.expr("map()").cast("map<string,string>"))))
    entries = F.filter(entries, lambda e: e["value"].isNotNull())
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    last = F.transform(names, lambda n: F.struct(n.alias("key"), F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"].alias("value")))
    return F.map_from_entries(last)


def latest_earlier(records: DataFrame) -> DataFrame:
    """revisit_id and original_id: for each revisit the full response of the same page with the greatest (at, record_id) before its time.

    ``records`` has record_id, page, at (long) and is_revisit. A window orders the records of one page and chunk; a second one the
    newest response of each chunk of a page."""
    size = records.agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).first()
    chunks = max(1, size["n"] // CHUNK_ROWS)
    width = max(1, ((size["high"] or 0) - (size["low"] or 0)) // chunks + 1)
    rows = records.withColumn("chunk", F.floor((F.col("at") - F.lit(size["low"] or 0)) / width))
    response = F.when(~F.col("is_revisit"), F.struct("at", "record_id"))
    inside = Window.partitionBy("page", "chunk").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.max(response).over(inside)).filter("is_revisit")
    newest = rows.groupBy("page", "chunk").agg(F.max(response).alias("newest"))
    before = Window.partitionBy("page").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.withColumn("carried", F.max("newest").over(before)).select("page", "chunk", "carried")
    found = F.coalesce(F.col("near.record_id"), F.col("carried.record_id"))
    return near.join(carried, ["page", "chunk"], "left").select(F.col("record_id").alias("revisit_id"), found.alias("original_id"))


def resolve(records: DataFrame) -> DataFrame:
    """revisit_id, page, original_id, outcome, headers and digest of every revisit.

    ``records`` has record_id (unique; of repeated ids one row stands), url, at (long), kind (``revisit`` or anything else for a full
    response), headers (map) and digest (of the payload). Outcomes:

    * ``resolved``: the entity tags agree, or where one has none the dates of last change; original_id, the merged headers and the original's
      digest are given. Merged headers are the original's, replaced by the revisit's save those in ``FIXED_HEADERS``.
    * ``validator_mismatch``: they differ. ``no_validator``: neither can be compared. original_id is given, headers and digest are null.
    * ``no_earlier_response``: no full response of that page before; an equal time is not before. A null url or time never matches.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("page"), F.col("at").cast("long").alias("at"),
        F.coalesce(F.col("kind") == "revisit", F.lit(False)).alias("is_revisit"), _lowered("headers").alias("headers"), "digest",
    )
    # Sorted entries can be compared and hashed, a map cannot: rows given twice become one, then the least of an id stands.
    rows = rows.filter(F.col("record_id").isNotNull()).withColumn("headers", F.array_sort(F.map_entries("headers"))).distinct()
    rows = stored(rows.withColumn("order", F.xxhash64("page", "at", "is_revisit", "digest", "headers")), "records")
    one = rows.groupBy("record_id").agg(F.min("order").alias("order"))
    rows = rows.join(one, ["record_id", "order"], "left_semi").drop("order").withColumn("headers", F.map_from_entries("headers"))
    usable = rows.filter(F.col("page").isNotNull() & F.col("at").isNotNull()).select("record_id", "page", "at", "is_revisit")
    pairs = latest_earlier(usable)
    revisits = rows.filter("is_revisit").select(F.col("record_id").alias("revisit_id"), "page", F.col("headers").alias("now"))
    originals = rows.filter("not is_revisit").select(F.col("record_id").alias("original_id"), F.col("headers").alias("then"), "digest")
    joined = revisits.join(pairs.distinct(), "revisit_id", "left").join(originals, "original_id", "left")
    tags = _opaque(F.col("now")["etag"]), _opaque(F.col("then")["etag"])
    dates = F.col("now")["last-modified"], F.col("then")["last-modified"]
    both = lambda pair: pair[0].isNotNull() & pair[1].isNotNull()
    outcome = (
        F.when(F.col("original_id").isNull(), "no_earlier_response")
        .when(both(tags), F.when(tags[0] == tags[1], "resolved").otherwise("validator_mismatch"))
        .when(both(dates), F.when(dates[0] == dates[1], "resolved").otherwise("validator_mismatch"))
        .otherwise("no_validator")
    )
    given = F.map_filter("now", lambda k, v: ~k.isin(FIXED_HEADERS))
    rest = F.map_filter("then", lambda k, v: ~F.map_contains_key(given, k))
    good = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "revisit_id", "page", "original_id", "outcome",
        F.when(good, F.map_concat(rest, given)).alias("headers"), F.when(good, F.col("digest")).alias("digest"),
    )


def header_lines(headers: Column) -> Column:
    """`name: value` lines, sorted; null for null."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")


def crawl(pages: DataFrame) -> DataFrame:
    """Records made from a table of pages: each page as a full response and a later (every eleventh an earlier) revisit under a
    variant of its URL, with validators that agree, differ, are weak or are missing."""
    n, url, html = F.col("page_id"), F.col("url"), F.col("html")
    tag = F.concat(F.lit('"'), F.md5(html), F.lit('"'))
    date = F.concat(F.lit("lm-"), n.cast("string"))
    text = lambda x: F.lit(x)

    def headers(**values: Column) -> Column:
        return F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in values]), F.array(*values.values()))

    full = pages.select(
        (n * 2).alias("record_id"), url.alias("url"), (n * 10).alias("at"), text("response").alias("kind"),
        headers(
            ETag=tag, Last_Modified=date, Content_Type=text("text/html"), Content_Length=F.length(html).cast("string"),
            Cache_Control=text("max-age=60"), Date=F.concat(F.lit("d"), (n * 10).cast("string")),
        ).alias("headers"),
        F.sha2(html, 256).alias("digest"),
    )
    at = n * 10 + F.when(n % 11 == 0, -5).otherwise((n % 997) * 10 + 5)
    now = F.when(n % 7 == 3, '"other"').when(n % 7 == 5, None).otherwise(F.concat(F.when(n % 3 == 0, "W/").otherwise(""), tag))
    changed = F.when(n % 4 == 1, None).when(n % 13 == 0, "lm-x").otherwise(date)
    variant = F.when(n % 2 == 0, F.concat(url, F.lit("#part"))).otherwise(F.regexp_replace(url, "^https?", "HTTP"))
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"), variant.alias("url"), at.alias("at"), text("revisit").alias("kind"),
        headers(
            ETag=now, Last_Modified=changed, Content_Length=text("0"), Cache_Control=F.concat(F.lit("max-age="), (n % 100).cast("string")),
            Date=F.concat(F.lit("d"), at.cast("string")), X_Revisit=text("1"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return full.unionByName(revisit)


ORACLE = r"""
WITH bare AS (
  SELECT page_id AS n, html, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z]+://', '') AS b FROM pages
), split AS (
  SELECT n, html,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^www[.]', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(b, '^[^?]*[?](.*)$', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS kept
  FROM bare
), paged AS (
  SELECT n, html, concat(host, path, CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END) AS page,
    '"' || md5(html) || '"' AS tag, 'lm-' || n AS date FROM split
), full_r AS (
  SELECT n * 2 AS original_id, page, n * 10 AS moment, tag, date, length(html) AS size, sha256(html) AS digest FROM paged
), revisit AS (
  SELECT n * 2 + 1 AS revisit_id, page, n * 10 + CASE WHEN n % 11 = 0 THEN -5 ELSE (n % 997) * 10 + 5 END AS moment, n % 100 AS age,
    CASE WHEN n % 7 = 3 THEN '"other"' WHEN n % 7 = 5 THEN NULL WHEN n % 3 = 0 THEN 'W/' || tag ELSE tag END AS tag,
    CASE WHEN n % 4 = 1 THEN NULL WHEN n % 13 = 0 THEN 'lm-x' ELSE date END AS date FROM paged
), joined AS (
  SELECT r.revisit_id, r.page, f.original_id, r.moment, r.age, r.tag AS rtag, r.date AS rdate, f.tag AS ftag, f.date AS fdate, f.size, f.digest,
    CASE WHEN f.original_id IS NULL THEN 'no_earlier_response'
      WHEN r.tag IS NOT NULL AND f.tag IS NOT NULL THEN
        CASE WHEN regexp_replace(r.tag, '^W/', '') = regexp_replace(f.tag, '^W/', '') THEN 'resolved' ELSE 'validator_mismatch' END
      WHEN r.date IS NOT NULL AND f.date IS NOT NULL THEN CASE WHEN r.date = f.date THEN 'resolved' ELSE 'validator_mismatch' END
      ELSE 'no_validator' END AS outcome
  FROM revisit r ASOF LEFT JOIN full_r f ON r.page = f.page AND r.moment > f.moment
)
SELECT revisit_id, page, original_id, outcome,
  CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=' || age, 'content-length: ' || size, 'content-type: text/html',
    'date: d' || moment, 'etag: ' || coalesce(rtag, ftag), 'last-modified: ' || coalesce(rdate, fdate), 'x-revisit: 1') END AS headers,
  CASE WHEN outcome = 'resolved' THEN digest END AS digest
FROM joined
"""
