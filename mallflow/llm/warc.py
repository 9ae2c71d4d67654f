"""Revisit resolution for web archives: an as-of join to the latest earlier full response of the same canonical URL.

A ``revisit`` record says "not modified" about a page captured before. It is joined to the latest ``response`` of its canonical URL
that is strictly earlier. The validators are then compared: the entity tags if both have one (weakly, without the ``W/`` mark), else
the modification dates, else the payload digests. A match gives the response's payload with its headers updated by those of the
revisit that may update them; a mismatch, or no comparable validator, resolves to nothing.

One URL may hold a large share of all records, so its records are never put into one task: they are cut by time into spans of
:data:`SPAN` seconds. Inside a span, a running maximum finds the latest earlier response; before it, the last response of each span
is carried forward, one row for each URL and span.

Defined results: records without URL or time are orphans; two responses at one time: the larger record_id wins; a response at the very
time of a revisit is not earlier; header names are compared without case, the last of equal names in one record counts; repeated
rows are resolved each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallflow.llm.frames import stored

SPAN = 3600
# Headers of a "not modified" answer that leave the stored ones as they are, and query parameters without meaning.
NOT_UPDATED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"

_HEADERS = "array<struct<name:string,value:string>>"
RECORD = (
    "record_id bigint, url string, ts bigint, kind string, etag string, modified string, digest string, "
    f"headers {_HEADERS}"
)


def canonical(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment, trailing slashes and tracking; parameters in order."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^([^/?]*)", 1)
    rest = F.substr(bare, F.length(host) + 1)
    shown = F.regexp_replace(F.regexp_replace(F.lower(host), "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/+$", "")
    asked = F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.concat(shown, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(asked), "&"))).otherwise(F.lit("")))


def _named(headers: Column) -> Column:
    """Entries with lower-case names, the last of equal names only, in order of name."""
    named = F.filter(headers, lambda h: h["name"].isNotNull())
    lower = F.transform(named, lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value")))
    last = F.filter(
        lower,
        lambda h, at: ~F.exists(F.slice(lower, at + 2, F.greatest(F.size(lower) - at - 1, F.lit(0))), lambda x: x["name"] == h["name"]),
    )
    return F.array_sort(last)


def merged(base: Column, update: Column) -> Column:
    """The stored headers, with those of the update that may change them."""
    new = F.coalesce(F.filter(_named(update), lambda h: ~h["name"].isin(*NOT_UPDATED)), F.array().cast(_HEADERS))
    old = F.filter(_named(base), lambda h: ~F.exists(new, lambda x: x["name"] == h["name"]))
    return F.array_sort(F.concat(F.coalesce(old, F.array().cast(_HEADERS)), new))


def _agrees(a: str, b: str) -> Column:
    def tag(side: str) -> Column:
        return F.regexp_replace(f"{side}.etag", "^W/", "")

    return (
        F.when(tag(a).isNotNull() & tag(b).isNotNull(), tag(a) == tag(b))
        .when(F.col(f"{a}.modified").isNotNull() & F.col(f"{b}.modified").isNotNull(), F.col(f"{a}.modified") == F.col(f"{b}.modified"))
        .when(F.col(f"{a}.digest").isNotNull() & F.col(f"{b}.digest").isNotNull(), F.col(f"{a}.digest") == F.col(f"{b}.digest"))
        .otherwise(F.lit(False))
    )


def resolve_revisits(records: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per revisit: ``record_id``, ``page``, ``ts``, ``status`` (resolved, mismatch, orphan), the response's ``response_id``,
    ``response_ts`` and ``payload`` digest, and the merged ``headers``; the last four null unless resolved.

    ``records`` has the columns of :data:`RECORD`.
    """
    me = F.struct("ts", "record_id", "etag", "modified", "digest", "headers")
    rows = records.select(
        "record_id",
        canonical(F.col("url")).alias("page"),
        "ts",
        F.floor(F.col("ts") / span).alias("part"),
        F.col("kind").alias("kind"),
        me.alias("me"),
        F.when(F.col("kind") == "response", me).alias("full"),
    ).where(F.col("kind").isin("response", "revisit"))
    rows = stored(rows, "captures")
    known = rows.where("page is not null and ts is not null")
    # The last response of each span, carried to the spans after it.
    lasts = stored(known.groupBy("page", "part").agg(F.max("full").alias("last")), "spans")
    earlier = Window.partitionBy("page").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = stored(lasts.select("page", "part", F.max("last").over(earlier).alias("carried")), "carried")
    inside = Window.partitionBy("page", "part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = known.withColumn("near", F.max("full").over(inside)).where("kind = 'revisit'")
    # Both sides are cut by page and span, so a page with very many records is spread out.
    found = near.join(carried, ["page", "part"], "left").withColumn("base", F.coalesce("near", "carried"))
    lost = rows.where("kind = 'revisit' and (page is null or ts is null)")
    lost = lost.withColumn("base", F.lit(None).cast(rows.schema["me"].dataType))
    every = found.select("record_id", "page", "ts", "me", "base").unionByName(lost.select("record_id", "page", "ts", "me", "base"))
    status = F.when(F.col("base").isNull(), "orphan").when(_agrees("base", "me"), "resolved").otherwise("mismatch")
    good = F.col("status") == "resolved"
    return every.withColumn("status", status).select(
        "record_id",
        "page",
        "ts",
        "status",
        F.when(good, F.col("base.record_id")).alias("response_id"),
        F.when(good, F.col("base.ts")).alias("response_ts"),
        F.when(good, F.col("base.digest")).alias("payload"),
        F.when(good, merged(F.col("base.headers"), F.col("me.headers"))).alias("headers"),
    )


# Fixed values of the capture log that is derived from pages.
_START = 1_704_067_200
_DAY = 86_400


def captures(pages: DataFrame) -> DataFrame:
    """A capture log in which every page is fetched once in full and asked for again.

    The second request comes a day later and finds the page unmodified; every third page is asked for once more with another entity
    tag, and every seventh was asked for a day before it was ever fetched.
    """
    page = F.col("page_id")
    at = F.lit(_START) + page * 60
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))

    def header(name: str, value: Column | str) -> Column:
        return F.struct(F.lit(name).alias("name"), (F.lit(value) if isinstance(value, str) else value.cast("string")).alias("value"))

    def record(number: int, ts: Column, kind: str, etag: Column, *headers: Column) -> Column:
        return F.struct(
            (page * 4 + number).alias("record_id"),
            F.col("url").alias("url"),
            ts.alias("ts"),
            F.lit(kind).alias("kind"),
            etag.alias("etag"),
            F.lit(None).cast("string").alias("modified"),
            F.when(F.lit(kind) == "response", digest).alias("digest"),
            F.array(*headers).alias("headers"),
        )

    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    full = record(0, at, "response", tag, header("Date", at), header("Content-Type", "text/html"), header("Content-Length", size), header("Cache-Control", "max-age=60"))
    same = record(1, at + _DAY, "revisit", F.concat(F.lit("W/"), tag), header("date", at + _DAY), header("Content-Length", "0"), header("cache-control", "max-age=600"), header("Age", page % 100))
    other = record(2, at + 2 * _DAY, "revisit", F.lit('"other"'), header("Date", at + 2 * _DAY))
    soon = record(3, at - _DAY, "revisit", tag, header("Date", at - _DAY))
    each = F.array_compact(F.array(full, same, F.when(page % 3 == 0, other), F.when(page % 7 == 0, soon)))
    return pages.select(F.inline(each))


def listed(headers: Column) -> Column:
    """Headers as one text, ``name: value`` by line."""
    return F.array_join(F.transform(headers, lambda h: F.concat(h["name"], F.lit(": "), F.coalesce(h["value"], F.lit("")))), "\n")


ORACLE_SQL = f"""
WITH page AS (
  SELECT page_id, url, {_START} + page_id * 60 AS at_s, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size FROM pages),
tagged AS (SELECT *, '"' || substr(digest, 1, 12) || '"' AS tag FROM page),
bare AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM tagged),
cut AS (
  SELECT *, regexp_extract(bare, '^([^/?]*)', 1) AS host, substr(bare, length(regexp_extract(bare, '^([^/?]*)', 1)) + 1) AS rest FROM bare),
named AS (
  SELECT *, regexp_replace(regexp_replace(lower(host), '^www\\.', ''), ':(80|443)$', '')
            || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '')
            || (CASE WHEN len(asked) > 0 THEN '?' || array_to_string(list_sort(asked), '&') ELSE '' END) AS canon
  FROM (SELECT *, list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'),
                              lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}')) AS asked FROM cut)),
revisit AS (
  SELECT page_id * 4 + 1 AS record_id, canon AS page, at_s + {_DAY} AS ts, tag, 1 AS n, page_id FROM named
  UNION ALL SELECT page_id * 4 + 2, canon, at_s + 2 * {_DAY}, '"other"', 2, page_id FROM named WHERE page_id % 3 = 0
  UNION ALL SELECT page_id * 4 + 3, canon, at_s - {_DAY}, tag, 3, page_id FROM named WHERE page_id % 7 = 0),
met AS (
  SELECT r.*, b.page_id AS base_id, b.at_s AS base_at, b.tag AS base_tag, b.digest, b.size,
         row_number() OVER (PARTITION BY r.record_id ORDER BY b.at_s DESC, b.page_id DESC) AS nth
  FROM revisit r LEFT JOIN named b ON r.page = b.canon AND b.at_s < r.ts),
judged AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'orphan' WHEN tag = base_tag THEN 'resolved' ELSE 'mismatch' END AS status
  FROM met WHERE nth = 1)
SELECT record_id, page, ts, status,
       CASE WHEN status = 'resolved' THEN base_id * 4 END AS response_id,
       CASE WHEN status = 'resolved' THEN base_at END AS response_ts,
       CASE WHEN status = 'resolved' THEN digest END AS payload,
       CASE WHEN status = 'resolved' THEN
         CASE WHEN n = 1 THEN 'age: ' || (page_id % 100) || chr(10) || 'cache-control: max-age=600' ELSE 'cache-control: max-age=60' END
         || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts END AS headers
FROM judged
"""
