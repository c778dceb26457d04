"""Not-modified revisits, resolved by an as-of join.

A revisit record takes the latest earlier full response of its canonical URL. Times are cut into ranges by quantiles:
each (URL, range) hands its last response on to the next ranges of that URL, so a URL with a third of all records is
spread over the ranges, and no task needs all of its records. Only narrow columns are ordered; headers and bodies join
afterwards, by record id.

The response is checked against the revisit's validators: entity tags (compared weakly) if the revisit has one, else the
last-modified date, else the payload digest. Headers that a not-modified answer may update are taken from the revisit,
all others from the response.

Defined results, in ``status``: resolved; mismatch (a validator differs: no headers are merged and no body is given);
unverified (the revisit has no validator that the response has too: resolved without proof); missing (no earlier
response). Null URLs or times find nothing. Responses at the same time as a revisit are not earlier; among responses of
one time the largest id counts. Repeated rows keep their rows; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.words import cuts_of, range_of

#: Headers that a not-modified answer may update; query parameters that only track.
UPDATES = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical(url: Column) -> Column:
    """Scheme, fragment, user part, default port, www., tracking parameters and a last slash go; parameters are sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^(?:[^/?@]*@)?([^/?]*)", 1)), "^www\\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(bare, "^[^?]*\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(query), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """Resolve the rows of type revisit.

    ``records``: record_id (long), url, ts (long), type (response or revisit), status_code, etag, last_modified, digest,
    headers (map of lower-case names), body. Returns record_id, url_key, ts, response_id, status, headers, body_id.
    """
    spark = records.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = records.withColumn("url_key", canonical(F.col("url"))).where("url_key is not null and ts is not null")
    full = (F.col("type") == "response") & (F.col("status_code") == 200)
    narrow = r.where(full | (F.col("type") == "revisit")).select("url_key", "ts", "record_id", full.alias("full"))
    cuts = sorted(set(cuts_of(narrow, "ts", ranges)))  # ``ranges`` numbers at most
    narrow = narrow.withColumn("range", range_of(cuts, F.col("ts")))
    last = narrow.where("full").groupBy("url_key", "range").agg(F.max(F.struct("ts", "record_id")).alias("last"))
    here = narrow.select("url_key", "range").distinct().join(last, ["url_key", "range"], "left")
    over = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a URL has ``ranges`` rows at most
    carried = here.select("url_key", "range", F.last("last", ignorenulls=True).over(over).alias("carried"))
    w = Window.partitionBy("url_key", "range").orderBy("ts", "full", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col("full"), F.struct("ts", "record_id")), ignorenulls=True).over(w)
    found = narrow.withColumn("own", own).where("not full").join(carried, ["url_key", "range"], "left")
    found = found.select("record_id", F.coalesce("own", "carried")["record_id"].alias("response_id")).dropDuplicates(["record_id"])
    side = lambda p: [F.col(c).alias(f"{p}_{c}") for c in ("record_id", "etag", "last_modified", "digest", "headers")]
    revisits = records.where("type = 'revisit'").withColumn("url_key", canonical(F.col("url"))).select("url_key", "ts", *side("v"))
    out = revisits.join(found, F.col("v_record_id") == F.col("record_id"), "left").drop("record_id")
    out = out.join(r.where(full).select(*side("o")).dropDuplicates(["o_record_id"]), F.col("response_id") == F.col("o_record_id"), "left")
    both = lambda c: F.col(f"v_{c}").isNotNull() & F.col(f"o_{c}").isNotNull()
    same = F.when(both("etag"), opaque(F.col("v_etag")) == opaque(F.col("o_etag"))).when(both("last_modified"), F.col("v_last_modified") == F.col("o_last_modified")).when(both("digest"), F.col("v_digest") == F.col("o_digest"))
    status = F.when(F.col("response_id").isNull(), "missing").when(same, "resolved").when(~same, "mismatch").otherwise("unverified")
    none = F.create_map().cast("map<string,string>")
    new = F.map_filter(F.coalesce("v_headers", none), lambda k, _: k.isin(*UPDATES))
    kept = F.map_filter(F.coalesce("o_headers", none), lambda k, _: ~F.array_contains(F.map_keys(new), k))
    ok = F.col("status").isin("resolved", "unverified")
    out = out.withColumn("status", status).withColumn("headers", F.when(ok, F.map_concat(kept, new)))
    return out.select(F.col("v_record_id").alias("record_id"), "url_key", "ts", "response_id", "status", "headers", F.when(ok, F.col("response_id")).alias("body_id"))


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl over ``pages``: each page is a full response at ten times its id; twelve seconds later its URL
    is asked for again and answered as not modified, with the page's tag, every seventh time with another one, every
    fifth time with a date only."""
    tag = F.md5("html")
    date = F.concat(F.lit("day "), (F.col("page_id") % 28 + 1).cast("string"))
    page = pages.where("page_id is not null").withColumn("html", F.coalesce("html", F.lit("")))
    response = page.select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 10).alias("ts"), F.lit("response").alias("type"), F.lit(200).alias("status_code"), tag.alias("etag"), date.alias("last_modified"), tag.alias("digest"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), tag, F.lit("date"), (F.col("page_id") * 10).cast("string"), F.lit("content-length"), F.octet_length("html").cast("string")).alias("headers"),
    )
    asked = F.when(F.col("page_id") % 7 == 0, F.md5(F.col("url"))).when(F.col("page_id") % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("W/"), tag))
    revisit = page.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("page_id") * 10 + 12).alias("ts"), F.lit("revisit").alias("type"), F.lit(304).alias("status_code"), asked.alias("etag"), date.alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("date"), (F.col("page_id") * 10 + 12).cast("string"), F.lit("set-cookie"), F.lit("no"), F.lit("expires"), F.lit("never")).alias("headers"),
    )
    return response.unionByName(revisit)


ORACLE_SQL = r"""
WITH b AS (SELECT page_id, url, coalesce(html, '') AS html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages WHERE page_id IS NOT NULL),
c AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^(?:[^/?@]*@)?([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
  regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS q FROM b),
k AS (SELECT page_id, html, url, host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url_key, md5(html) AS tag, 'day ' || (page_id % 28 + 1) AS date FROM c),
res AS (SELECT page_id * 2 AS response_id, url_key, page_id * 10 AS ts, tag AS o_etag, date AS o_date, strlen(html) AS o_len FROM k),
rev AS (SELECT page_id * 2 + 1 AS record_id, url_key, page_id * 10 + 12 AS ts, page_id, CASE WHEN page_id % 7 = 0 THEN md5(url) WHEN page_id % 5 = 0 THEN NULL ELSE tag END AS v_etag, date AS v_date FROM k),
j AS (SELECT rev.*, res.response_id, res.ts AS o_ts, o_etag, o_date, o_len FROM rev ASOF LEFT JOIN res ON rev.url_key = res.url_key AND rev.ts > res.ts),
s AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN v_etag IS NOT NULL THEN CASE WHEN v_etag = o_etag THEN 'resolved' ELSE 'mismatch' END
                     WHEN v_date = o_date THEN 'resolved' ELSE 'mismatch' END AS status FROM j)
SELECT record_id, url_key, ts, response_id, status,
  CASE WHEN status = 'resolved' THEN 'content-length=' || o_len || ';content-type=text/html;date=' || ts || ';etag=' || o_etag || ';expires=never' END AS merged_headers,
  CASE WHEN status = 'resolved' THEN response_id // 2 END AS body_page_id
FROM s
"""
