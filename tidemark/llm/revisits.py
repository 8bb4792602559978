"""WARC revisit resolution: not-modified captures get the response they refer to.

Each revisit is joined as of its capture time to the latest earlier full
response with the same canonical URL.  The validators decide whether it really
stands for that response: entity tags by weak comparison where both have one,
else last-modified times where both have one; otherwise it stays unresolved.  A
resolved revisit carries the response's headers, updated with those headers of
the revisit that a 304 may change.

Captures are sorted by (URL, time, record) into range partitions, so a URL with
very many captures spans several of them; within a partition a window carries
the last response forward, and one row per (partition, URL) carries it on to the
next.  Bodies are never moved.

Odd input: a null URL or time, or a revisit without an earlier response, gives
``no_response``; captures at the same time are ordered by record id, a response
that ties with a revisit in both is not earlier; repeated rows are resolved
each; null headers count as none, and of names that differ only in case the last
in order of name wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import _written
from tidemark.sources.tables import read_table

# Header fields that a 304 response updates (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that don't change what is fetched.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|sessionid|phpsessid)(=|$)"
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def canonical_url(url):
    """Host, path and query: scheme, user, default port, fragment and tracking
    parameters go, the host is lower-cased, other parameters are sorted.  A
    string that is no absolute URL stays as it is."""
    part = lambda i: F.regexp_extract(url, PARTS, i)
    host = F.regexp_replace(F.lower(F.regexp_replace(part(2), "^.*@", "")), ":(80|443)$", "")
    path = F.when(part(3) == "", "/").otherwise(part(3))
    query = F.filter(
        F.split(F.substring(part(4), 2, 1 << 30), "&"), lambda x: (x != "") & ~F.lower(x).rlike(TRACKING)
    )
    query = F.array_join(F.array_sort(query), "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(url.rlike(PARTS), whole).otherwise(url)


def _lower_names(headers):
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.expr("map()").cast("map<string,string>"))))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    value = lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"]
    return F.map_from_arrays(names, F.transform(names, value))


def _strong(tag):
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """``records``: record_id, url, time (seconds), kind ('response' or
    'revisit'), headers (map).  Result: a row per revisit with record_id, url
    (canonical), time, status, refers_to (record_id of the response, null unless
    ``resolved``) and headers (merged; the revisit's own unless resolved)."""
    spark = records.sparkSession
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("url").cast("string")).alias("url"),
        F.col("time").cast("long").alias("time"),
        (F.col("kind") == "response").alias("full"),
        _lower_names(F.col("headers")).alias("headers"),
    ).where("full IS NOT NULL")
    usable = F.col("full") & F.col("url").isNotNull() & F.col("time").isNotNull()
    rows = rows.withColumn("given", F.when(usable, F.struct("time", "record_id", "headers")))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(shards, "url", "time", "record_id").withColumn("part", F.spark_partition_id())
    rows = _written(rows, "revisit-captures")

    least = F.struct(F.col("given.time"), F.col("given.record_id"))
    last = rows.where(F.col("given").isNotNull()).groupBy("url", "part").agg(
        F.max_by("given", least).alias("last")
    )
    # One row per range partition that holds the URL, besides its first.
    parts = rows.groupBy("url", "part").agg(F.count("*").alias("n")).join(last, ["url", "part"], "left")
    before = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("url", "part", F.last("last", True).over(before).alias("carried")).where("carried IS NOT NULL")

    along = Window.partitionBy("part", "url").orderBy("time", "record_id", "full")
    along = along.rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("near", F.last("given", True).over(along)).where("NOT full")
    seen = seen.join(parts, ["url", "part"], "left").withColumn("found", F.coalesce("near", "carried"))
    seen = seen.withColumn("found", F.when(F.col("time").isNotNull(), F.col("found")))

    own, its = F.col("headers"), F.col("found.headers")
    tags = _strong(own["etag"]), _strong(its["etag"])
    dates = own["last-modified"], its["last-modified"]
    same = F.when(tags[0].isNotNull() & tags[1].isNotNull(), tags[0] == tags[1]).when(
        dates[0].isNotNull() & dates[1].isNotNull(), dates[0] == dates[1]
    )
    status = (
        F.when(F.col("found").isNull(), "no_response")
        .when(same.isNull(), "no_validator")
        .when(same, "resolved")
        .otherwise("mismatch")
    )
    update = F.map_filter(own, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    merged = F.map_zip_with(its, update, lambda k, a, b: F.coalesce(b, a))
    seen = seen.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return seen.select(
        "record_id",
        "url",
        "time",
        "status",
        F.when(ok, F.col("found.record_id")).alias("refers_to"),
        F.when(ok, merged).otherwise(own).alias("headers"),
    )


# Captures derived from the pages: each page is fetched, asked for again a day
# and two days later (each time under another spelling of its URL), and answers
# "not modified", or sends a new version.
def captures(pages: DataFrame) -> DataFrame:
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.md5(F.coalesce("html", F.lit(""))).alias("digest"),
        F.length(F.coalesce("html", F.lit(""))).alias("size"),
        F.explode(F.expr("sequence(0, 2)")).alias("i"),
    )
    rows = rows.withColumn("time", F.expr("page_id * 60 + i * 86400"))
    full = F.expr("(i = 0 AND page_id % 11 <> 0) OR (i = 2 AND page_id % 5 = 0)")
    tag = F.expr("CASE WHEN i = 2 AND page_id % 4 = 0 THEN concat('\"', reverse(digest), '\"') ELSE concat('\"', digest, '\"') END")
    tag = F.when(F.expr("page_id % 6 = 0"), F.lit(None)).when(F.expr("i = 1"), F.concat(F.lit("W/"), tag)).otherwise(tag)
    modified = F.expr("CASE WHEN page_id % 12 <> 0 THEN concat('day ', page_id % 28) END")
    sent = F.map_from_arrays(
        F.array(*map(F.lit, ("Content-Type", "Content-Length", "ETag", "Last-Modified", "Cache-Control", "Date"))),
        F.array(F.lit("text/html"), F.col("size").cast("string"), tag, modified, F.lit("max-age=60"), F.col("time").cast("string")),
    )
    unchanged = F.map_from_arrays(
        F.array(*map(F.lit, ("content-length", "etag", "last-modified", "cache-control", "date", "x-cache"))),
        F.array(F.lit("0"), tag, modified, F.lit("max-age=120"), F.col("time").cast("string"), F.lit("HIT")),
    )
    spelled = F.when(F.col("i") == 1, F.concat("url", F.lit("#seen"))).otherwise(F.col("url"))
    return rows.select(
        F.expr("page_id * 3 + i").alias("record_id"),
        spelled.alias("url"),
        "time",
        F.when(full, "response").otherwise("revisit").alias("kind"),
        F.map_filter(F.when(full, sent).otherwise(unchanged), lambda k, v: v.isNotNull()).alias("headers"),
    )


def query(spark, sf_dir):
    """Every revisit among the captures of the pages, resolved."""
    found = resolve(captures(read_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return found.select(
        "record_id",
        "url",
        "time",
        "status",
        F.coalesce("refers_to", F.lit(-1)).cast("long").alias("refers_to"),
        F.array_join(lines, "\n").alias("headers"),
    )


SQL = r"""
WITH rows AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size, i,
         page_id * 60 + i * 86400 AS time,
         (i = 0 AND page_id % 11 <> 0) OR (i = 2 AND page_id % 5 = 0) AS is_full
  FROM pages, (VALUES (0), (1), (2)) AS t(i)),
split AS (
  SELECT *, lower(regexp_replace(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1),
                                 '^.*@', '')) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q
  FROM rows),
records AS (
  SELECT page_id * 3 + i AS record_id, time, is_full, size,
         regexp_replace(host, ':(80|443)$', '') || CASE WHEN path = '' THEN '/' ELSE path END
           || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(q, '&'),
                lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|sessionid|phpsessid)(=|$)'))), '&'), ''), '')
           AS url,
         CASE WHEN page_id % 6 <> 0 THEN CASE WHEN i = 1 THEN 'W/' ELSE '' END || '"' ||
           CASE WHEN i = 2 AND page_id % 4 = 0 THEN reverse(digest) ELSE digest END || '"' END AS etag,
         CASE WHEN page_id % 12 <> 0 THEN 'day ' || (page_id % 28) END AS modified
  FROM split),
joined AS (
  SELECT v.*, r.record_id AS r_id, r.etag AS r_etag, r.modified AS r_modified, r.size AS r_size, r.time AS r_time
  FROM (SELECT * FROM records WHERE NOT is_full) v
  LEFT JOIN (SELECT * FROM records WHERE is_full) r
    ON r.url = v.url AND (r.time < v.time OR (r.time = v.time AND r.record_id < v.record_id))
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.time DESC NULLS LAST, r.record_id DESC) = 1),
judged AS (
  SELECT *, CASE
      WHEN r_id IS NULL THEN 'no_response'
      WHEN etag IS NOT NULL AND r_etag IS NOT NULL THEN
        CASE WHEN replace(etag, 'W/', '') = replace(r_etag, 'W/', '') THEN 'resolved' ELSE 'mismatch' END
      WHEN modified IS NOT NULL AND r_modified IS NOT NULL THEN
        CASE WHEN modified = r_modified THEN 'resolved' ELSE 'mismatch' END
      ELSE 'no_validator' END AS status
  FROM joined)
SELECT record_id, url, time, status, CASE WHEN status = 'resolved' THEN r_id ELSE -1 END AS refers_to,
       CASE WHEN status = 'resolved' THEN
         concat_ws(chr(10), 'cache-control: max-age=120', 'content-length: ' || r_size, 'content-type: text/html',
                   'date: ' || time, 'etag: ' || coalesce(etag, r_etag), 'last-modified: ' || r_modified)
       ELSE concat_ws(chr(10), 'cache-control: max-age=120', 'content-length: 0', 'date: ' || time,
                      'etag: ' || etag, 'last-modified: ' || modified, 'x-cache: HIT') END AS headers
FROM judged
"""
