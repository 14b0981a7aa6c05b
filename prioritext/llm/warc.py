"""Resolution of WARC not-modified revisits by an as-of join.

A ``revisit`` record (a 304 answer) takes the payload of the latest earlier
full response with the same canonical URL, if a validator (ETag, else
Last-Modified) of both agrees; headers that a 304 may carry replace those of
the response, all others are the response's.

The join is by time blocks: within a block a window finds the latest earlier
response, and the last response of each earlier block is carried forward over
the few block rows of a URL.  A URL that holds a third of all records is thus
spread over its blocks.  Payloads stay out of the windows and are joined to
the resolved revisits by record id.

Defined results
  null URL, time or record id: the record takes no part as a response; as a
  revisit it is ``no_response``;
  several responses at one time: the largest record id; a response at the
  revisit's own time is not earlier; null or no headers: no validator;
  repeated rows: each revisit row is resolved by itself; a response that is
  repeated with equal id counts once; empty or very long payloads are kept
  whole; empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prioritext.llm.tables import table

# Short blocks spread a URL that very many records share; others hold a block or two anyway.
BLOCK_SECONDS = 900
# Headers that a not-modified answer may update: fixed by the HTTP standard.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: F.Column) -> F.Column:
    """Host without ``www``, default port and case; path without final slash; sorted query without trackers.

    Angle brackets around a URL are dropped; what is no ``scheme://...`` stays as it is, without its fragment.
    """
    bare = F.regexp_replace(F.regexp_replace(url, r"^\s*<(.*)>\s*$", "$1"), "#.*$", "")
    whole = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$"
    host = F.lower(F.regexp_extract(bare, whole, 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, whole, 2), "/+$", "")
    query = F.filter(
        F.split(F.regexp_extract(bare, whole, 3), "&"), lambda p: (p != "") & ~p.startswith("utm_")
    )
    joined = F.array_join(F.array_sort(query), "&")
    built = F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(F.lit("")))
    return F.when(bare.rlike(whole), built).otherwise(bare)


def _latest_response(records: DataFrame, block_seconds: int) -> DataFrame:
    """Of each revisit: its columns and ``found``, the latest earlier response of its URL."""
    narrow = records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("key"), "ts", "headers"
    )
    block = F.floor(F.col("ts") / block_seconds).alias("block")
    usable = F.col("key").isNotNull() & F.col("ts").isNotNull()
    placed = narrow.filter(usable).select("*", block)
    response = F.when(
        (F.col("kind") == "response") & F.col("record_id").isNotNull(),
        # headers as sorted entries: maps have no order
        F.struct("ts", "record_id", F.array_sort(F.map_entries("headers")).alias("entries")),
    )
    rows = placed.withColumn("response", response)
    per_block = rows.groupBy("key", "block").agg(F.max("response").alias("last"))
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select("key", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("key", "block").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    found = (
        rows.withColumn("near", F.max("response").over(inside))
        .filter("kind = 'revisit'")
        .join(carried, ["key", "block"], "left")
        .select("record_id", "key", "ts", "headers", F.coalesce("near", "carried").alias("found"))
    )
    lost = narrow.filter((F.col("kind") == "revisit") & ~usable).select(
        "record_id", "key", "ts", "headers", F.lit(None).cast(found.schema["found"].dataType).alias("found")
    )
    return found.unionByName(lost)


def resolve_revisits(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit of ``records(record_id, kind, url, ts, headers, body)``.

    ``(record_id, url_key, ts, status, response_id, headers, body)``; status is ``resolved``,
    ``validator_mismatch``, ``no_validator`` or ``no_response``, and only a resolved one has the rest.
    """
    known = _latest_response(records, block_seconds).withColumn("base", F.map_from_entries("found.entries"))

    def agrees(name: str) -> F.Column:
        return F.element_at("headers", name) == F.element_at("base", name)

    same = F.coalesce(agrees("etag"), agrees("last-modified"))
    status = (
        F.when(F.col("found").isNull(), "no_response")
        .when(same.isNull(), "no_validator")
        .when(same, "resolved")
        .otherwise("validator_mismatch")
    )
    judged = known.withColumn("status", status).withColumn("ok", F.col("status") == "resolved")
    newer = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("base", lambda k, _: ~F.array_contains(F.map_keys(newer), k)), newer)
    judged = judged.select(
        "record_id",
        F.col("key").alias("url_key"),
        "ts",
        "status",
        F.when(F.col("ok"), F.col("found.record_id")).alias("response_id"),
        F.when(F.col("ok"), merged).alias("headers"),
    )
    bodies = (
        records.filter("kind = 'response' and record_id is not null")
        .groupBy(F.lit(True).alias("has"), F.col("record_id").alias("body_of"))
        .agg(F.max("body").alias("body"))
    )
    # the unresolved look for a body that isn't there, each under a key of its own
    wanted = judged.withColumns(
        {
            "has": F.col("response_id").isNotNull(),
            "body_of": F.coalesce("response_id", F.xxhash64("record_id", "url_key", "ts")),
        }
    )
    return wanted.join(bodies, ["has", "body_of"], "left").select(
        "record_id", "url_key", "ts", "status", "response_id", "headers", "body"
    )


def crawl_records(pages: DataFrame) -> DataFrame:
    """A crawl log derived from ``pages``: a full response of every page, and a later revisit of it.

    Revisits differ from the response in scheme, ``www``, case of the host and fragment; some carry a
    changed ETag, no ETag or no validator, and some come before the response.
    """
    p = F.col("page_id")
    ts = F.pmod(p * 7919, F.lit(1_000_003)) + 1_700_000_000
    etag, modified = F.md5("html"), (ts - F.pmod(p, F.lit(997))).cast("string")
    pairs = {"content-type": F.lit("text/html"), "server": F.lit("a"), "date": ts.cast("string")}
    pairs |= {"etag": etag, "last-modified": modified}
    first = pages.select(
        (p * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        ts.alias("ts"),
        F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]).alias("headers"),
        F.col("html").alias("body"),
    )
    late = F.when(p % 11 == 0, ts - 3_600).otherwise(ts + 3_600 * (1 + F.pmod(p, F.lit(60))))
    tag = F.when(p % 7 == 3, F.md5(F.concat("html", F.lit("x")))).when((p % 7 != 5) & (p % 7 != 6), etag)
    pairs = {"server": F.lit("b"), "content-length": F.lit("0"), "date": late.cast("string"), "etag": tag}
    pairs |= {"cache-control": F.lit("max-age=60"), "last-modified": F.when(p % 7 == 5, modified)}
    sent = F.map_filter(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    other = F.concat(F.lit("HTTPS://WWW."), F.regexp_replace("url", "^[a-z]+://(www[.])?", ""), F.lit("#again"))
    again = pages.select(
        (p * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        other.alias("url"),
        late.alias("ts"),
        sent.alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return first.unionByName(again)


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the derived crawl log, with merged headers and the payload's size and digest."""
    records = crawl_records(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolve_revisits(records).select(
        "record_id",
        "url_key",
        "ts",
        "status",
        "response_id",
        F.array_join(lines, "\n").alias("headers"),
        F.octet_length("body").cast("long").alias("payload_bytes"),
        F.md5("body").alias("payload_md5"),
    )


OP8_SQL = r"""
WITH b AS (
  SELECT page_id AS p, url, html, (page_id * 7919) % 1000003 + 1700000000 AS ts FROM pages
), k AS (
  SELECT *, regexp_replace(url, '#.*$', '') AS bare FROM b
), c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[A-Za-z]+://([^/?]*)', 1)), ':(80|443)$', ''),
                           '^www[0-9]*\.', '')
            || regexp_replace(regexp_extract(bare, '^[A-Za-z]+://[^/?]*([^?]*)', 1), '/+$', '') AS page_key,
         list_sort(list_filter(string_split(CASE WHEN contains(bare, '?') THEN regexp_extract(bare, '\?(.*)$', 1) ELSE '' END, '&'),
                   lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS q
  FROM k
), f AS (
  SELECT *, page_key || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key,
         md5(html) AS tag, CAST(ts - p % 997 AS VARCHAR) AS modified,
         CASE WHEN p % 11 = 0 THEN ts - 3600 ELSE ts + 3600 * (1 + p % 60) END AS late
  FROM c
), r AS (
  SELECT f.p, f.url_key, f.late, f.tag AS own_tag, f.modified AS own_modified, max(struct_pack(ts := g.ts, rid := g.p * 2)) AS found
  FROM f LEFT JOIN f g ON g.url_key = f.url_key AND g.ts < f.late GROUP BY ALL
), j AS (
  SELECT r.*, g.tag, g.modified, g.html, g.ts AS base_ts,
         CASE WHEN r.p % 7 IN (5, 6) THEN NULL WHEN r.p % 7 = 3 THEN md5(own.html || 'x') ELSE own_tag END AS sent_tag,
         CASE WHEN r.p % 7 = 5 THEN own_modified END AS sent_modified
  FROM r JOIN f own ON own.p = r.p LEFT JOIN f g ON g.p * 2 = r.found.rid
), s AS (
  SELECT *, CASE WHEN found.rid IS NULL THEN 'no_response'
                 WHEN coalesce(sent_tag = tag, sent_modified = modified) IS NULL THEN 'no_validator'
                 WHEN coalesce(sent_tag = tag, sent_modified = modified) THEN 'resolved'
                 ELSE 'validator_mismatch' END AS status
  FROM j
)
SELECT p * 2 + 1 AS record_id, url_key, late AS ts, status,
       CASE WHEN status = 'resolved' THEN found.rid END AS response_id,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10)
            || 'date: ' || CAST(late AS VARCHAR) || chr(10) || 'etag: ' || coalesce(sent_tag, tag) || chr(10)
            || 'last-modified: ' || coalesce(sent_modified, modified) || chr(10) || 'server: a' END AS headers,
       CASE WHEN status = 'resolved' THEN CAST(strlen(html) AS BIGINT) END AS payload_bytes,
       CASE WHEN status = 'resolved' THEN md5(html) END AS payload_md5
FROM s
"""
