"""Not-modified revisits of a web archive, resolved to the full response that they stand for.

A revisit takes the latest earlier full response of its canonical URL, provided its validators agree, and its own headers
update those of the response as far as a not-modified answer may. The as-of join never holds a URL in one
task: captures are sorted over all partitions by URL and time, each partition looks back within itself, and what
it cannot see comes from one row per partition before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthmill.llm.common import partitions, staged, table

# Headers that a not-modified answer updates, and query parameters that do not change a page.
UPDATED_HEADERS = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

URL_PARTS = "^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)[?]?([^#]*)"


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port in lower case, path without a closing slash, sorted query without tracking."""
    host = F.lower(F.regexp_extract(url, URL_PARTS, 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, URL_PARTS, 2), "/+$", "")
    asked = F.filter(F.split(F.regexp_extract(url, URL_PARTS, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(asked), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _tag(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Resolve the captures of kind ``revisit``; those of kind ``response`` pass through as ``full``.

    ``captures`` has ``record_id``, ``url``, ``fetched_at`` (long), ``kind``, ``etag``, ``last_modified``, ``headers`` (map, names in lower case)
    and ``payload_digest``. Returns them with ``canonical_url``, ``resolved_from``, ``outcome`` and updated ``headers``. Earlier means
    smaller (fetched_at, record_id). Outcomes of a revisit: ``matched``; ``unvalidated`` (it names no validator), which resolves
    too; ``mismatched``; ``orphan`` (no earlier response, or a null url). The latter two keep their own headers and
    have no payload. An entity tag goes before a date; weak tags compare by value. Captures of another kind are ``ignored``. A null
    time comes before all times. Repeated rows resolve each; an empty table gives no rows; other columns are ignored.
    """
    plain = captures.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "fetched_at", "kind", "etag", "last_modified",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload_digest",
    )
    order = ["canonical_url", "fetched_at", "record_id"]
    dealt = plain.repartitionByRange(partitions(captures.sparkSession), *order)
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()), "captures")
    answer = F.when(
        F.col("kind") == "response", F.struct("record_id", "etag", "last_modified", "headers", "payload_digest")
    )
    inside = Window.partitionBy("part", "canonical_url").orderBy("fetched_at", "record_id")
    rows = dealt.withColumn("_near", F.last(answer, True).over(inside.rowsBetween(Window.unboundedPreceding, -1)))

    # One row per partition: its last URL with the last response to it, and its first URL.
    span = dealt.groupBy("part").agg(F.min("canonical_url").alias("low"), F.max("canonical_url").alias("high"))
    ends = dealt.join(F.broadcast(span.select("part", F.col("high").alias("canonical_url"))), ["part", "canonical_url"])
    tails = ends.where(F.col("kind") == "response").groupBy("part", "canonical_url").agg(
        F.max_by(answer, F.struct("fetched_at", "record_id")).alias("far")
    )
    none = F.lit(None).cast(tails.schema["far"].dataType)
    heads = span.where("low IS NOT NULL").select("part", F.col("low").alias("canonical_url"), none.alias("far"))
    before = Window.partitionBy("canonical_url").orderBy("part", "tail").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.withColumn("tail", F.lit(0)).unionByName(tails.withColumn("tail", F.lit(1)))
    carried = carried.withColumn("_far", F.last("far", True).over(before)).where("tail = 0")
    carried = carried.select("part", "canonical_url", "_far")

    found = rows.join(F.broadcast(carried), ["part", "canonical_url"], "left")
    earlier = F.when(F.col("canonical_url").isNotNull(), F.coalesce("_near", "_far"))
    return _merged(found.withColumn("_earlier", earlier))


def _merged(found: DataFrame) -> DataFrame:
    old = F.col("_earlier")
    by_tag = F.when(_tag(F.col("etag")) == F.coalesce(_tag(old["etag"]), F.lit("")), "matched").otherwise("mismatched")
    by_date = F.when(F.col("last_modified") == F.coalesce(old["last_modified"], F.lit("")), "matched").otherwise("mismatched")
    outcome = (
        F.when(F.col("kind") == "response", "full")
        .when(~F.coalesce(F.col("kind") == "revisit", F.lit(False)), "ignored")
        .when(old.isNull(), "orphan")
        .when(F.col("etag").isNotNull(), by_tag)
        .when(F.col("last_modified").isNotNull(), by_date)
        .otherwise("unvalidated")
    )
    updates = F.map_filter("headers", lambda name, _: name.isin(UPDATED_HEADERS))
    stored = F.map_filter(old["headers"], lambda name, _: ~F.array_contains(F.map_keys(updates), name))
    resolved = F.col("outcome").isin("matched", "unvalidated")
    return found.withColumn("outcome", outcome).select(
        "record_id", "canonical_url", "fetched_at", "kind", "outcome",
        F.when(resolved, old["record_id"]).alias("resolved_from"),
        F.when(resolved, old["payload_digest"]).when(F.col("kind") == "response", F.col("payload_digest")).alias("payload_digest"),
        F.when(resolved, F.map_concat(stored, updates)).otherwise(F.col("headers")).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures as a crawler would have made them of every page: a full response and, by ``page_id``, later and earlier revisits.

    Revisits use other spellings of the URL; some carry the tag of another version, some only a date, some nothing.
    """
    day = (F.col("page_id") / 7).cast("long").cast("string")
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    time = F.col("page_id") * 100
    nothing = F.lit(None).cast("string")

    def capture(number: int, kind: str, url, at, etag, modified, headers: dict, payload):
        pairs = [x for name, value in headers.items() for x in (F.lit(name), value)]
        return F.struct(
            (F.col("page_id") * 4 + number).alias("record_id"), url.alias("url"), at.alias("fetched_at"), F.lit(kind).alias("kind"),
            etag.alias("etag"), modified.alias("last_modified"), F.create_map(*pairs).alias("headers"), payload.alias("payload_digest"),
        )

    def told(at):
        return {"date": at.cast("string"), "cache-control": F.lit("no-cache"), "content-length": F.lit("0"), "x-cache": F.lit("hit")}

    full = {
        "date": time.cast("string"), "etag": tag, "last-modified": day, "cache-control": F.lit("max-age=60"),
        "content-type": F.lit("text/html"), "content-length": F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
    }
    changed = F.when(F.col("page_id") % 5 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    url, again = F.col("url"), F.concat(F.col("url"), F.lit("#again"))
    made = [
        capture(0, "response", url, time, tag, day, full, digest),
        F.when(F.col("page_id") % 3 != 2, capture(1, "revisit", again, time + 250, changed, nothing, told(time + 250), nothing)),
        F.when(
            F.col("page_id") % 4 == 1,
            capture(2, "revisit", url, time + 400, nothing, F.when(F.col("page_id") % 8 == 1, day), told(time + 400), nothing),
        ),
        F.when(F.col("page_id") % 11 == 0, capture(3, "revisit", again, time - 50, tag, nothing, told(time - 50), nothing)),
    ]
    return pages.select(F.explode(F.array_compact(F.array(*made))).alias("c")).select("c.*")


def revisits_of(spark, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(captures_of(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return resolved.withColumn("headers", F.array_join(lines, "|"))


REVISITS_SQL = r"""
WITH p AS (
    SELECT page_id, url, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size,
           '"' || sha256(coalesce(html, ''))[1:16] || '"' AS tag, (page_id // 7)::VARCHAR AS day, page_id * 100 AS t
    FROM pages
), c AS (
    SELECT page_id * 4 AS record_id, url, t AS fetched_at, 'response' AS kind, tag AS etag, day AS last_modified,
           ['cache-control=max-age=60', 'content-length=' || size, 'content-type=text/html', 'date=' || t, 'etag=' || tag,
            'last-modified=' || day] AS headers, digest AS payload_digest FROM p
    UNION ALL
    SELECT page_id * 4 + 1, url || '#again', t + 250, 'revisit', CASE WHEN page_id % 5 = 0 THEN '"other"' ELSE 'W/' || tag END, NULL,
           ['cache-control=no-cache', 'content-length=0', 'date=' || (t + 250), 'x-cache=hit'], NULL FROM p WHERE page_id % 3 <> 2
    UNION ALL
    SELECT page_id * 4 + 2, url, t + 400, 'revisit', NULL, CASE WHEN page_id % 8 = 1 THEN day END,
           ['cache-control=no-cache', 'content-length=0', 'date=' || (t + 400), 'x-cache=hit'], NULL FROM p WHERE page_id % 4 = 1
    UNION ALL
    SELECT page_id * 4 + 3, url || '#again', t - 50, 'revisit', tag, NULL,
           ['cache-control=no-cache', 'content-length=0', 'date=' || (t - 50), 'x-cache=hit'], NULL FROM p WHERE page_id % 11 = 0
), u AS (
    SELECT *, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)[?]?([^#]*)', ['host', 'path', 'query']) AS parts FROM c
), v AS (
    SELECT u.* EXCLUDE (parts), regexp_replace(regexp_replace(lower(parts.host), '^www[0-9]*[.]', ''), ':(80|443)$', '')
        || CASE WHEN regexp_replace(parts.path, '/+$', '') = '' THEN '/' ELSE regexp_replace(parts.path, '/+$', '') END
        || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(parts.query, '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&'), ''), '') AS canonical_url FROM u
), w AS (
    SELECT *, last_value(CASE WHEN kind = 'response' THEN record_id END IGNORE NULLS) OVER (
        PARTITION BY canonical_url ORDER BY fetched_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM v
), o AS (
    SELECT w.*, r.payload_digest AS old_payload, r.headers AS old_headers, CASE
        WHEN w.kind = 'response' THEN 'full' WHEN w.earlier IS NULL THEN 'orphan'
        WHEN w.etag IS NOT NULL THEN CASE WHEN regexp_replace(w.etag, '^W/', '') = r.etag THEN 'matched' ELSE 'mismatched' END
        WHEN w.last_modified IS NOT NULL THEN CASE WHEN w.last_modified = r.last_modified THEN 'matched' ELSE 'mismatched' END
        ELSE 'unvalidated' END AS outcome
    FROM w LEFT JOIN v r ON r.record_id = w.earlier
)
SELECT record_id, canonical_url, fetched_at, kind, outcome,
    CASE WHEN outcome IN ('matched', 'unvalidated') THEN earlier END AS resolved_from,
    CASE WHEN outcome IN ('matched', 'unvalidated') THEN old_payload ELSE payload_digest END AS payload_digest,
    array_to_string(CASE WHEN outcome IN ('matched', 'unvalidated') THEN list_sort(list_concat(
        list_filter(old_headers, lambda x: split_part(x, '=', 1) NOT IN ('cache-control', 'date')),
        list_filter(headers, lambda x: split_part(x, '=', 1) IN ('cache-control', 'date')))) ELSE list_sort(headers) END, '|') AS headers
FROM o
"""
