"""Query for revisits: the pages as they were fetched, and a second visit to each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.registry import query, table
from wikiloom.llm.warc import resolve_revisits

PAGE_KINDS = 3  # every third page is fetched again before the others are fetched at all
LATER = 1_000_000_000


def visits(pages: DataFrame) -> DataFrame:
    """Two records per page: its response, and a revisit whose entity tag differs for every fifth.

    The revisits of every third page come before all responses.
    """
    etag = F.md5(F.coalesce("html", F.lit("")))
    day = F.concat(F.lit("day "), F.col("page_id").cast("string"))
    responses = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("page_id").alias("ts"),
        F.lit("response").alias("kind"), etag.alias("etag"), F.sha2("html", 256).alias("digest"),
        F.create_map(
            F.lit("Date"), day, F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), etag
        ).alias("headers"),
    )
    changed = F.col("page_id") % 5 == 0
    tag = F.when(changed, F.md5(F.concat(F.coalesce("html", F.lit("")), F.lit("!")))).otherwise(etag)
    first = F.when(F.col("page_id") % PAGE_KINDS == 0, -LATER).otherwise(LATER)
    revisits = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("page_id") + first).alias("ts"),
        F.lit("revisit").alias("kind"), tag.alias("etag"), F.lit(None).cast("string").alias("digest"),
        F.create_map(
            F.lit("Date"), F.concat(day, F.lit(" again")), F.lit("Content-Type"), F.lit("none"),
            F.lit("Vary"), F.lit("accept"),
        ).alias("headers"),
    )
    return responses.unionByName(revisits)


OP3_SQL = r"""
WITH p AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS bare
  FROM pages
), q AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/index\.html$', '/'), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=&]*|ref)(=|$)'))), '&') AS params
  FROM p
), u AS (
  SELECT page_id, coalesce(html, '') AS html,
         host || path || CASE WHEN params <> '' THEN '?' || params ELSE '' END AS page,
         page_id + CASE WHEN page_id % 3 = 0 THEN -1000000000 ELSE 1000000000 END AS again
  FROM q
), j AS (
  SELECT v.page_id, v.page, v.html, v.page_id % 5 = 0 AS changed, r.page_id AS base, r.html AS base_html,
         row_number() OVER (PARTITION BY v.page_id ORDER BY r.page_id DESC NULLS LAST) AS n
  FROM u v LEFT JOIN u r ON r.page = v.page AND r.page_id < v.again
), s AS (
  SELECT *, CASE WHEN base IS NULL THEN 'no_response'
                 WHEN NOT changed AND md5(html) = md5(base_html) THEN 'resolved'
                 WHEN changed AND md5(html || '!') = md5(base_html) THEN 'resolved'
                 ELSE 'changed' END AS status
  FROM j WHERE n = 1
)
SELECT page_id * 2 + 1 AS record_id, page, status, base * 2 AS response_id,
       CASE WHEN status = 'resolved' THEN
         'content-type: text/html; date: day ' || page_id || ' again; etag: ' || md5(base_html) || '; vary: accept'
       END AS headers
FROM s
"""


@query("op3_warc_revisits", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(visits(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda h: F.concat(h["key"], F.lit(": "), h["value"]))
    return found.withColumn("headers", F.array_join(lines, "; "))
