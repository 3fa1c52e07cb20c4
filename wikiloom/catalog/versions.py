"""Version histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import standins
from wikiloom.catalog.registry import query, string, table
from wikiloom.operators import requests
from wikiloom.operators import versions as ops
from wikiloom.operators.pages import attachment_counts
from wikiloom.scale import scratch_path
from wikiloom.sources.sinks import write_bodies

V = standins.SQL_VERSIONS
_PLACED = f"""
  SELECT page_id, number, row_number() OVER (PARTITION BY page_id ORDER BY number) AS position,
         count(*) OVER (PARTITION BY page_id) AS total FROM ({V})"""
NEWEST, BATCH = 3, 2


def placed(spark: SparkSession, sf: str) -> DataFrame:
    return ops.history(standins.versions(spark, sf))


@query("w1_history", f"SELECT *, position = total AS is_current FROM ({_PLACED})")
def w1(spark: SparkSession, sf: str) -> DataFrame:
    return placed(spark, sf)


@query(
    "u4_merged_history",
    """SELECT o_custkey AS page_id, o_orderkey AS number, o_orderstatus = 'P' AS is_current,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'P', o_orderkey)
                AS position, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders""",
)
def u4(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    rows = orders.select(
        F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("number"), "o_orderstatus"
    )
    is_open = F.col("o_orderstatus") == "P"
    return ops.merged_history(
        rows.where(~is_open).drop("o_orderstatus"), rows.where(is_open).drop("o_orderstatus")
    )


@query(
    "p10_newest_versions",
    f"""SELECT page_id, number, position, total FROM ({_PLACED})
        WHERE position < total AND position >= total - {NEWEST}""",
)
def p10(spark: SparkSession, sf: str) -> DataFrame:
    return ops.capped(placed(spark, sf), NEWEST).drop("is_current")


_REPORT = f"""
  SELECT page_id, count(*) AS total, least(count(*) - 1, {NEWEST}) AS kept,
         count(*) - 1 - least(count(*) - 1, {NEWEST}) AS skipped, FALSE AS large
  FROM ({V}) GROUP BY page_id"""


@query("p10_cap_report", _REPORT)
def p10_report(spark: SparkSession, sf: str) -> DataFrame:
    return ops.cap_report(placed(spark, sf), NEWEST)


@query(
    "a13_coverage",
    f"""SELECT count(*) AS pages, sum(total)::BIGINT AS versions, sum(kept)::BIGINT AS kept,
               sum(skipped)::BIGINT AS skipped, count(*) FILTER (large) AS large_pages
        FROM ({_REPORT})""",
)
def a13(spark: SparkSession, sf: str) -> DataFrame:
    return ops.coverage(ops.cap_report(placed(spark, sf), NEWEST))


@query(
    "w2_version_batches",
    f"""SELECT page_id, number, (position - greatest(total - {NEWEST}, 1)) // {BATCH} AS batch
        FROM ({_PLACED}) WHERE position < total AND position >= total - {NEWEST}""",
)
def w2(spark: SparkSession, sf: str) -> DataFrame:
    kept = ops.capped(placed(spark, sf), NEWEST)
    return ops.version_batches(kept, NEWEST, BATCH).select("page_id", "number", "batch")


@query(
    "w2_batch_totals",
    f"""SELECT page_id, (position - 1) // {BATCH} AS batch, count(*) AS versions,
               min(number) AS first_number, max(number) AS last_number
        FROM ({_PLACED}) WHERE position < total GROUP BY ALL""",
)
def w2_totals(spark: SparkSession, sf: str) -> DataFrame:
    return ops.batch_totals(ops.version_batches(ops.capped(placed(spark, sf)), 0, BATCH))


@query("w10_last_versions", f"SELECT page_id, number FROM ({_PLACED}) WHERE position > total - 3")
def w10(spark: SparkSession, sf: str) -> DataFrame:
    return ops.last_versions(placed(spark, sf), 3).select("page_id", "number")


@query("w10_named_versions", f"SELECT page_id, number FROM ({_PLACED}) WHERE number IN (1, 4, 7)")
def w10_named(spark: SparkSession, sf: str) -> DataFrame:
    return ops.named_versions(placed(spark, sf), [1, 4, 7]).select("page_id", "number")


_MISSING = f"""
  SELECT page_id, unnest(generate_series(lo, hi)) AS number
  FROM (SELECT page_id, min(number) AS lo, max(number) AS hi FROM ({V}) GROUP BY page_id)
  EXCEPT SELECT page_id, number FROM ({V})"""


@query("j11_missing_numbers", _MISSING)
def j11(spark: SparkSession, sf: str) -> DataFrame:
    return ops.missing_numbers(standins.versions(spark, sf))


@query(
    "u3_missing_per_page",
    f"SELECT page_id, count(*) AS missing, min(number) AS first_missing FROM ({_MISSING}) GROUP BY page_id",
)
def u3(spark: SparkSession, sf: str) -> DataFrame:
    """Expected minus actual numbers, counted per page."""
    return (
        ops.missing_numbers(standins.versions(spark, sf))
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("missing"), F.min("number").alias("first_missing"))
    )


_CHANGES = """
  SELECT conv_id AS page_id, previous, turn AS number,
         CASE WHEN old = '' AND text = '' THEN 'both empty' WHEN old = text THEN 'identical'
              ELSE 'changed' END AS state,
         length(old)::INT AS previous_size, length(text)::INT AS size
  FROM (SELECT conv_id, turn, text, lag(text) OVER w AS old, lag(turn) OVER w AS previous
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE previous IS NOT NULL"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    talks = standins.talks(spark, sf)
    return ops.consecutive_pairs(ops.history(talks.select("page_id", "number")), talks)


@query("w3_version_changes", _CHANGES)
def w3(spark: SparkSession, sf: str) -> DataFrame:
    return ops.version_changes(_pairs(spark, sf))


@query(
    "w3_version_line_changes",
    f"""WITH c AS (
          SELECT * FROM (SELECT conv_id, turn, text, lag(text) OVER w AS old
                         FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
          WHERE old <> text),
        d AS (SELECT conv_id, turn, line, sum(sign) AS n FROM (
                SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, 1 AS sign FROM c
                WHERE text <> '' UNION ALL
                SELECT conv_id, turn, unnest(string_split(old, chr(10))), -1 FROM c WHERE old <> '')
              GROUP BY conv_id, turn, line),
        t AS (SELECT conv_id AS page_id, turn AS number, sum(greatest(n, 0)) AS added,
                     sum(greatest(-n, 0)) AS removed FROM d GROUP BY conv_id, turn)
        SELECT x.*, coalesce(added, 0)::BIGINT AS added, coalesce(removed, 0)::BIGINT AS removed
        FROM ({_CHANGES}) x LEFT JOIN t USING (page_id, number)""",
)
def w3_lines(spark: SparkSession, sf: str) -> DataFrame:
    """With the lines added and removed, as a difference of multisets."""
    return ops.line_changes(ops.version_changes(_pairs(spark, sf)), standins.talks(spark, sf))


@query(
    "a4_version_totals",
    f"""SELECT count(*) AS pages, sum(n)::BIGINT AS versions,
               round(sum(n) / count(*), 1)::DOUBLE AS mean_versions,
               round(sum(n) * 0.15::DOUBLE / 60, 2)::DOUBLE AS minutes
        FROM (SELECT page_id, count(*) AS n FROM ({V}) GROUP BY page_id)""",
)
def a4(spark: SparkSession, sf: str) -> DataFrame:
    return ops.version_totals(standins.versions(spark, sf))


@query(
    "a5_attachments_per_page",
    "SELECT l_partkey AS page_id, count(*) AS attachments FROM lineitem GROUP BY l_partkey",
)
def a5(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("page_id"))
    return attachment_counts(rows)


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as bodies from several sources of one page per language."""
    return table(spark, sf, "documents").select(
        F.col("lang").alias("page_id"), F.col("doc_id").alias("source"), F.col("text").alias("body")
    )


_GROUPS = """
  SELECT lang AS page_id, left(md5(text), 12) AS fingerprint, count(*) AS sources,
         max(length(text))::INT AS size, min(doc_id) AS first_source
  FROM documents GROUP BY lang, left(md5(text), 12)"""


@query("a8_content_groups", _GROUPS)
def a8(spark: SparkSession, sf: str) -> DataFrame:
    return ops.content_groups(_sources(spark, sf))


@query(
    "a8_content_verdict",
    f"""SELECT page_id, count(*) AS contents, CASE WHEN count(*) = 1 THEN 'identical' ELSE 'mismatch'
        END AS verdict FROM ({_GROUPS}) GROUP BY page_id""",
)
def a8_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return ops.content_verdict(ops.content_groups(_sources(spark, sf)))


@query(
    "a8_content_members",
    f"""SELECT g.page_id, g.fingerprint, doc_id AS source, g.first_source
        FROM documents JOIN ({_GROUPS}) g ON lang = page_id AND left(md5(text), 12) = fingerprint""",
)
def a8_members(spark: SparkSession, sf: str) -> DataFrame:
    sources = _sources(spark, sf)
    return ops.content_members(sources, ops.content_groups(sources))


def _states(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines asked for; returned ones gave no data, heavily taxed ones could not be written."""
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").cast("long").alias("number")
    ).agg(F.max("l_returnflag").alias("flag"), F.max("l_tax").alias("tax"))
    asked = lines.select("page_id", "number")
    got = lines.where("flag <> 'R'").select("page_id", "number")
    pushed = lines.select("page_id", "number", (F.col("tax") <= 0.07).alias("ok"))
    return ops.fetched_against_asked(asked, got, pushed)


_SQL_STATES = """
  SELECT l_orderkey AS page_id, l_linenumber::BIGINT AS number,
         CASE WHEN max(l_returnflag) = 'R' THEN 'no_data' WHEN max(l_tax) > 0.07 THEN 'push_fail'
              ELSE 'ok' END AS state
  FROM lineitem GROUP BY l_orderkey, l_linenumber"""


@query("j13_fetched_against_asked", _SQL_STATES)
def j13(spark: SparkSession, sf: str) -> DataFrame:
    return _states(spark, sf)


@query(
    "j13_failed_entries",
    f"""SELECT page_id, number, 'v' || number || ':' || state AS entry FROM ({_SQL_STATES})
        WHERE state <> 'ok'""",
)
def j13_failed(spark: SparkSession, sf: str) -> DataFrame:
    return ops.failed_entries(_states(spark, sf))


@query(
    "a9_revision_check",
    f"""SELECT page_id, asked, fetched, pushed, failed, o_custkey % 9 AS new_revisions,
               o_custkey % 9 < pushed AS mismatch
        FROM (SELECT page_id, count(*) AS asked, count(*) FILTER (state <> 'no_data') AS fetched,
                     count(*) FILTER (state = 'ok') AS pushed,
                     count(*) FILTER (state <> 'ok') AS failed
              FROM ({_SQL_STATES}) GROUP BY page_id) JOIN orders ON o_orderkey = page_id""",
)
def a9(spark: SparkSession, sf: str) -> DataFrame:
    """The customer number gives the revisions of an order's page before and after."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey").alias("page_id")
    before = orders.select(key, (F.col("o_custkey") % 4).alias("revision")).where("revision > 0")
    after = orders.select(key, (F.col("o_custkey") % 4 + F.col("o_custkey") % 9).alias("revision"))
    return ops.revision_check(_states(spark, sf), before, after)


def _fetches(spark: SparkSession, sf: str) -> DataFrame:
    """Events as fetches per user: half of the event types fail."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("page_id"),
        F.col("event_id").alias("attempt"),
        F.when(kind.isin("error", "click", "view"), F.lit("failed"))
        .when(kind == "signup", F.lit("not_found"))
        .otherwise(F.lit("ok"))
        .alias("outcome"),
    )


_SQL_FETCHES = """
  SELECT user_id AS page_id, event_id AS attempt, CASE WHEN event_type IN ('error', 'click', 'view')
           THEN 'failed' WHEN event_type = 'signup' THEN 'not_found' ELSE 'ok' END AS outcome
  FROM events"""
_SQL_CUTS = f"""
  SELECT page_id, min(attempt) AS cut_at FROM (
    SELECT page_id, attempt, row_number() OVER (PARTITION BY page_id, run ORDER BY attempt) AS place
    FROM (SELECT page_id, attempt, outcome,
                 row_number() OVER (PARTITION BY page_id ORDER BY attempt)
                 - row_number() OVER (PARTITION BY page_id, outcome ORDER BY attempt) AS run
          FROM ({_SQL_FETCHES}) WHERE outcome <> 'not_found') WHERE outcome = 'failed')
  WHERE place = 5 GROUP BY page_id"""


@query("w5_failure_cuts", _SQL_CUTS)
def w5(spark: SparkSession, sf: str) -> DataFrame:
    return ops.cut_after_failures(_fetches(spark, sf))


@query(
    "w5_fetches_before_cut",
    f"""SELECT f.* FROM ({_SQL_FETCHES}) f LEFT JOIN ({_SQL_CUTS}) c USING (page_id)
        WHERE cut_at IS NULL OR attempt <= cut_at""",
)
def w5_before(spark: SparkSession, sf: str) -> DataFrame:
    fetches = _fetches(spark, sf)
    return ops.before_cut(fetches, ops.cut_after_failures(fetches))


@query(
    "a3_space_summary",
    """SELECT o_custkey::VARCHAR AS space,
              count(*) FILTER (o_orderpriority < '3' AND o_orderstatus <> 'P') AS pages,
              count(*) FILTER (o_orderpriority >= '3' AND o_orderstatus <> 'P') AS versions,
              count(*) FILTER (o_orderpriority < '3' AND o_orderstatus = 'P') AS errors,
              round(count(*) FILTER (o_orderpriority < '3' AND o_orderstatus <> 'P')
                    / (count(*) * 0.25::DOUBLE), 4)::DOUBLE AS pages_per_second
       FROM orders GROUP BY o_custkey""",
)
def a3(spark: SparkSession, sf: str) -> DataFrame:
    results = table(spark, sf, "orders").select(
        string("o_custkey").alias("space"),
        F.when(F.col("o_orderpriority") < "3", "page").otherwise("version").alias("kind"),
        (F.col("o_orderstatus") != "P").alias("ok"),
        F.lit(0.25).alias("seconds"),
    )
    return requests.space_summary(results)


@query(
    "s17_raw_bodies",
    "SELECT conv_id AS page_id, turn AS number, text AS body, role AS author FROM conversations WHERE text <> ''",
)
def s17(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    write_bodies(standins.talks(spark, sf), path)
    return spark.read.parquet(path)
