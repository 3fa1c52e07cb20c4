"""Readers of landed responses, over responses that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import standins
from wikiloom.catalog.registry import land, placed, query, string, table
from wikiloom.scale import scratch_path
from wikiloom.sources import landed as read

PAGE_SIZE = 25


def _responses(df: DataFrame, number: Column, item: Column, *keep: str) -> DataFrame:
    """Listing responses of PAGE_SIZE items each, in the order of ``number`` (0, 1, 2, ..)."""
    start = (F.floor(number / PAGE_SIZE) * PAGE_SIZE).alias("start")
    return (
        df.select(*keep, start, F.struct(number.alias("n"), item.alias("item")).alias("r"))
        .groupBy(*keep, "start")
        .agg(F.sort_array(F.collect_list("r"))["item"].alias("results"))
    )


@query(
    "s1_read_spaces",
    """SELECT c_name AS key, c_mktsegment || ' ' || c_custkey AS name, c_mktsegment AS type,
              c_custkey AS ord FROM customer""",
)
def s1(spark: SparkSession, sf: str) -> DataFrame:
    spaces = standins.spaces(spark, sf)
    item = F.struct("key", "name", "type")
    return read.read_spaces(spark, land(_responses(spaces, F.col("ord"), item), "spaces"))


@query(
    "s2_read_pages",
    r"""SELECT page_id::VARCHAR AS id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
               1 AS number, length(html)::INT AS size, page_id AS ord FROM pages""",
)
def s2(spark: SparkSession, sf: str) -> DataFrame:
    """Every other response holds its results below ``page``."""
    pages = table(spark, sf, "pages")
    item = F.struct(
        string("page_id").alias("id"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.struct(F.lit(1).alias("number")).alias("version"),
        F.struct(F.struct(F.col("html").alias("value")).alias("view")).alias("body"),
    )
    responses = _responses(pages, F.col("page_id"), item)
    other = F.floor(F.col("start") / PAGE_SIZE) % 2 == 1
    shaped = responses.select(
        "start",
        F.when(other, F.slice("results", 1, 0)).otherwise(F.col("results")).alias("results"),
        F.when(other, F.struct("results")).alias("page"),
    )
    return read.read_pages(spark, land(shaped, "pages")).select(
        "id", "title", "version.number", F.length("body.view.value").alias("size"), "ord"
    )


@query(
    "s3_complete_pages",
    """SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderstatus = 'P' THEN 'found' ELSE 'listed' END
              AS title FROM orders""",
)
def s3(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders are missing in the listing; each child is seen below two parents."""
    orders = table(spark, sf, "orders")
    shape = orders.select(
        string("o_orderkey").alias("id"), F.col("o_orderkey").alias("start"), "o_orderstatus", "o_custkey"
    )

    def item(title: str) -> Column:
        return F.array(F.struct("id", F.lit(title).alias("title"))).alias("results")

    listing = shape.where("o_orderstatus <> 'P'").select("start", item("listed"))
    below = shape.select("start", string("o_custkey").alias("parent_id"), item("found"))
    again = shape.select((F.col("start") + 1).alias("start"), F.lit("z").alias("parent_id"), item("again"))
    pages = read.read_pages(spark, land(listing, "listing"))
    children = read.read_child_pages(spark, land(below.unionByName(again), "children"))
    return read.complete_pages(pages, children).select("id", "title")


@query(
    "s4_read_versions",
    """SELECT conv_id::VARCHAR AS page_id, turn::INT AS number, role AS author,
              '2024-01-01T00:00:00.000Z' AS "when", 'm' || turn AS message,
              row_number() OVER (ORDER BY conv_id::VARCHAR, turn) AS place
       FROM conversations""",
)
def s4(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumn("page_id", string("conv_id"))
    item = F.struct(
        F.col("turn").alias("number"),
        F.lit("2024-01-01T00:00:00.000Z").alias("when"),
        F.concat(F.lit("m"), string("turn")).alias("message"),
        F.struct(F.col("role").alias("displayName")).alias("by"),
    )
    path = land(_responses(turns, F.col("turn"), item, "page_id"), "versions")
    return placed(read.read_versions(spark, path).orderBy("page_id", "number"))


@query(
    "s5_versions_from_latest",
    """SELECT page_id, number::INT AS number, CASE WHEN number = latest THEN 'a' || latest END AS author,
              CASE WHEN number = latest THEN '2024-01-01' END AS "when"
       FROM (SELECT l_orderkey::VARCHAR AS page_id, max(l_linenumber) AS latest FROM lineitem
             GROUP BY l_orderkey), LATERAL (SELECT unnest(generate_series(1, latest)) AS number)""",
)
def s5(spark: SparkSession, sf: str) -> DataFrame:
    latest = table(spark, sf, "lineitem").groupBy(string("l_orderkey").alias("page_id")).agg(
        F.max("l_linenumber").alias("n")
    )
    last = F.struct(
        F.col("n").alias("number"),
        F.lit("2024-01-01").alias("when"),
        F.struct(F.concat(F.lit("a"), string("n")).alias("displayName")).alias("by"),
    )
    path = land(latest.select("page_id", last.alias("lastUpdated")), "history")
    return read.versions_from_latest(read.read_latest_versions(spark, path))


@query(
    "s6_read_version_bodies",
    """SELECT conv_id::VARCHAR AS page_id, turn::INT AS number,
              CASE WHEN role = 'user' THEN text ELSE '' END AS "view", text AS storage, role AS author
       FROM conversations""",
)
def s6(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    value = F.struct(F.col("text").alias("value"))
    responses = turns.select(
        string("conv_id").alias("id"),
        F.struct(
            F.col("turn").alias("number"), F.struct(F.col("role").alias("displayName")).alias("by")
        ).alias("version"),
        F.struct(F.when(F.col("role") == "user", value).alias("view"), value.alias("storage")).alias(
            "body"
        ),
    )
    return read.read_version_bodies(spark, land(responses, "bodies")).drop("when")


@query(
    "s7_read_attachments",
    """SELECT p_partkey::VARCHAR AS page_id, p_name || '.png' AS title,
              CASE WHEN p_size > 25 THEN 'image/png' ELSE 'application/octet-stream' END AS media_type,
              '/download/' || p_partkey AS download, 0::BIGINT AS ord FROM part""",
)
def s7(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    item = F.struct(
        F.concat("p_name", F.lit(".png")).alias("title"),
        F.when(F.col("p_size") > 25, F.lit("image/png")).alias("mediaType"),
        F.struct(F.concat(F.lit("/download/"), string("p_partkey")).alias("download")).alias("_links"),
    )
    responses = part.select(
        string("p_partkey").alias("page_id"), F.lit(0).alias("start"), F.array(item).alias("results")
    )
    return read.read_attachments(spark, land(responses, "attachments"))


@query(
    "s8_read_projects",
    """SELECT 'n' || s_nationkey AS identifier, max(s_suppkey) AS id, arg_max(s_name, s_suppkey) AS name,
              max(s_nationkey)::BIGINT AS parent_id FROM supplier GROUP BY s_nationkey""",
)
def s8(spark: SparkSession, sf: str) -> DataFrame:
    """Many suppliers share a nation's identifier; the last one wins."""
    supplier = table(spark, sf, "supplier")
    item = F.struct(
        F.concat(F.lit("n"), string("s_nationkey")).alias("identifier"),
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.struct(F.col("s_nationkey").alias("id")).alias("parent"),
    )
    responses = _responses(supplier, F.col("s_suppkey"), item).select(
        F.col("start").alias("offset"), F.col("results").alias("projects")
    )
    return read.read_projects(spark, land(responses, "projects"))


@query(
    "s9_read_mapping",
    f"""SELECT row_no, parent, subproject, array_to_string(jira_keys, ' ') AS jira_keys,
               array_to_string(wiki_keys, ' ') AS wiki_keys, identifier
        FROM ({standins.SQL_ENTRIES})""",
)
def s9(spark: SparkSession, sf: str) -> DataFrame:
    """The sheet as CSV; its column names are kept for the first three, the last is found by place."""
    sheet = standins.sheet(spark, sf).withColumnRenamed("wiki_keys", "Spaces")
    path = scratch_path(spark, "sheet")
    sheet.write.option("header", True).csv(path)
    return read.read_mapping(spark, path).select(
        "row_no", "parent", "subproject", F.array_join("jira_keys", " ").alias("jira_keys"),
        F.array_join("wiki_keys", " ").alias("wiki_keys"), "identifier",
    )
