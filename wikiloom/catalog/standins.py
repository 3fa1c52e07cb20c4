"""Wiki-shaped tables that Spark derives from the given ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog.registry import string, table, texts
from wikiloom.scale import scratch_path
from wikiloom.sources import export
from wikiloom.sources import landed as sources


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def spaces(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as spaces."""
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("key"),
        text(F.col("c_mktsegment"), " ", string("c_custkey")).alias("name"),
        F.col("c_mktsegment").alias("type"),
        F.col("c_custkey").alias("ord"),
    )


def projects(spark: SparkSession, sf: str) -> DataFrame:
    """Projects: one per customer in debt, by cleaned name or by lower name, one per region."""
    customers = table(spark, sf, "customer").where("c_acctbal < 0")
    bare = F.lower(F.regexp_replace("c_name", "#", ""))
    by_name = customers.select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("c_name")).otherwise(bare).alias(
            "identifier"
        ),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
    )
    regions = table(spark, sf, "region").where("r_regionkey < 3").select(
        F.lower(F.regexp_replace("r_name", " ", "-")).alias("identifier"),
        (-F.col("r_regionkey") - 1).cast("long").alias("id"),
        F.col("r_name").alias("name"),
    )
    return by_name.unionByName(regions)


SQL_PROJECTS = """
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_name)
              ELSE lower(replace(c_name, '#', '')) END AS identifier,
         c_custkey AS id, c_name AS name
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT lower(replace(r_name, ' ', '-')), (-r_regionkey - 1)::BIGINT, r_name
  FROM region WHERE r_regionkey < 3
"""


def sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as rows of the mapping sheet; two keys of customers each, some rows are folders."""
    supplier = table(spark, sf, "supplier")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    number = F.col("s_suppkey")

    def customer(shift: int) -> Column:
        return text("Customer#", F.lpad((number * 2 + shift).cast("string"), 9, "0"))

    return rows.select(
        number.alias("row_no"),
        F.when(F.col("s_acctbal") > 9000, text("\U0001f4c1 ", F.col("r_name")))
        .when(F.col("s_acctbal") < 0, F.lit("None"))
        .otherwise(F.col("r_name"))
        .alias("parent"),
        text(F.col("n_name"), " unit ", string("s_suppkey")).alias("subproject"),
        F.when(F.col("s_acctbal") < 2000, F.lit("—"))
        .otherwise(text("JK", string("s_suppkey"), ", Jx", string("s_nationkey")))
        .alias("jira_keys"),
        F.lit("x").alias("owner"),
        F.lit("y").alias("state"),
        F.when(F.col("s_acctbal") > 7000, F.lit("—"))
        .otherwise(text(customer(0), " , ", F.lower(customer(1))))
        .alias("wiki_keys"),
    )


def entries(spark: SparkSession, sf: str) -> DataFrame:
    return sources.mapping_entries(sheet(spark, sf))


# The entries, with key lists as arrays.
SQL_ENTRIES = """
  SELECT s_suppkey AS row_no, r_name AS parent, n_name || ' unit ' || s_suppkey AS subproject,
         CASE WHEN s_acctbal < 2000 THEN []::VARCHAR[]
              ELSE ['JK' || s_suppkey, 'Jx' || s_nationkey] END AS jira_keys,
         CASE WHEN s_acctbal > 7000 THEN []::VARCHAR[]
              ELSE ['Customer#' || lpad((s_suppkey * 2)::VARCHAR, 9, '0'),
                    'customer#' || lpad((s_suppkey * 2 + 1)::VARCHAR, 9, '0')] END AS wiki_keys,
         CASE WHEN s_acctbal < 2000 THEN lower(n_name || '-unit-' || s_suppkey)
              ELSE 'jk' || s_suppkey END AS identifier
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_acctbal BETWEEN 0 AND 9000
"""


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Given pages, their language part of the path as space."""
    pages = texts(spark, sf, "pages", "page_id")
    return pages.select(
        string("page_id").alias("id"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1).alias("space_key"),
        F.col("page_id").alias("ord"),
    )


SQL_SITE_PAGES = r"""
  SELECT page_id::VARCHAR AS id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
         regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS space_key, page_id AS ord
  FROM pages
"""


def bodies(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "pages", "page_id").select(
        F.col("page_id"), F.col("html").alias("body")
    )


def linked_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Given pages whose relative links became links of every class.

    A label's length and the page number choose the class, and the target page for page links.
    """
    link = r'<a href="/([^"]*)">([^<]*)</a>'
    target = (F.col("page_id") * 7 + 3).cast("string")
    pages = texts(spark, sf, "pages", "page_id")
    by_id = F.regexp_replace(
        "html", link, F.concat(F.lit('<a href="/pages/viewpage.action?pageId='), target, F.lit('">$2</a>'))
    )
    by_anchor = F.regexp_replace("html", link, '<a href="#sec-$1">$2 part</a>')
    by_display = F.regexp_replace("html", link, '<a href="/display/EN/$1+page">$2</a>')
    outside = F.regexp_replace("html", link, '<a href="https://example.com/$1">$2</a>')
    size = F.length("url") % 5
    return pages.select(
        "page_id",
        F.when(size == 0, by_id)
        .when(size == 1, by_anchor)
        .when(size == 2, by_display)
        .when(size == 3, outside)
        .otherwise(F.col("html"))
        .alias("body"),
    )


# The links of linked_bodies: page, place, href, label.
SQL_LINKS = r"""
  SELECT page_id, pos, label, CASE length(url) % 5
           WHEN 0 THEN '/pages/viewpage.action?pageId=' || (page_id * 7 + 3)
           WHEN 1 THEN '#sec-' || word WHEN 2 THEN '/display/EN/' || word || '+page'
           WHEN 3 THEN 'https://example.com/' || word ELSE '/' || word END AS href,
         CASE length(url) % 5 WHEN 0 THEN 'page' WHEN 1 THEN 'anchor' WHEN 2 THEN 'display'
           WHEN 3 THEN 'external' ELSE 'relative' END AS class
  FROM (SELECT page_id, url, unnest(hrefs) AS word, unnest(labels) AS bare,
               generate_subscripts(hrefs, 1) - 1 AS pos,
               CASE WHEN length(url) % 5 = 1 THEN bare || ' part' ELSE bare END AS label
        FROM (SELECT page_id, url,
                     regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1) AS hrefs,
                     regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2) AS labels
              FROM pages))
"""


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as versions; some numbers of an order are missing."""
    return (
        table(spark, sf, "lineitem")
        .select(F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").cast("long").alias("number"))
        .distinct()
    )


SQL_VERSIONS = "SELECT DISTINCT l_orderkey AS page_id, l_linenumber::BIGINT AS number FROM lineitem"


def talks(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as versions with bodies."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("page_id"),
        F.col("turn").alias("number"),
        F.col("text").alias("body"),
        F.col("role").alias("author"),
    )


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as timed requests: errors are bad answers or none."""
    error = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        "ts",
        F.col("event_id").alias("seq"),
        (F.col("value") / 10).alias("elapsed"),
        F.when(F.col("event_type") == "view", text("v", string("user_id"), "/9 [u", string("user_id"), "]"))
        .when(F.col("event_type") == "click", text("version_count [u", string("user_id"), "]"))
        .when(F.col("event_type") == "signup", text("page_list [u", string("user_id"), "] start=0"))
        .otherwise(F.lit("health_check"))
        .alias("label"),
        F.when(error & (F.col("value") < 20), F.lit(None))
        .when(error, F.lit(500))
        .otherwise(F.lit(200))
        .cast("int")
        .alias("http_status"),
        F.col("user_id").alias("server"),
    )


SQL_LOG = """
  SELECT ts, event_id AS seq, value / 10 AS elapsed, user_id AS server,
         CASE event_type WHEN 'view' THEN 'v' || user_id || '/9 [u' || user_id || ']'
           WHEN 'click' THEN 'version_count [u' || user_id || ']'
           WHEN 'signup' THEN 'page_list [u' || user_id || '] start=0'
           ELSE 'health_check' END AS label,
         CASE WHEN event_type = 'error' AND value < 20 THEN NULL
              WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status
  FROM events
"""


def export_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as an XML export: the last turn is the page, others are old versions.

    Documents are its attachments. The export is written as XML and read back.
    """
    turns = table(spark, sf, "conversations")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    rows = turns.join(last, "conv_id")
    conv, turn = string("conv_id"), string("turn")
    is_last = F.col("turn") == F.col("last")
    page_id = F.when(is_last, text("c", conv)).otherwise(text("c", conv, "v", turn))
    nothing = F.lit(None).cast("string")

    def key(value: Column) -> Column:
        return F.struct(value.alias("_VALUE"), F.lit("id").alias("_name"))

    def prop(name: str, value: Column | str) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.struct(
            value.alias("_VALUE"), nothing.alias("_class"), F.lit(name).alias("_name"),
            F.when(F.lit(False), key(nothing)).alias("id"),
        )

    def ref(name: str, kind: str, value: Column) -> Column:
        return F.struct(
            nothing.alias("_VALUE"), F.lit(kind).alias("_class"), F.lit(name).alias("_name"),
            key(value).alias("id"),
        )

    def made(kind: str, identifier: Column, *properties: Column, held: Column | None = None) -> list[Column]:
        element = F.array(F.struct(key(nothing if held is None else held).alias("id")))
        collection = F.array(F.struct(F.lit("bodyContents").alias("_name"), element.alias("element")))
        return [
            F.lit(kind).alias("_class"),
            key(identifier).alias("id"),
            F.filter(F.array(*properties), lambda p: p.isNotNull()).alias("property"),
            F.when(F.lit(held is not None), collection).alias("collection"),
        ]

    above = text("c", F.floor(F.col("conv_id") / 3).cast("string"))
    status = (
        F.when(F.col("conv_id") % 17 == 16, F.lit("draft"))
        .when(F.col("conv_id") % 19 == 18, F.lit("deleted"))
        .otherwise(F.lit("current"))
    )
    pages = rows.select(
        *made(
            "Page",
            page_id,
            prop("title", text("Topic ", conv, ".", turn)),
            prop("version", turn),
            prop("contentStatus", status),
            prop("position", (F.col("conv_id") % 5).cast("string")),
            prop(
                "lastModificationDate",
                text("2024-01-0", (F.col("turn") + 1).cast("string"), " 10:00:00.000"),
            ),
            prop("lastModifierName", F.col("role")),
            F.when(F.col("conv_id") > 2, ref("parent", "Page", above)),
            F.when(~is_last, ref("originalVersion", "Page", text("c", conv))),
            held=text("b", page_id),
        )
    )
    bodies = rows.select(
        *made(
            "BodyContent",
            text("b", page_id),
            prop("body", text("<p>", F.col("text"), "</p>")),
            ref("content", "Page", page_id),
            prop("bodyType", F.when(F.col("role") == "user", "2").otherwise("0")),
        )
    )
    doc, lang = string("doc_id"), F.col("lang")
    owner = text("c", F.floor(F.col("doc_id") / 10).cast("string"))
    files = table(spark, sf, "documents").select(
        *made(
            "Attachment",
            text("a", doc),
            F.when(lang == "es", prop("title", text("t ", doc, ".png"))).otherwise(
                prop("fileName", text("f ", doc, ".", lang))
            ),
            ref("containerContent", "Page", owner),
            F.when(lang == "fr", prop("version", "3")),
            prop("contentStatus", F.when(lang == "de", "deleted").otherwise("current")),
            prop("fileSize", string("n_chars")),
        )
    )
    path = scratch_path(spark, "export")
    (
        pages.unionByName(bodies)
        .unionByName(files)
        .write.format("xml")
        .options(rootTag="objects", rowTag="object")
        .save(path)
    )
    return export.read_objects(spark, path)


def export_text(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as bodies of an XML export, in order; two of three hold the tags of an object."""
    doc = string("doc_id")
    tags = text('</object> <object class="Page"><id name="id">p', doc, "</id></object>")
    code = text("<pre><![CDATA[x</object>]] ></pre> </object> and ", tags)
    body = text(
        "<p>", F.replace(F.coalesce("text", F.lit("")), F.lit("]]>"), F.lit("]] >")),
        F.when(F.col("doc_id") % 3 == 0, tags).when(F.col("doc_id") % 3 == 1, code).otherwise(""), "</p>",
    )
    line = text(
        '<object class="BodyContent" package="w"><id name="id">b', doc, '</id><property name="body"><![CDATA[', body,
        ']]></property><property name="bodyType">2</property></object>\n<object class="Page"><id name="id">c', doc,
        '</id><property name="title">Title ', doc, "</property></object>",
    )
    path = scratch_path(spark, "export-text")
    documents = table(spark, sf, "documents")
    documents.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(line).write.text(path)
    return export.read_objects(spark, path)


SQL_EXPORT_BODY = """
  replace('<p>' || replace(coalesce(text, ''), ']]>', ']] >') || CASE doc_id % 3
    WHEN 0 THEN '</object> <object class="Page"><id name="id">p' || doc_id || '</id></object>'
    WHEN 1 THEN '<pre><![CDATA[x</object>]] ></pre> </object> and </object> <object class="Page">'
      || '<id name="id">p' || doc_id || '</id></object>'
    ELSE '' END || '</p>', ']] >', ']]>')
"""


# Versions of the export: page, id, number, status, text.
SQL_EXPORT = """
  SELECT conv_id, turn, role, text, turn = last AS is_last,
         CASE WHEN turn = last THEN 'c' || conv_id ELSE 'c' || conv_id || 'v' || turn END AS id,
         'c' || conv_id AS page_id,
         CASE WHEN conv_id > 2 THEN 'c' || (conv_id // 3) END AS parent_id,
         CASE WHEN conv_id % 17 = 16 THEN 'draft' WHEN conv_id % 19 = 18 THEN 'deleted'
              ELSE 'current' END AS status, conv_id % 5 AS position
  FROM conversations JOIN (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id)
       USING (conv_id)
"""
SQL_EXPORT_FILES = """
  SELECT 'a' || doc_id AS id, doc_id,
         CASE WHEN lang = 'es' THEN 't ' || doc_id || '.png' ELSE 'f ' || doc_id || '.' || lang END
           AS filename,
         'c' || (doc_id // 10) AS content_id, CASE WHEN lang = 'fr' THEN 3 ELSE 1 END AS version,
         CASE WHEN lang = 'de' THEN 'deleted' ELSE 'current' END AS content_status, lang
  FROM documents
"""


def tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Regions, nations, customers and orders as one page tree of four levels.

    Orders of customers that are not listed do not exist; parents of some nations are unknown.
    """
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")

    def node(df: DataFrame, kind: str, key: str, parent: Column, level: int) -> DataFrame:
        return df.select(
            text(kind, string(key)).alias("id"),
            parent.cast("string").alias("parent_id"),
            (F.col(key) % 7).cast("int").alias("position"),
            (F.col(key).cast("long") * 4 + level).alias("ord"),
            text(kind, " ", string(key), ".1 node").alias("title"),
        )

    known = F.when(F.col("n_nationkey") == 5, F.lit("R99")).otherwise(
        text("R", string("n_regionkey"))
    )
    return (
        node(region, "R", "r_regionkey", F.lit(None), 0)
        .unionByName(node(nation, "N", "n_nationkey", known, 1))
        .unionByName(node(customer, "C", "c_custkey", text("N", string("c_nationkey")), 2))
        .unionByName(node(orders, "O", "o_orderkey", text("C", string("o_custkey")), 3))
    )


SQL_NODES = """
  SELECT 'R' || r_regionkey AS id, NULL::VARCHAR AS parent_id, (r_regionkey % 7)::INT AS position,
         r_regionkey::BIGINT * 4 AS ord, 'R ' || r_regionkey || '.1 node' AS title FROM region
  UNION ALL
  SELECT 'N' || n_nationkey, CASE WHEN n_nationkey = 5 THEN 'R99' ELSE 'R' || n_regionkey END,
         (n_nationkey % 7)::INT, n_nationkey::BIGINT * 4 + 1, 'N ' || n_nationkey || '.1 node'
  FROM nation
  UNION ALL
  SELECT 'C' || c_custkey, 'N' || c_nationkey, (c_custkey % 7)::INT, c_custkey * 4 + 2,
         'C ' || c_custkey || '.1 node' FROM customer
  UNION ALL
  SELECT 'O' || o_orderkey, 'C' || o_custkey, (o_orderkey % 7)::INT, o_orderkey * 4 + 3,
         'O ' || o_orderkey || '.1 node' FROM orders
"""
