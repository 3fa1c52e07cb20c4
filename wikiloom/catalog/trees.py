"""The page tree of regions, nations, customers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import standins
from wikiloom.catalog.registry import placed, query, string, table
from wikiloom.functions.keys import wiki_title
from wikiloom.operators import tree
from wikiloom.scale import lookup, with_group_position

N = standins.SQL_NODES
# Wiki titles of the nodes, written down from their making: kind, padded number, 001, node.
_TITLED = f"""
  SELECT id, parent_id, position, ord, title,
         left(id, 1) || '_' || lpad(substr(id, 2), greatest(length(id) - 1, 3)::INT, '0') || '_001_node'
           AS wiki_title FROM ({N})"""
_ORDERED = f"""
  WITH RECURSIVE n AS ({_TITLED}),
  k AS (SELECT n.*, p.id AS known FROM n LEFT JOIN n p ON n.parent_id = p.id),
  t AS (SELECT id, known AS parent_id, 0 AS depth, [[position::BIGINT, ord]] AS path
        FROM k WHERE known IS NULL
        UNION ALL
        SELECT k.id, k.known, t.depth + 1, list_append(t.path, [k.position::BIGINT, k.ord])
        FROM t JOIN k ON k.known = t.id)
  SELECT id, parent_id, depth, row_number() OVER (ORDER BY depth, path) - 1 AS ord FROM t"""


def titled(spark: SparkSession, sf: str) -> DataFrame:
    nodes = standins.tree_nodes(spark, sf)
    return nodes.withColumn("wiki_title", wiki_title(F.col("title")))


def ordered(spark: SparkSession, sf: str) -> DataFrame:
    paths = tree.tree_paths(standins.tree_nodes(spark, sf), ["position", "ord"])
    return tree.push_order(paths).drop("path")


@query("w6_push_order", _ORDERED)
def w6(spark: SparkSession, sf: str) -> DataFrame:
    return ordered(spark, sf)


@query(
    "w6_unreached_pages",
    f"""WITH RECURSIVE n AS (SELECT id, CASE id WHEN 'N1' THEN 'N6' WHEN 'N6' THEN 'N1' ELSE parent_id END
                               AS parent_id, position, ord, title FROM ({N})),
        t AS (SELECT id FROM n WHERE parent_id IS NULL OR parent_id NOT IN (SELECT id FROM n)
              UNION ALL SELECT n.id FROM t JOIN n ON n.parent_id = t.id)
        SELECT * FROM n WHERE id NOT IN (SELECT id FROM t)""",
)
def w6_unreached(spark: SparkSession, sf: str) -> DataFrame:
    """Nations of one region point at each other, so what hangs below them has no root."""
    nodes = standins.tree_nodes(spark, sf)
    circle = F.when(F.col("id").isin("N1", "N6"), F.when(F.col("id") == "N1", "N6").otherwise("N1"))
    turned = nodes.withColumn("parent_id", F.coalesce(circle, "parent_id"))
    return tree.unreached_pages(turned, tree.tree_paths(turned, ["position", "ord"]))


@query(
    "w7_sorted_pages",
    f"""SELECT id, parent_id, position, ord, title,
               row_number() OVER (ORDER BY coalesce(parent_id, ''), position, id) AS place FROM ({N})""",
)
def w7(spark: SparkSession, sf: str) -> DataFrame:
    return placed(tree.sorted_pages(standins.tree_nodes(spark, sf)))


@query(
    "a10_root_counts",
    f"""SELECT count(*) AS pages, count(*) FILTER (parent_id IS NULL) AS roots,
               count(*) FILTER (parent_id IS NOT NULL) AS nested FROM ({_ORDERED})""",
)
def a10(spark: SparkSession, sf: str) -> DataFrame:
    return tree.root_counts(standins.tree_nodes(spark, sf))


@query(
    "j5_parent_titles",
    f"""WITH n AS ({_TITLED}) SELECT n.id, p.wiki_title AS parent_title
        FROM n LEFT JOIN n p ON n.parent_id = p.id""",
)
def j5(spark: SparkSession, sf: str) -> DataFrame:
    return tree.with_parent_title(titled(spark, sf)).select("id", "parent_title")


@query(
    "j5_parent_from_ancestors",
    """SELECT 'O' || o_orderkey AS id, 'C' || o_custkey AS parent_id FROM orders
       UNION ALL SELECT 'R' || r_regionkey, NULL FROM region""",
)
def j5_ancestors(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")

    def page(identifier: str, title: str) -> F.Column:
        return F.struct(F.lit(identifier).alias("id"), F.lit(title).alias("title"))

    below = F.struct(
        F.concat(F.lit("C"), string("o_custkey")).alias("id"), F.lit("customer").alias("title")
    )
    leaves = orders.select(
        F.concat(F.lit("O"), string("o_orderkey")).alias("id"),
        F.array(page("R0", "top"), below).alias("ancestors"),
    )
    roots = table(spark, sf, "region").select(
        F.concat(F.lit("R"), string("r_regionkey")).alias("id"),
        F.slice(F.array(page("R0", "top")), 1, 0).alias("ancestors"),
    )
    both = leaves.unionByName(roots)
    return tree.with_parent_from_ancestors(both).select("id", "parent_id")


@query(
    "j12_child_macro",
    f"""SELECT DISTINCT parent_id AS id, chr(10) || chr(10) || '---' || chr(10) || chr(10) ||
               '{{{{child_pages}}}}' || chr(10) AS child_text FROM ({N}) WHERE parent_id IS NOT NULL""",
)
def j12_macro(spark: SparkSession, sf: str) -> DataFrame:
    return tree.child_macro(standins.tree_nodes(spark, sf))


@query(
    "j12_child_links",
    f"""SELECT parent_id AS id, chr(10) || chr(10) || '---' || chr(10) || chr(10)
               || '## Child pages' || chr(10) || chr(10)
               || string_agg('- [[' || wiki_title || '|' || title || ']]' || chr(10), '' ORDER BY position, ord)
               AS child_text
        FROM ({_TITLED}) WHERE parent_id IS NOT NULL GROUP BY parent_id""",
)
def j12_links(spark: SparkSession, sf: str) -> DataFrame:
    """Joined in parts of 20 links each, so that large parents are made of several parts."""
    return tree.child_links(titled(spark, sf), ["position", "ord"], part_rows=20)


@query(
    "p16_listing",
    f"""WITH o AS ({_ORDERED}), n AS ({_TITLED})
        SELECT o.ord, repeat('  ', depth) || n.wiki_title || ' [parent: ' ||
               coalesce(p.title, '(root)') || ', body: ' || length(n.title) || 'b]' AS line
        FROM o JOIN n USING (id) LEFT JOIN n p ON p.id = o.parent_id WHERE o.ord < 30
        UNION ALL SELECT 30, '... and ' || (count(*) - 30) || ' more' FROM o""",
)
def p16(spark: SparkSession, sf: str) -> DataFrame:
    pages = titled(spark, sf).select("id", "wiki_title", F.length("title").alias("body_length"))
    parents = standins.tree_nodes(spark, sf).select(
        F.col("id").alias("parent_id"), F.col("title").alias("parent_title")
    )
    rows = lookup(ordered(spark, sf).join(pages, "id"), parents, ["parent_id"], ["id"])
    return tree.listing(rows)


@query(
    "p16_listing_spaces",
    """WITH o AS (SELECT c_nationkey::VARCHAR AS space, c_name AS title, c_mktsegment AS above,
                    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS ord FROM customer)
       SELECT space, ord, title || ' [parent: ' || above || ', body: ' || length(title) || 'b]' AS line
       FROM o WHERE ord < 30
       UNION ALL SELECT space, 30, '... and ' || (count(*) - 30) || ' more' FROM o
       GROUP BY space HAVING count(*) > 30""",
)
def p16_spaces(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as the pages of their nation's space."""
    pages = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("space"), "c_custkey", F.col("c_name").alias("wiki_title"),
        F.col("c_mktsegment").alias("parent_title"), F.length("c_name").alias("body_length"),
        F.lit(0).alias("depth"),
    )
    placed = with_group_position(pages, ["space"], ["c_custkey"], "_at")
    return tree.listing(placed.withColumn("ord", F.col("_at") - 1))


@query(
    "w9_cooldown_points",
    """WITH o AS (SELECT c_nationkey::VARCHAR AS space, c_custkey AS id, (SELECT count(*) FROM orders
                    WHERE o_custkey = c_custkey) AS versions,
                    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS number,
                    count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
       SELECT space, id, number - 1 AS ord, versions > 12 AS heavy,
              number % 50 = 0 AND number < n AS periodic FROM o
       WHERE versions > 12 OR (number % 50 = 0 AND number < n)""",
)
def w9(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        string("c_nationkey").alias("space"), F.col("c_custkey").alias("id")
    )
    placed = with_group_position(customers, ["space"], ["id"]).select(
        "space", "id", (F.col("position") - 1).alias("ord")
    )
    histories = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).alias("versions")
    )
    rows = placed.join(histories, "id", "left").fillna(0, ["versions"])
    return tree.cooldown_points(rows, heavy=12)
