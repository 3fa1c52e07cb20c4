"""Spaces, projects and the mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import standins
from wikiloom.catalog.registry import placed, query, string, table
from wikiloom.operators import mapping


def _excluded(spark: SparkSession, sf: str) -> DataFrame:
    poor = table(spark, sf, "customer").where("c_acctbal < 0")
    return poor.select(F.concat(F.lit(" "), F.lower("c_name")).alias("key"))


@query(
    "p5_excluded_spaces",
    """SELECT c_name AS key, c_mktsegment || ' ' || c_custkey AS name, c_mktsegment AS type,
              c_custkey AS ord FROM customer WHERE c_acctbal >= 0""",
)
def p5(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.without_spaces(standins.spaces(spark, sf), _excluded(spark, sf))


@query(
    "w8_spaces_by_key",
    """SELECT c_name AS key, c_mktsegment || ' ' || c_custkey AS name, c_mktsegment AS type,
              row_number() OVER (ORDER BY c_name) AS place
       FROM customer""",
)
def w8(spark: SparkSession, sf: str) -> DataFrame:
    return placed(mapping.list_spaces(standins.spaces(spark, sf)))


@query(
    "p9_mapping_entries",
    f"""SELECT row_no, parent, subproject, array_to_string(jira_keys, ' ') AS jira_keys,
               array_to_string(wiki_keys, ' ') AS wiki_keys, identifier
        FROM ({standins.SQL_ENTRIES})""",
)
def p9(spark: SparkSession, sf: str) -> DataFrame:
    return standins.entries(spark, sf).select(
        "row_no", "parent", "subproject", F.array_join("jira_keys", " ").alias("jira_keys"),
        F.array_join("wiki_keys", " ").alias("wiki_keys"), "identifier",
    )


def _sql_keys(column: str, value: str) -> str:
    return f"""
      SELECT key, arg_max({value}, row_no) AS value FROM (
        SELECT unnest([k, upper(k)]) AS key, {value}, row_no
        FROM (SELECT unnest({column}) AS k, * FROM ({standins.SQL_ENTRIES}))) GROUP BY key"""


@query("a12_wiki_keys", f"SELECT key, value AS identifier FROM ({_sql_keys('wiki_keys', 'identifier')})")
def a12_wiki(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.wiki_key_table(standins.entries(spark, sf))


@query(
    "a12_jira_keys",
    f"""SELECT key, array_to_string(value, ' ') AS wiki_keys
        FROM ({_sql_keys('jira_keys', 'wiki_keys')})""",
)
def a12_jira(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.jira_key_table(standins.entries(spark, sf)).withColumn(
        "wiki_keys", F.array_join("wiki_keys", " ")
    )


_SQL_SPACE_MAP = f"""
  SELECT s.c_name AS key, c_mktsegment || ' ' || c_custkey AS name, c_custkey AS ord,
         CASE WHEN coalesce(e.value, u.value) IS NOT NULL THEN coalesce(e.value, u.value)
              WHEN l.identifier IS NOT NULL THEN l.identifier ELSE replace(lower(c_name), '#', '')
              END AS identifier,
         CASE WHEN coalesce(e.value, u.value) IS NOT NULL THEN m.identifier IS NOT NULL
              ELSE l.identifier IS NOT NULL OR c.identifier IS NOT NULL END AS exists,
         CASE WHEN coalesce(e.value, u.value) IS NOT NULL THEN 'excel'
              WHEN l.identifier IS NOT NULL THEN 'exact_match'
              WHEN c.identifier IS NOT NULL THEN 'sanitized_match' ELSE 'new' END AS source
  FROM customer s
  LEFT JOIN ({_sql_keys('wiki_keys', 'identifier')}) e ON e.key = s.c_name
  LEFT JOIN ({_sql_keys('wiki_keys', 'identifier')}) u ON u.key = upper(s.c_name)
  LEFT JOIN (SELECT identifier FROM ({standins.SQL_PROJECTS})) m
         ON m.identifier = coalesce(e.value, u.value)
  LEFT JOIN (SELECT identifier FROM ({standins.SQL_PROJECTS})) l ON l.identifier = lower(s.c_name)
  LEFT JOIN (SELECT identifier FROM ({standins.SQL_PROJECTS})) c
         ON c.identifier = replace(lower(s.c_name), '#', '')
"""


def space_map(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.space_map(
        standins.spaces(spark, sf), standins.projects(spark, sf), standins.entries(spark, sf)
    )


@query("j1_space_map", f"SELECT key, identifier, name, exists, source FROM ({_SQL_SPACE_MAP})")
def j1(spark: SparkSession, sf: str) -> DataFrame:
    return space_map(spark, sf)


@query("p8_spaces_with_project",
       f"SELECT key, identifier, name, exists, source FROM ({_SQL_SPACE_MAP}) WHERE exists")
def p8(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.with_project(space_map(spark, sf))


@query(
    "a1_project_counts",
    f"""SELECT count(*) FILTER (exists) AS existing_projects,
               count(*) FILTER (NOT exists) AS new_projects FROM ({_SQL_SPACE_MAP})""",
)
def a1(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.map_counts(space_map(spark, sf))


@query(
    "a2_mapping_summary",
    f"""SELECT count(*) AS entries, count(*) FILTER (len(wiki_keys) > 0) AS with_space,
               count(*) FILTER (len(wiki_keys) = 0) AS without_space,
               sum(len(wiki_keys))::BIGINT AS space_keys,
               (SELECT count(*) FROM ({_sql_keys('wiki_keys', 'identifier')})) AS wiki_mappings,
               (SELECT count(*) FROM ({_sql_keys('jira_keys', 'wiki_keys')})) AS jira_mappings
        FROM ({standins.SQL_ENTRIES})""",
)
def a2(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.mapping_summary(standins.entries(spark, sf))


def _requested(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of customers in lower case, and jira keys of all suppliers."""
    customers = table(spark, sf, "customer").where("c_acctbal > 9000").select(
        F.lower("c_name").alias("key")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.concat(F.lit("jk"), string("s_suppkey")).alias("key")
    )
    return customers.unionByName(suppliers)


def _resolution(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.resolve_keys(
        _requested(spark, sf), standins.entries(spark, sf), standins.spaces(spark, sf)
    )


_SQL_RESOLUTION = f"""
  SELECT lower(c_name) AS key, 'space' AS via, NULL::VARCHAR AS wiki_key, c_name AS space
  FROM customer WHERE c_acctbal > 9000
  UNION ALL
  SELECT r.key, CASE WHEN r.wiki_key IS NULL THEN 'none' ELSE 'jira' END, r.wiki_key, c_name
  FROM (SELECT 'jk' || s_suppkey AS key, w.wiki_key
        FROM supplier LEFT JOIN (
          SELECT key, unnest(value) AS wiki_key FROM ({_sql_keys('jira_keys', 'wiki_keys')})) w
        ON w.key = upper('jk' || s_suppkey)) r
  LEFT JOIN customer ON upper(c_name) = upper(r.wiki_key)
"""


@query("j2_resolved_keys", _SQL_RESOLUTION)
def j2(spark: SparkSession, sf: str) -> DataFrame:
    return _resolution(spark, sf)


@query(
    "j2_unresolved_keys",
    f"SELECT key FROM ({_SQL_RESOLUTION}) GROUP BY key HAVING count(space) = 0",
)
def j2_unresolved(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.unresolved_keys(_resolution(spark, sf))


@query("u2_resolved_set", f"SELECT DISTINCT space AS key FROM ({_SQL_RESOLUTION}) WHERE space IS NOT NULL")
def u2(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.resolved_keys(_resolution(spark, sf))


@query(
    "p20_requested_spaces",
    f"""SELECT c_name AS key, c_mktsegment || ' ' || c_custkey AS name, c_mktsegment AS type,
               c_custkey AS ord
        FROM customer WHERE c_name IN (SELECT space FROM ({_SQL_RESOLUTION}))""",
)
def p20(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.requested_spaces(standins.spaces(spark, sf), _resolution(spark, sf))


def _plan_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries whose every third subproject goes by the identifier of a customer in debt."""
    number = F.col("row_no")
    known = F.concat(F.lit("customer"), F.lpad(number.cast("string"), 9, "0"))
    return standins.entries(spark, sf).withColumn(
        "identifier",
        F.when(number % 3 == 0, known).when(number % 3 == 1, F.col("identifier")).otherwise("shared"),
    )


@query(
    "j10_project_plan",
    f"""WITH p AS ({standins.SQL_PROJECTS}),
        e AS (SELECT row_no, parent, subproject, CASE row_no % 3
                WHEN 0 THEN 'customer' || lpad(row_no::VARCHAR, 9, '0') WHEN 1 THEN identifier
                ELSE 'shared' END AS identifier FROM ({standins.SQL_ENTRIES})),
        parents AS (
          SELECT parent AS name, replace(lower(parent), ' ', '-') AS identifier, min(row_no) AS row_no,
                 (SELECT max(id) FROM p WHERE p.identifier = replace(lower(parent), ' ', '-')) AS by_id,
                 (SELECT max(id) FROM p WHERE p.name = parent) AS by_name
          FROM e GROUP BY parent)
        SELECT 'parent' AS level, name, identifier, NULL::VARCHAR AS parent,
               coalesce(by_id, by_name) AS project_id, row_no,
               CASE WHEN coalesce(by_id, by_name) IS NOT NULL THEN 'exists' ELSE 'create' END AS action
        FROM parents
        UNION ALL
        SELECT 'subproject', subproject, e.identifier, parent, p.id, row_no,
               CASE WHEN p.id IS NOT NULL
                      OR row_no > (SELECT min(row_no) FROM e f WHERE f.identifier = e.identifier)
                    THEN 'exists' ELSE 'create' END
        FROM e LEFT JOIN p ON p.identifier = e.identifier""",
)
def j10(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.project_plan(_plan_entries(spark, sf), standins.projects(spark, sf))


@query(
    "j10_new_projects",
    f"""SELECT identifier, name, 'unmapped-confluence' AS parent, 'create' AS action
        FROM ({_SQL_SPACE_MAP}) WHERE NOT exists
        UNION ALL SELECT 'unmapped-confluence', 'Unmapped Confluence Spaces', NULL, 'create'""",
)
def j10_new(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.new_project_plan(space_map(spark, sf), standins.projects(spark, sf))
