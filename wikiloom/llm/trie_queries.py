"""The query over shared prefixes of rebuilt conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.prefix_trie import prefix_trie
from wikiloom.llm.registry import query, table

HEADS, FAMILY = 6, 100

# The checksum of a number's digits, bit by bit: an item of 0 or more is a byte, -1 a shift.
_CRC = """
xor(list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END
), 4294967295::BIGINT)
"""

OP12_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % {FAMILY} AS base, max(p) AS turns, {_CRC} % {HEADS} AS h FROM t GROUP BY c
), rebuilt AS (
  SELECT convs.c, t.p AS d, role, text FROM convs JOIN t ON t.c = base AND t.p <= h
  UNION ALL
  SELECT convs.c, least(convs.h, coalesce(b.turns, 0)) + t.p - convs.h, role, text
  FROM convs JOIN t ON t.c = convs.c AND t.p > convs.h LEFT JOIN convs b ON b.c = convs.base
), m AS (
  SELECT c, d, list({{'r': role, 't': text}}) OVER (PARTITION BY c ORDER BY d) AS path, length(text) AS chars
  FROM rebuilt
  UNION ALL SELECT c, 0, [], 0 FROM convs
), n AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY path, d
), kids AS (
  SELECT path[:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path, d)
), below AS (
  SELECT m.path, m.d, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves,
         sum((u.n_convs - 1) * u.chars) AS saved_tokens
  FROM nodes u JOIN m ON m.c = u.conv_id AND m.d <= u.d GROUP BY ALL
), ends AS (
  SELECT path, d, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM m SEMI JOIN (SELECT c, max(d) AS d FROM m GROUP BY c) USING (c, d) GROUP BY ALL
)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, nodes.n_children,
       n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes JOIN below USING (path, d) LEFT JOIN ends USING (path, d)
LEFT JOIN n up ON nodes.d > 0 AND up.d = nodes.d - 1 AND up.path = nodes.path[:nodes.d - 1]
"""


def rebuilding_plan(conversations: DataFrame) -> DataFrame:
    """Each conversation begins with up to five turns of the first of its hundred, by a checksum of its id."""
    own = F.col("conv_id").cast("long")
    return conversations.select(own.alias("conv_id")).where("conv_id IS NOT NULL").distinct().select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base_id"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("head"),
    )


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return prefix_trie(conversations, rebuilding_plan(conversations), HEADS - 1).drop("ref_conv", "ref_place")
