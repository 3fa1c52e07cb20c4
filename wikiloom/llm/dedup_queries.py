"""Queries over copies and near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wikiloom.llm.cqf import exact_groups
from wikiloom.llm.jaccard_join import jaccard_components
from wikiloom.llm.registry import query, table
from wikiloom.llm.simhash_covering import simhash_components

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""


@query("op2_exact_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


@query("op13_simhash_covering")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), words=4, radius=4)
