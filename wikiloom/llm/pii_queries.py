"""Query for personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.pii import KINDS, count_of, personal_data, span_text
from wikiloom.llm.registry import query, table


@query("op1_pii_bootstrap")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [
        count_of(F.col("base"), rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
