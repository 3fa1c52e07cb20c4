"""Query for language identification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.language import fit, identify
from wikiloom.llm.registry import query, table


def fold(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(3))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold(F.col("doc_id")) != 1))
    return identify(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score", "rejected"
    )
