"""Query for the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wikiloom.llm.outliers import quality
from wikiloom.llm.registry import query, table


@query("op5_quality_mcd")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
