"""A corpus pipeline of five stages; each reads what its predecessor kept.

Stages decide per row: ids may be null or repeated, so decisions and spans are joined by a row key:
a row's place in its files, or a key that the stage writes. Packed pieces carry the id as it is.
"""

from __future__ import annotations

import sys
from os.path import abspath, dirname

sys.path.insert(0, dirname(abspath(__file__)))

from pyspark.errors import AnalysisException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wikiloom.llm.cqf import exact_groups  # noqa: E402
from wikiloom.llm.jaccard_join import jaccard_components  # noqa: E402
from wikiloom.llm.outliers import quality  # noqa: E402
from wikiloom.llm.pii import personal_data, redacted  # noqa: E402
from wikiloom.llm.token_queries import packed  # noqa: E402
from wikiloom.scale import landed, rows_among  # noqa: E402

# Robust estimates, hashed shingles and token ids are not SQL; tests compare with brute force.
ORACLE_SQL = None


ROW = "_stage_row"


_FILE_BITS = 33  # rows of a file, as in monotonically_increasing_id


def _scanned(docs: DataFrame) -> bool:
    """Whether the rows are those of files as they stand, so that each has a place in its file."""
    if "_metadata" in docs.columns or not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return False
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own, as ids may be null or repeated.

    Rows of files have the number of their file and their place in it, so their texts are not written again; the table of
    file names is no longer than the list that the driver reads them by. Other rows are written with a key.
    """
    if not _scanned(docs):
        return landed(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    named = docs.withColumns({"_file": F.col("_metadata.file_path"), "_place": F.col("_metadata.row_index")})
    files = sorted(row["_file"] for row in named.select("_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)))), "_file string, _number long")
    key = F.shiftleft("_number", _FILE_BITS) + F.col("_place")
    return named.join(F.broadcast(numbers), "_file").select(*docs.columns, key.alias(ROW))


def _kept(keyed: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows whose row keys are in the table of kept keys, which is written first, as bitmaps."""
    return rows_among(keyed, keep, ROW, "pipeline-keep").drop(ROW)


def _first_of(keyed: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """The row key of each group's smallest id; null is the smallest, and of equal ids the first row is taken."""
    rows = groups.select(ROW, group).join(keyed.select(ROW, "doc_id"), ROW)
    first = rows.groupBy(group).agg(F.min(F.struct("doc_id", ROW)).alias("first"))
    return first.select(F.col(f"first.{ROW}").alias(ROW))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the limits or the outlier test reject go, whatever their ids."""
    keyed = _keyed(docs)
    return _kept(keyed, quality(keyed, key=ROW).where("kept"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that with the smallest id (null first)."""
    keyed = _keyed(docs)
    return _kept(keyed, _first_of(keyed, exact_groups(keyed, key=ROW), "keep_id"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts (five-word shingles, similarity 0.8) one row stays, that with the smallest id (null first)."""
    keyed = _keyed(docs)
    return _kept(keyed, _first_of(keyed, jaccard_components(keyed, words=5, percent=80, key=ROW, row=ROW), "component_id"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets; n_chars is counted anew."""
    keyed = _keyed(docs)
    spans = personal_data(keyed, key=ROW).where(F.size("spans") > 0)
    both = keyed.join(landed(spans.select(ROW, "spans"), "pipeline-spans"), ROW, "left")
    clean = redacted(F.col("text"), F.col("spans"))
    text = F.when(F.col("spans").isNotNull(), clean).otherwise(F.col("text"))
    both = both.withColumn("text", text)
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        both = both.withColumn("n_chars", F.when(F.col("spans").isNotNull(), chars).otherwise(F.col("n_chars")))
    return both.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with each piece's place and checksum."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("PII", redact),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
