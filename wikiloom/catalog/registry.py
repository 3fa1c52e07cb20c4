"""Registry of queries and the small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.scale import durable, scratch_path, spread_scan, with_index

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table of long texts, for work that is bound by CPU rather than by reading."""
    return spread_scan(table(spark, sf_dir, name), [key])


def land(df: DataFrame, name: str, form: str = "json") -> str:
    """Write a table into the shared folder, as the servers' responses would lie there."""
    path = scratch_path(df.sparkSession, name)
    df.write.format(form).save(path)
    return path


def placed(df: DataFrame) -> DataFrame:
    """Add ``place``, the number of each row (from 1) in the order in which the table comes."""
    rows = durable(df.withColumn("_mid", F.monotonically_increasing_id()))
    numbered = with_index(rows, ["_mid"], "_at")
    return numbered.withColumn("place", F.col("_at") + 1).drop("_mid", "_at")


def string(column: str) -> Column:
    return F.col(column).cast("string")


def words(text: Column) -> Column:
    """All letters of a text, other characters as single spaces."""
    letters = F.trim(F.regexp_replace(text, r"[^\p{L}]+", " "))
    return F.rtrim(F.concat(F.lit("Doc "), letters))


SQL_WORDS = r"rtrim('Doc ' || trim(regexp_replace(text, '[^\p{L}]+', ' ', 'g')))"

_WHITE = r"[\s\x1c-\x1f\x85\p{Z}]"


def escaped(text: Column) -> Column:
    """A text as it stands in HTML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):  # fixed values
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def whole(text: Column) -> Column:
    """The whole text on one line, with all its signs and digits, as it stands in HTML."""
    line = F.regexp_replace(F.coalesce(text, F.lit("")), f"{_WHITE}+", " ")
    return escaped(F.rtrim(F.concat(F.lit("Doc "), F.ltrim(line))))


SQL_WHOLE = f"rtrim('Doc ' || ltrim(regexp_replace(coalesce(text, ''), '{_WHITE}+', ' ', 'g')))"


def lined(text: Column) -> Column:
    """The whole text with its line breaks, as it stands in HTML."""
    return escaped(F.rtrim(F.concat(F.lit("Doc "), F.coalesce(text, F.lit("")))))


# What is left of its space and issue numbers after the final clean-up
SQL_LINED = (
    r"regexp_replace(regexp_replace(regexp_replace(rtrim('Doc ' || coalesce(text, '')), "
    r"'(?m)^([^\S\n]*)#(\pN)', '\1\\#\2', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+\n', chr(10), 'g')"
)
