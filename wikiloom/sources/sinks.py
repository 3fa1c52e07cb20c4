"""Writers: manifest, page payloads in push order, raw bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.scale import listed_in_parts


def manifest(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    """One review row per page: size of the body, number of attachments and their names."""
    item = F.struct(F.col("id").alias("id"), F.col("filename").alias("filename"))
    parts = listed_in_parts(
        attachments.select("content_id", "id", "filename").where("content_id IS NOT NULL"),
        ["content_id"], ["id"], item, "attachments",
    )
    held = parts.groupBy(F.col("content_id").alias("id")).agg(
        F.first("attachments_count").alias("attachments_count"),
        F.array_sort(F.collect_list(F.struct("part", "attachments"))).alias("_parts"),
    )
    return pages.join(held, "id", "left").select(
        "id",
        "title",
        "parent_id",
        "version",
        F.coalesce(F.length("body"), F.lit(0)).alias("body_length"),
        F.coalesce("attachments_count", F.lit(0)).alias("attachment_count"),
        F.coalesce(F.flatten(F.col("_parts.attachments")), F.array()).alias("attachments"),
    )


def write_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def write_payload(payload: DataFrame, path: str, form: str = "parquet") -> None:
    """Page revisions in push order, each page's from oldest to newest (its current row has no
    position): files are ranges of that order, split by volume.

    A project that holds most pages, or a page that holds most revisions, spans many files.
    """
    order = [F.col("project"), F.col("ord")]
    if "position" in payload.columns:
        order.append(F.col("position").asc_nulls_last())
    (
        payload.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("project")
        .format(form)
        .save(path)
    )


def write_bodies(bodies: DataFrame, path: str) -> None:
    """Raw bodies of each page and version; empty ones are left out."""
    bodies.where("body <> ''").write.mode("overwrite").parquet(path)
