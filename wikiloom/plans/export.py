"""From an XML export to the rows to write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.keys import file_name, wiki_title_plain
from wikiloom.markup.convert import (
    EXPORT_FINAL_COMMENT,
    convert_pages,
    export_page_comment,
    export_version_comment,
    page_text,
)
from wikiloom.operators import pages as page_ops, tree, versions as version_ops
from wikiloom.scale import landed, lookup
from wikiloom.sources import export

SIBLINGS = ["position", "_under", "seen"]


def export_tree(pages: DataFrame) -> DataFrame:
    """Current pages with wiki title, known parent and push order."""
    current = page_ops.current_pages(pages).select(
        "id", "title", "parent_id", "position", "modified", "modifier", "version",
        F.col("ord").alias("seen"),  # place in the export, over all its files
        wiki_title_plain(F.col("title")).alias("wiki_title"),
        F.coalesce("parent_id", F.lit("")).alias("_under"),
    )
    current = landed(current, "current")
    paths = tree.tree_paths(current, SIBLINGS)
    ordered = tree.push_order(paths).select("id", "depth", "ord", F.col("parent_id").alias("_known"))
    rows = current.join(ordered, "id").withColumn("parent_id", F.col("_known")).drop("_known")
    return tree.with_parent_title(rows)


@dataclass
class ExportTables:
    """The three tables of an export, written once as columns: XML is slow to read again."""

    pages: DataFrame
    bodies: DataFrame
    attachments: DataFrame


def load_export(objects: DataFrame) -> ExportTables:
    objects = landed(objects, "objects")
    return ExportTables(
        landed(export.export_pages(objects), "pages"),
        landed(export.export_bodies(objects), "bodies"),
        landed(export.export_attachments(objects), "attachments"),
    )


def export_revisions(tables: ExportTables, with_history: bool = True) -> DataFrame:
    """One row per revision of each page, oldest first. Every body is converted once."""
    pages, bodies = tables.pages, tables.bodies
    attachments = page_ops.kept_attachments(tables.attachments)
    ordered = landed(export_tree(pages), "tree")
    chosen = page_ops.chosen_bodies(pages, bodies).withColumnRenamed("page_id", "id")
    versions = landed(page_ops.versions_of_pages(pages), "versions")
    if not with_history:
        versions = versions.where("current")
    placed = version_ops.merged_history(
        versions.where("NOT current").select("page_id", "id", F.col("version").alias("number")),
        versions.where("current").select("page_id", "id", F.col("version").alias("number")),
    )
    facts = pages.select("id", F.col("title").alias("version_title"), "modified", "modifier")
    rows = placed.join(facts, "id").join(chosen, "id")
    about = ordered.select(
        F.col("id").alias("page_id"), "wiki_title", "parent_title", "ord"
    )
    links = tree.child_links(ordered, SIBLINGS).withColumnRenamed("id", "page_id")
    filed = attachments.select(F.col("content_id").alias("page_id")).distinct()
    about = about.join(links, "page_id", "left").join(
        filed.withColumn("_filed", F.lit(True)), "page_id", "left"
    )
    keyed = landed(lookup(rows, about, ["page_id"], ["id"], "inner"), "revisions")
    with_links = convert_pages(keyed, form="export")
    text = page_text(F.col("version_title"), F.col("text"), F.col("child_text"), "export")
    single = F.col("total") == 1
    comment = F.when(single, export_page_comment(F.col("modifier"), F.col("modified"))).otherwise(
        export_version_comment(F.col("number"), F.col("modifier"), F.col("modified"))
    )
    # A page with history and files is written once more, with the files.
    once = F.struct(F.col("position").alias("position"), comment.alias("comments"))
    again = F.struct(
        (F.col("position") + 1).alias("position"), F.lit(EXPORT_FINAL_COMMENT).alias("comments")
    )
    twice = F.col("is_current") & ~single & F.col("_filed").isNotNull()
    converted = with_links.select(
        "page_id", "wiki_title", "ord", text.alias("text"),
        F.when(F.col("is_current"), F.col("parent_title")).alias("parent_title"), "is_current",
        F.when(twice, F.array(once, again)).otherwise(F.array(once)).alias("_written"),
    )
    return converted.select("*", F.inline("_written")).drop("_written")


def export_uploads(tables: ExportTables, files: DataFrame) -> DataFrame:
    """Files of the current pages with the path in the export; a null path is a missing file."""
    pages = page_ops.current_pages(tables.pages)
    attachments = page_ops.attachments_of_pages(
        page_ops.kept_attachments(tables.attachments), pages
    )
    return export.bind_files(attachments, files).select(
        F.col("content_id").alias("page_id"),
        "id",
        file_name(F.col("filename")).alias("filename"),
        F.coalesce(F.nullif("content_type", F.lit("")), F.lit("application/octet-stream")).alias(
            "content_type"
        ),
        "path",
    )
