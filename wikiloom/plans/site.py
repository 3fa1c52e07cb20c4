"""From the tables of a running wiki to the rows to write: the whole migration as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.keys import file_name
from wikiloom.markup.convert import (
    convert_pages,
    current_comment,
    holds_targets,
    old_comment,
    page_text,
    version_text,
    with_link_targets,
)
from wikiloom.operators import mapping, pages as page_ops, tree, versions as version_ops
from wikiloom.operators.links import page_images, page_map
from wikiloom.scale import landed, lookup, scratch_path


@dataclass
class SiteTables:
    """Input tables; see ``wikiloom.schemas`` for the shapes.

    ``pages`` has ``id, title, space_key, ancestors, ord``; ``versions`` has ``page_id, number``;
    ``version_bodies`` and ``current_bodies`` have ``page_id, (number,) body, author, when``.
    """

    spaces: DataFrame
    projects: DataFrame
    entries: DataFrame | None
    pages: DataFrame
    versions: DataFrame
    version_bodies: DataFrame
    current_bodies: DataFrame
    attachments: DataFrame


def moved_pages(tables: SiteTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages of spaces with a project, with parents and push order; link targets; the space map."""
    # The map and the homes have a row per space; what follows would plan and make them again each time.
    mapped = landed(mapping.space_map(tables.spaces, tables.projects, tables.entries), "space-map")
    homes = landed(mapping.with_project(mapped).join(tables.spaces.select("key", "ord"), "key"), "homes")
    # Titles are made once; what follows reads them many times.
    targets = landed(page_map(tables.pages, homes), "targets")
    rooted = tree.with_parent_from_ancestors(tables.pages).drop("ancestors", "space_key")
    titled = landed(rooted.join(targets, "id"), "titled")
    # A space is finished before the next one of its project begins.
    seen = lookup(
        tables.pages.select("id", "space_key"),
        homes.select(F.col("key").alias("space_key"), F.col("ord").alias("space_ord")),
        ["space_key"], ["id"], "inner",
    ).groupBy("id").agg(F.min("space_ord").alias("space_ord"))
    paths = tree.tree_paths(titled, ["ord"]).join(titled.select("id", "project"), "id").join(seen, "id")
    ordered = tree.push_order(paths, ["project", "space_ord"]).select(
        "id", "depth", F.col("ord").alias("push_ord")
    )
    moved = tree.with_parent_title(titled).join(ordered, "id")
    return landed(moved, "moved"), targets, mapped


def revisions(tables: SiteTables, fmt: str = "markdown", newest: int = 0) -> DataFrame:
    """One row per page revision in push order: old versions from oldest to newest, then the page.

    All bodies, old and current, go through one conversion. They are written once beside their
    keys, since finding link targets reads them several times; those with such links are written again
    beside the first ones with what was found, so that one scan reads all of them and the conversion is planned once.
    """
    moved, targets, mapped = moved_pages(tables)
    placed = version_ops.history(tables.versions.select("page_id", "number"))
    about = moved.select(
        F.col("id").alias("page_id"), "title", "wiki_title", "project", "parent_title", "push_ord"
    )
    children = tree.child_macro(moved.select("id", "parent_id")).withColumnRenamed("id", "page_id")
    about = about.join(children, "page_id", "left")
    # What is known of the page goes to the narrow rows of old versions, so their bodies are moved once.
    kept = version_ops.capped(placed, newest).select("page_id", "number", "position", "total")
    old = lookup(kept, about, ["page_id"], ["number"], "inner").join(
        tables.version_bodies, ["page_id", "number"]
    ).withColumns({"number": F.col("number").cast("int"), "is_current": F.lit(False)})
    now = lookup(tables.current_bodies, about, ["page_id"], ["when"], "inner").withColumns({
        "number": F.lit(None).cast("int"),
        "position": F.lit(None).cast("long"),
        "total": F.lit(None).cast("long"),
        "is_current": F.lit(True),
    })
    columns = [
        "page_id", "number", "position", "total", "body", "author", "when", "is_current",
        *[c for c in about.columns if c != "page_id"],
    ]
    # Revision number -1 stands for the current body in the key.
    keyed = old.select(*columns).unionByName(now.select(*columns)).withColumn(
        "_revision", F.coalesce("number", F.lit(-1))
    )
    keyed = keyed.withColumn("_links", F.when(holds_targets(F.col("body")), "raw").otherwise("none"))
    spark, path = keyed.sparkSession, scratch_path(keyed.sparkSession, "revisions")
    keyed.write.partitionBy("_links").parquet(path)
    raw = spark.read.schema(keyed.schema).parquet(path).where("_links = 'raw'")
    linked = with_link_targets(raw.drop("_links"), ["page_id", "_revision"], targets, mapped)
    linked = linked.withColumn("_links", F.lit("found"))
    linked.write.mode("append").partitionBy("_links").parquet(path)
    linked = spark.read.schema(linked.schema).parquet(path).where("_links <> 'raw'").drop("_links")
    rows = convert_pages(linked, fmt)
    current = F.col("is_current")
    return rows.select(
        "project",
        "page_id",
        "wiki_title",
        "push_ord",
        "position",
        "number",
        F.when(
            current, page_text(F.col("title"), F.col("text"), F.col("child_text"))
        )
        .otherwise(version_text(F.col("title"), F.col("text"), F.col("number"), F.col("total")))
        .alias("text"),
        F.when(current, F.col("parent_title")).alias("parent_title"),
        F.when(current, current_comment(F.col("author"), F.col("when")))
        .otherwise(old_comment(F.col("number"), F.col("total"), F.col("author"), F.col("when")))
        .alias("comments"),
        current.alias("is_current"),
    )


def page_uploads(tables: SiteTables) -> DataFrame:
    """Files that go with the current pages: attachments, then images that are not among them."""
    held = tables.attachments.where("coalesce(download, '') <> ''").select(
        "page_id",
        file_name(F.col("title")).alias("filename"),
        F.col("media_type").alias("content_type"),
        "ord",
    )
    images = page_images(tables.current_bodies.select("page_id", "body"))
    return page_ops.uploads(held, page_ops.missing_images(images, held))
