"""Readers for landed responses of the wiki and of the target, one JSON response per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom import schemas
from wikiloom.functions.keys import identifier
from wikiloom.functions.text import SPACE, strip
from wikiloom.scale import first_rows, lookup, with_index


def _rows(responses: DataFrame, items: Column, offset: str, keep: list[str]) -> DataFrame:
    """One row per item, with its place in the whole listing as ``ord``."""
    return responses.select(
        *keep, F.coalesce(offset, F.lit(0)).alias("_start"), F.posexplode(items).alias("_pos", "r")
    ).select(*keep, "r.*", (F.col("_start") + F.col("_pos")).alias("ord"))


def read_spaces(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.SPACE_RESPONSES).json(path)
    return _rows(raw, F.col("results"), "start", [])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of all spaces; some servers put the listing under ``page``."""
    raw = spark.read.schema(schemas.PAGE_RESPONSES).json(path)
    items = F.when(F.size("results") > 0, F.col("results")).otherwise(F.col("page.results"))
    return _rows(raw, items, "start", ["space_key"])


def read_child_pages(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.CHILD_RESPONSES).json(path)
    return _rows(raw, F.col("results"), "start", ["space_key", "parent_id"])


def complete_pages(pages: DataFrame, children: DataFrame) -> DataFrame:
    """Add the child pages that the listing lacks, each id once, the first one seen.

    They follow the listed pages of their space, by the place of their parent, then their own.
    """
    unseen = children.join(pages.select("id"), "id", "left_anti")
    # The same child may come from several responses: (ord, parent) tells them apart.
    unseen = unseen.withColumn("_seen", F.struct("ord", "parent_id"))
    firsts = first_rows(unseen, ["id"], "_seen").drop("_seen")
    places = pages.groupBy(F.col("id").alias("parent_id")).agg(F.min("ord").alias("_parent"))
    firsts = lookup(firsts, places, ["parent_id"], ["id"])
    order = ["space_key", F.col("_parent").asc_nulls_last(), "ord", "id"]
    placed = with_index(firsts, order, "_at")
    starts = placed.groupBy("space_key").agg(F.min("_at").alias("_first"))
    listed = pages.groupBy("space_key").agg(F.max("ord").alias("_last"))
    shift = starts.join(listed, starts["space_key"].eqNullSafe(listed["space_key"]), "left").select(
        starts["space_key"].alias("_space"),
        (F.coalesce(F.col("_last"), F.lit(-1)) + 1 - F.col("_first")).alias("_shift"),
    )
    moved = placed.join(shift, placed["space_key"].eqNullSafe(shift["_space"]))
    moved = moved.withColumn("ord", (F.col("_at") + F.col("_shift")).cast(pages.schema["ord"].dataType))
    return pages.unionByName(moved.select(*pages.columns))


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """Version metadata, one row per page and number."""
    raw = spark.read.schema(schemas.VERSION_RESPONSES).json(path)
    return _rows(raw, F.col("results"), "start", ["page_id"]).select(
        "page_id",
        F.coalesce("number", F.lit(0)).alias("number"),
        F.col("by.displayName").alias("author"),
        F.coalesce("when", F.lit("")).alias("when"),
        F.coalesce("message", F.lit("")).alias("message"),
    )


def read_latest_versions(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.HISTORY_RESPONSES).json(path)
    return raw.select(
        "page_id",
        F.coalesce("lastUpdated.number", F.lit(1)).alias("latest"),
        F.col("lastUpdated.by.displayName").alias("author"),
        F.coalesce("lastUpdated.when", F.lit("")).alias("when"),
    )


def versions_from_latest(latest: DataFrame) -> DataFrame:
    """Rows 1..latest where only the last number is known; only the last has author and time."""
    numbered = latest.where("latest >= 1").withColumn(
        "number", F.explode(F.sequence(F.lit(1), F.col("latest")))
    )
    is_last = F.col("number") == F.col("latest")
    return numbered.select(
        "page_id",
        "number",
        F.when(is_last, F.col("author")).alias("author"),
        F.when(is_last, F.col("when")).alias("when"),
    )


def read_version_bodies(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.BODY_RESPONSES).json(path)
    return raw.select(
        F.coalesce("page_id", "id").alias("page_id"),
        F.col("version.number").alias("number"),
        F.coalesce("body.view.value", F.lit("")).alias("view"),
        F.coalesce("body.storage.value", F.lit("")).alias("storage"),
        F.col("version.by.displayName").alias("author"),
        F.col("version.when").alias("when"),
    )


def read_attachments(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.ATTACHMENT_RESPONSES).json(path)
    return _rows(raw, F.col("results"), "start", ["page_id"]).select(
        "page_id",
        F.coalesce("title", F.lit("attachment")).alias("title"),
        F.coalesce("mediaType", F.lit("application/octet-stream")).alias("media_type"),
        F.col("_links.download").alias("download"),
        "ord",
    )


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Projects keyed by identifier, the last one listed wins."""
    raw = spark.read.schema(schemas.PROJECT_RESPONSES).json(path)
    rows = _rows(raw, F.col("projects"), "offset", [])
    return first_rows(rows, ["identifier"], "ord", last=True).select(
        "identifier", "id", "name", F.col("parent.id").alias("parent_id")
    )


# Places of the mapping columns where the sheet has no such names
MAPPING_PLACES = {"parent": 0, "subproject": 1, "jira_keys": 2, "wiki_keys": 5}


def _cell(sheet: DataFrame, name: str) -> Column:
    if name in sheet.columns:
        cell = F.col(name)
    else:
        place = MAPPING_PLACES[name]
        data = [c for c in sheet.columns if c != "row_no"]
        if place >= len(data):
            return F.lit("")
        cell = F.col(f"`{data[place]}`")
    return F.coalesce(strip(cell.cast("string")), F.lit(""))


def _keys(cell: Column) -> Column:
    parts = F.split(F.replace(cell, F.lit(","), F.lit(" ")), rf"[{SPACE}]+")
    return F.filter(parts, lambda k: (k != "") & (k != "—"))


def mapping_entries(sheet: DataFrame) -> DataFrame:
    """Clean mapping rows of an exported sheet; ``row_no`` gives the sheet order.

    Columns are read by name, else by place. Folder rows and rows without names are dropped.
    """
    rows = sheet.select(
        "row_no",
        _cell(sheet, "parent").alias("parent"),
        _cell(sheet, "subproject").alias("subproject"),
        _keys(_cell(sheet, "jira_keys")).alias("jira_keys"),
        F.filter(_keys(_cell(sheet, "wiki_keys")), lambda k: k != "None").alias("wiki_keys"),
    ).where(
        ~F.startswith("parent", F.lit("\U0001f4c1"))
        & ~F.col("parent").isin("", "None")
        & ~F.col("subproject").isin("", "None")
    )
    basis = F.when(F.size("jira_keys") > 0, F.element_at("jira_keys", 1)).otherwise(
        F.replace("subproject", F.lit(" "), F.lit("-"))
    )
    return rows.withColumn("identifier", identifier(basis))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping sheet exported as CSV with a header; a ``row_no`` column keeps its order."""
    sheet = spark.read.option("header", True).csv(path)
    if "row_no" not in sheet.columns:
        place = F.struct(
            "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")
        )
        sheet = with_index(sheet.withColumn("_place", place), ["_place"], "row_no").drop("_place")
    else:
        sheet = sheet.withColumn("row_no", F.col("row_no").cast("long"))
    return mapping_entries(sheet)
