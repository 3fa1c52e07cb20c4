"""Pages, bodies and attachments: filters, joins and the choice of a body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.scale import lookup


def current_pages(pages: DataFrame) -> DataFrame:
    """Pages of an export that are neither drafts, deleted, untitled nor old versions."""
    return pages.where(
        "original_version_id IS NULL AND title <> '' "
        "AND coalesce(status, '') NOT IN ('draft', 'deleted')"
    )


def kept_attachments(attachments: DataFrame) -> DataFrame:
    return attachments.where("coalesce(content_status, '') <> 'deleted'")


def attachments_of_pages(attachments: DataFrame, pages: DataFrame) -> DataFrame:
    """Attachments that belong to one of the pages; a page may hold very many."""
    owners = pages.select(F.col("id").alias("content_id"))
    return lookup(attachments, owners, ["content_id"], ["id"], "inner")


def versions_of_pages(pages: DataFrame) -> DataFrame:
    """All versions of the current pages: the page itself and those that point to it."""
    current = current_pages(pages)
    now = current.select(F.col("id").alias("page_id"), "id", "version", F.lit(True).alias("current"))
    old = pages.where("original_version_id IS NOT NULL").select(
        F.col("original_version_id").alias("page_id"), "id", "version", F.lit(False).alias("current")
    )
    owners = current.select(F.col("id").alias("page_id"))
    return lookup(old, owners, ["page_id"], ["id"], "inner").unionByName(now)


def body_links(pages: DataFrame, bodies: DataFrame) -> DataFrame:
    """(page, body) pairs: the body names its page, or the page lists the body. Each pair once.

    ``place`` is the order in which a page's bodies are tried.
    """
    named = bodies.where("content_id IS NOT NULL").select(
        F.col("content_id").alias("page_id"),
        F.col("id").alias("body_id"),
        F.struct(F.lit(0).alias("by"), F.col("ord").alias("at")).alias("place"),
    )
    named = named.join(pages.select(F.col("id").alias("page_id")), "page_id", "left_semi")
    listed = pages.select(
        F.col("id").alias("page_id"), F.posexplode("body_content_ids").alias("at", "body_id")
    ).join(bodies.select(F.col("id").alias("body_id")), "body_id", "left_semi")
    listed = listed.select(
        "page_id",
        "body_id",
        F.struct(F.lit(1).alias("by"), F.col("at").cast("long").alias("at")).alias("place"),
    )
    return (
        named.unionByName(listed).groupBy("page_id", "body_id").agg(F.min("place").alias("place"))
    )


def chosen_bodies(pages: DataFrame, bodies: DataFrame) -> DataFrame:
    """The body of each page: the first non-empty one of type 2, else the first non-empty one.

    The choice is made on ids alone; the bodies are read once, for the chosen ids.
    """
    facts = bodies.where("body <> ''").select(
        F.col("id").alias("body_id"),
        F.when(F.col("body_type") == "2", 0).otherwise(1).alias("preference"),
    )
    best = (
        body_links(pages, bodies)
        .join(facts, "body_id")
        .groupBy("page_id")
        .agg(F.min(F.struct("preference", "place", "body_id")).alias("_best"))
        .select("page_id", F.col("_best.body_id").alias("body_id"))
    )
    texts = bodies.select(F.col("id").alias("body_id"), "body")
    return (
        pages.select(F.col("id").alias("page_id"))
        .join(best.join(texts, "body_id"), "page_id", "left")
        .select("page_id", F.coalesce("body", F.lit("")).alias("body"))
    )


def body_choice(*sources: Column) -> Column:
    """The first source that is not empty, else ''."""
    return F.coalesce(*[F.nullif(s, F.lit("")) for s in sources], F.lit(""))


def current_bodies(
    listing: DataFrame, historical: DataFrame, direct: DataFrame
) -> DataFrame:
    """Current body per page from three sources, each by view, then storage.

    All three hold ``page_id, view, storage``, at most one row per page.
    """

    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            "page_id", F.col("view").alias(f"{prefix}_view"), F.col("storage").alias(f"{prefix}_storage")
        )

    joined = (
        named(listing, "l")
        .join(named(historical, "h"), "page_id", "left")
        .join(named(direct, "d"), "page_id", "left")
    )
    order = ["h_view", "h_storage", "d_view", "d_storage", "l_view", "l_storage"]
    return joined.select("page_id", body_choice(*[F.col(c) for c in order]).alias("body"))


def uploads(attachments: DataFrame, images: DataFrame) -> DataFrame:
    """Files to upload with a page, one per name; attachments come before images.

    ``attachments(page_id, filename, content_type, ord)``, ``images(page_id, filename, url)``.
    """
    both = attachments.select(
        "page_id", "filename", F.col("content_type"), F.lit(None).cast("string").alias("url"),
        F.struct(F.lit(0).alias("by"), F.col("ord").cast("long").alias("at")).alias("place"),
    ).unionByName(
        images.select(
            "page_id", "filename", F.lit("application/octet-stream").alias("content_type"), "url",
            F.struct(F.lit(1).alias("by"), F.lit(0).cast("long").alias("at")).alias("place"),
        )
    )
    return (
        both.groupBy("page_id", "filename")
        .agg(F.min(F.struct("place", "content_type", "url")).alias("_first"))
        .select(
            "page_id",
            "filename",
            F.col("_first.content_type").alias("content_type"),
            F.when(F.col("_first.place.by") == 0, F.lit("attachment"))
            .otherwise(F.lit("image"))
            .alias("origin"),
            F.col("_first.url").alias("url"),
        )
    )


def missing_images(images: DataFrame, attachments: DataFrame) -> DataFrame:
    """Images a page shows that are not among its attachments."""
    held = attachments.select("page_id", "filename").distinct()
    return images.join(held, ["page_id", "filename"], "left_anti")


def attachment_counts(attachments: DataFrame) -> DataFrame:
    return attachments.groupBy("page_id").agg(F.count(F.lit(1)).alias("attachments"))
