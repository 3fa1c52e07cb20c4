"""Links, images, macros, mentions and headings in page bodies, and where links lead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.keys import file_name, heading_anchor, wiki_title
from wikiloom.functions.text import decode_common, drop_tags, group, strip, url_unquote
from wikiloom.scale import first_rows, lookup

# Fixed patterns: how the source wiki writes links, images, macros and mentions
LINK = r'(?s)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>'
IMAGE_SOURCE = r'src="(/download/(?:attachments|thumbnails)/\d+/[^"]+)"'
IMAGE_FILE = r"/download/(?:attachments|thumbnails)/\d+/([^?\"]+)"
MACRO_NAME = r'<ac:structured-macro[^>]*ac:name="([^"]*)"'
STORED_MENTION = r"(?s)<ac:link(?=[\s>])[^>]*+>(?:[^<]++|<(?!/?ac:link[\s>]))*+</ac:link>"
SHOWN_MENTION = r'(?s)<a\b[^>]*class="[^"]*confluence-userlink[^"]*"[^>]*>.*?</a>'
HEADING = r"(?s)<h([1-6])\b[^>]*>.*?</h\1>"


def _hits(bodies: DataFrame, pattern: str, number: int, name: str) -> DataFrame:
    """One row per match and page, in reading order."""
    return bodies.select(
        "page_id",
        F.posexplode(F.regexp_extract_all("body", F.lit(pattern), F.lit(number))).alias("pos", name),
    )


def label_text(html: Column) -> Column:
    return decode_common(strip(drop_tags(html)))


def link_class(href: Column) -> Column:
    return (
        F.when(F.startswith(href, F.lit("#")), F.lit("anchor"))
        .when(F.regexp_like(href, F.lit(r"pageId=\d+")), F.lit("page"))
        .when(F.regexp_like(href, F.lit("^/display/[^/?]+/[^?]")), F.lit("display"))
        .when(F.startswith(href, F.lit("/")) & ~F.startswith(href, F.lit("//")), F.lit("relative"))
        .otherwise(F.lit("external"))
    )


def page_links(bodies: DataFrame) -> DataFrame:
    """Links of each page with class, label and, for page links, the target id."""
    hits = _hits(bodies, LINK, 0, "tag")
    href = group(F.col("tag"), LINK, 1)
    label = label_text(group(F.col("tag"), LINK, 2))
    rows = hits.select("page_id", "pos", href.alias("href"), label.alias("label"))
    return rows.select(
        "page_id",
        "pos",
        "href",
        F.coalesce(F.nullif("label", F.lit("")), "href").alias("label"),
        link_class(F.col("href")).alias("class"),
        F.nullif(group(F.col("href"), r"pageId=(\d+)"), F.lit("")).alias("target_id"),
    )


def display_target(href: Column) -> tuple[Column, Column]:
    """Space key and page title of a ``/display/KEY/Title`` link."""
    steps = F.split(F.split_part(href, F.lit("?"), F.lit(1)), "/")
    shown = F.startswith(href, F.lit("/display/")) & (F.size(steps) > 3)
    title = F.replace(F.array_join(F.slice(steps, 4, 1 << 30), "/"), F.lit("+"), F.lit(" "))
    return (
        F.when(shown, F.get(steps, F.lit(2))).otherwise(""),
        F.when(shown, url_unquote(title)).otherwise(""),
    )


def page_images(bodies: DataFrame) -> DataFrame:
    """Images of each page by safe file name; the first source of a name wins."""
    hits = _hits(bodies, IMAGE_SOURCE, 1, "source")
    named = hits.select(
        "page_id",
        "pos",
        file_name(url_unquote(group(F.col("source"), IMAGE_FILE))).alias("filename"),
        F.split_part("source", F.lit("?"), F.lit(1)).alias("url"),
    ).where(F.regexp_like("url", F.lit(IMAGE_FILE)))
    return named.groupBy("page_id", "filename").agg(F.min_by("url", "pos").alias("url"))


def page_macros(bodies: DataFrame) -> DataFrame:
    return (
        _hits(bodies, MACRO_NAME, 1, "macro")
        .groupBy("page_id", "macro")
        .agg(F.count(F.lit(1)).alias("uses"))
    )


def stored_mention(link: Column) -> Column:
    """Name in a stored user link: label, user name, else ``user``."""
    label = r"(?s)<ac:link-body[^>]*>(.*?)</ac:link-body>"
    username = group(link, r'ri:username="([^"]*)"')
    return (
        F.when(F.regexp_like(link, F.lit(label)), strip(drop_tags(group(link, label))))
        .when(username != "", username)
        .otherwise(F.lit("user"))
    )


def shown_mention(link: Column) -> Column:
    """Name in a rendered user link."""
    name = strip(drop_tags(link))
    username = group(link, r'data-username="([^"]*)"')
    return F.when(name != "", name).when(username != "", username).otherwise(F.lit("user"))


def page_mentions(bodies: DataFrame) -> DataFrame:
    stored = _hits(bodies, STORED_MENTION, 0, "tag").where(F.contains("tag", F.lit("<ri:user")))
    shown = _hits(bodies, SHOWN_MENTION, 0, "tag")
    return stored.select(
        "page_id", "pos", F.lit("stored").alias("form"), stored_mention(F.col("tag")).alias("name")
    ).unionByName(
        shown.select(
            "page_id", "pos", F.lit("shown").alias("form"), shown_mention(F.col("tag")).alias("name")
        )
    )


def page_headings(bodies: DataFrame) -> DataFrame:
    hits = _hits(bodies, HEADING, 0, "tag")
    return hits.select(
        "page_id",
        "pos",
        group(F.col("tag"), r"^<h([1-6])").cast("int").alias("level"),
        label_text(F.col("tag")).alias("heading"),
        heading_anchor(F.col("tag")).alias("anchor"),
    )


def page_map(pages: DataFrame, spaces: DataFrame) -> DataFrame:
    """Target title and project of each page id over all spaces; the first one seen wins.

    ``pages(id, title, space_key, ord)``, ``spaces(key, identifier, ord)``. One space may hold most
    pages, so its key is salted; ids are picked by their place, not by sorting groups.
    """
    homes = spaces.select(
        F.col("key").alias("space_key"), "identifier", F.col("ord").alias("space_ord")
    )
    placed = lookup(
        pages.select("id", "title", "space_key", "ord"), homes, ["space_key"], ["id"], "inner"
    ).withColumn("place", F.struct("space_ord", "ord"))
    return first_rows(placed, ["id"], "place").select(
        "id", wiki_title(F.col("title")).alias("wiki_title"), F.col("identifier").alias("project")
    )


def same_titles(pages: DataFrame) -> DataFrame:
    """Pages of a project that would overwrite each other: equal wiki titles."""
    return (
        pages.groupBy("project", "wiki_title")
        .agg(F.count(F.lit(1)).alias("pages"), F.min("id").alias("first_id"))
        .where("pages > 1")
    )


def resolved_links(links: DataFrame, targets: DataFrame) -> DataFrame:
    """Page links with the target's title and project, and what kind of link results.

    ``links(page_id, pos, target_id, label, project)`` where ``project`` is that of the page that
    holds the link. A home page may be the target of most links; such ids are salted.
    """
    found = targets.select(
        F.col("id").alias("target_id"),
        F.col("wiki_title").alias("target_title"),
        F.col("project").alias("target_project"),
    )
    joined = lookup(links, found, ["target_id"], ["page_id", "pos"])
    kind = (
        F.when(F.col("target_project").isNull(), F.lit("unknown"))
        .when(
            F.col("project").isNotNull() & (F.col("project") != F.col("target_project")),
            F.lit("cross project"),
        )
        .otherwise(F.lit("same project"))
    )
    return joined.withColumn("kind", kind)


def link_counts(links: DataFrame) -> DataFrame:
    return links.groupBy("page_id", "class").agg(F.count(F.lit(1)).alias("links"))
