"""The conversion job: page bodies to wiki text.

A body passes through one stage, without a shuffle, by built-in expressions; only titles with accents go
through an Arrow function. Links to pages and spaces need a
lookup; ``with_link_targets`` adds it, and moves only the bodies that hold such links.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.text import unescape, where_held
from wikiloom.markup import html, links
from wikiloom.markup.lists import convert_lists, fold_titles
from wikiloom.markup.macros import convert_macros
from wikiloom.markup.marks import TABLE_OPEN
from wikiloom.scale import landed, lookup

_PAGE_ID = r"pageId=(\d+)"
_DISPLAY_SPACE = r'href="/display/([^/"]+)/[^"]'


def _site_steps(
    fmt: str, pages: Column | None, spaces: Column | None, project: Column | None
) -> list[Callable[[Column], Column]]:
    def stored(body: Column) -> Column:
        body = links.stored_images(body, "site", fmt)
        body = links.wrapped_images(body, fmt)
        body = links.stored_links(body, "site", fmt)
        body = links.emoticons(body, "site")
        return html.font_colours(html.drop_leftover_tags(body))

    def blocks(body: Column) -> Column:
        return html.headings(html.clean_tables(html.code(body, "site", fmt)), fmt)

    def inline(body: Column) -> Column:
        body = html.strikes(html.emphasis(body), "site", fmt)
        body = links.shown_mentions(body)
        body = links.shown_links(body, fmt, pages, spaces, project)
        return links.shown_images(body, "site", fmt)

    return [lambda body: convert_macros(body, "site", fmt), _held(stored), _held(blocks), _held(inline)]


def _export_steps() -> list[Callable[[Column], Column]]:
    def stored(body: Column) -> Column:
        body = links.stored_images(body, "export", "markdown")
        body = links.stored_links(body, "export", "markdown")
        return html.drop_leftover_tags(links.emoticons(body, "export"))

    def blocks(body: Column) -> Column:
        body = html.pipe_tables(html.code(body, "export", "markdown"))
        return html.headings(html.colour_text(body), "markdown")

    def inline(body: Column) -> Column:
        body = html.strikes(html.plain_emphasis(body), "export", "markdown")
        return links.shown_images(links.plain_links(body), "export", "markdown")

    return [
        lambda body: convert_macros(body, "export", "markdown"), _held(stored), _held(blocks, TABLE_OPEN), _held(inline)
    ]


def _tail(body: Column, form: str, fmt: str) -> Column:
    def tags(body: Column) -> Column:
        body = html.paragraphs(body)
        if form == "site":
            body = html.quotes(html.definitions(body, fmt))
        return html.drop_other_tags(body, form, fmt)

    return _held(tags)(html.titles(body, form))


def _held(rules: Callable[[Column], Column], *marks: str) -> Callable[[Column], Column]:
    """Rules whose every match holds a tag: bodies that have none left skip them by one search."""
    return lambda body: where_held(body, rules, "<", *marks)


@lru_cache(maxsize=32)
def _steps(app: str, form: str, fmt: str, lookups: tuple[str, ...]) -> list[Column]:
    """The steps of a conversion; step i reads column ``_i``.

    They are the same for every table, so one application builds them once. The analyzer resolves
    one level of nested lambdas per round and stops after 100, hence several steps; Catalyst puts
    neighbouring ones back into one projection.
    """
    given = [F.col(c) if c in lookups else None for c in ("link_pages", "link_spaces", "project")]
    steps = _export_steps() if form == "export" else _site_steps(fmt, *given)
    steps += [
        _held(lambda body: convert_lists(body, fmt == "textile")),
        fold_titles,
        lambda body: _tail(body, form, fmt),
        unescape,
        lambda body: html.finish(body, fmt),
    ]
    return [step(F.col(f"_{i}")) for i, step in enumerate(steps)]


def convert_pages(
    bodies: DataFrame,
    fmt: str = "markdown",
    form: str = "site",
    body: str = "body",
    out: str = "text",
) -> DataFrame:
    """Add the converted text of each body.

    ``fmt`` is markdown or textile. ``form`` is site for bodies fetched from a running wiki and
    export for those of an XML export, which go to markdown. If the columns ``link_pages``,
    ``link_spaces`` and ``project`` are present, page and display links lead to their targets.
    """
    if fmt not in ("markdown", "textile"):
        raise ValueError(f"unknown format: {fmt}")
    if form not in ("site", "export") or (form == "export" and fmt != "markdown"):
        raise ValueError(f"unknown form: {form} to {fmt}")

    lookups = tuple(c for c in ("link_pages", "link_spaces", "project") if c in bodies.columns)
    app = bodies.sparkSession.sparkContext.applicationId
    steps = _steps(app, form, fmt, lookups)
    done = bodies.withColumn("_0", F.coalesce(F.col(body), F.lit("")))
    for i, step in enumerate(steps, 1):
        done = done.withColumn(f"_{i}", step)
    return done.withColumn(out, F.col(f"_{len(steps)}")).drop(
        *[f"_{i}" for i in range(len(steps) + 1)]
    )


def holds_targets(body: Column, with_spaces: bool = True) -> Column:
    """Whether a body holds links to pages or, ``with_spaces``, to spaces, for which ``with_link_targets`` looks."""
    linked = F.regexp_like(body, F.lit(_PAGE_ID))
    if with_spaces:
        linked = linked | F.regexp_like(body, F.lit(_DISPLAY_SPACE))
    return linked


def with_link_targets(
    bodies: DataFrame,
    keys: Sequence[str],
    targets: DataFrame,
    spaces: DataFrame | None = None,
    body: str = "body",
) -> DataFrame:
    """Add ``link_pages`` (page id to title and project) and ``link_spaces`` (upper space key to
    project) for the links in each body.

    ``targets(id, wiki_title, project)``, ``spaces(key, identifier)``; ``keys`` are unique per
    body. Only the ids of links are looked up, popular targets salted; the number of ids of one
    body is bounded by the body itself. Bodies without such links are not shuffled.
    """
    keys = list(keys)
    page_map = "map<string, struct<title: string, project: string>>"
    linked = holds_targets(F.col(body), spaces is not None)
    without = bodies.where(~linked | F.col(body).isNull()).withColumns(
        {
            "link_pages": F.lit(None).cast(page_map),
            "link_spaces": F.lit(None).cast("map<string, string>"),
        }
    )
    holding = bodies.where(linked)

    # The ids are written once, so that bodies are searched once and moved once, to the maps of both kinds.
    def ids(pattern: str) -> Column:
        return F.array_distinct(F.regexp_extract_all(body, F.lit(pattern), F.lit(1)))

    named_ids = landed(
        holding.select(*keys, ids(_PAGE_ID).alias("_pages"), ids(_DISPLAY_SPACE).alias("_spaces")), "link-ids"
    )

    def found(column: str) -> DataFrame:
        return named_ids.select(*keys, F.explode(column).alias("_link"))

    page_rows = lookup(
        found("_pages"),
        targets.select(
            F.col("id").alias("_link"),
            F.struct(F.col("wiki_title").alias("title"), "project").alias("_to"),
        ),
        ["_link"],
        keys,
        "inner",
    )
    page_maps = page_rows.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_link", "_to"))).alias("link_pages")
    )
    if spaces is None:
        maps = page_maps.withColumn("link_spaces", F.lit(None).cast("map<string, string>"))
    else:
        homes = spaces.groupBy(F.upper("key").alias("_link")).agg(
            F.max("identifier").alias("_to")
        )
        named = found("_spaces").withColumn("_link", F.upper("_link")).distinct()
        space_maps = (
            lookup(named, homes, ["_link"], keys, "inner")
            .groupBy(*keys)
            .agg(F.map_from_entries(F.collect_list(F.struct("_link", "_to"))).alias("link_spaces"))
        )
        maps = page_maps.join(space_maps, keys, "full")
    return holding.join(maps, keys, "left").unionByName(without)


# Fixed values
EMPTY_PAGE, EMPTY_VERSION = "*Empty page*", "*Empty version*"
EMPTY_EXPORT = "*Empty page migrated from Confluence*"


def page_text(title: Column, text: Column, child_text: Column, form: str = "site") -> Column:
    """Text of a current page: heading, body or placeholder, children."""
    empty = EMPTY_EXPORT if form == "export" else EMPTY_PAGE
    body = F.coalesce(F.nullif(text, F.lit("")), F.lit(empty))
    whole = F.concat(body, F.coalesce(child_text, F.lit("")))
    return F.concat(F.lit("# "), title, F.lit("\n\n"), F.replace(whole, F.lit("\x00"), F.lit("")))


def version_text(title: Column, text: Column, number: Column, total: Column) -> Column:
    """Text of an old version, with its number at the end."""
    body = F.coalesce(F.nullif(text, F.lit("")), F.lit(EMPTY_VERSION))
    return F.concat(
        F.lit("# "), title, F.lit("\n\n"), body, F.lit("\n\n<!-- Confluence version "),
        number.cast("string"), F.lit("/"), total.cast("string"), F.lit(" -->"),
    )


def _when(when: Column) -> Column:
    return F.substring(F.coalesce(when, F.lit("")), 1, 19)


def old_comment(number: Column, total: Column, author: Column, when: Column) -> Column:
    return F.concat(
        F.lit("v"), number.cast("string"), F.lit("/"), total.cast("string"), F.lit(" by "),
        F.coalesce(author, F.lit("unknown")), F.lit(" ("), _when(when), F.lit(")"),
    )


def current_comment(author: Column, when: Column) -> Column:
    """Null where the author is not known."""
    return F.when(
        F.coalesce(author, F.lit("")) != "",
        F.concat(F.lit("Current version by "), author, F.lit(" ("), _when(when), F.lit(")")),
    )


def export_version_comment(version: Column, author: Column, when: Column) -> Column:
    dated = F.when(_when(when) != "", F.concat(F.lit(" ("), _when(when), F.lit(")"))).otherwise("")
    return F.concat(
        F.lit("v"), version.cast("string"), F.lit(" by "), F.coalesce(author, F.lit("unknown")), dated
    )


def export_page_comment(author: Column, when: Column) -> Column:
    both = (F.coalesce(author, F.lit("")) != "") & (F.coalesce(when, F.lit("")) != "")
    return F.when(
        both,
        F.concat(
            F.lit("Migrated from Confluence — last edit by "), author, F.lit(" ("), _when(when),
            F.lit(")"),
        ),
    )


EXPORT_FINAL_COMMENT = "Final version with attachments"
