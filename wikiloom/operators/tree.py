"""The page tree: parents, depth, push order, children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.scale import landed, listed_in_parts, lookup, with_index


def with_parent_from_ancestors(pages: DataFrame) -> DataFrame:
    """``parent_id`` is the last ancestor; pages without ancestors are roots."""
    last = F.when(F.size("ancestors") > 0, F.element_at("ancestors", -1)["id"])
    return pages.withColumn("parent_id", last)


def known_parents(pages: DataFrame) -> DataFrame:
    """Set ``parent_id`` to null where the parent is not among the pages: these become roots."""
    ids = pages.select(F.col("id").alias("parent_id"), F.lit(True).alias("_known"))
    return (
        lookup(pages, ids, ["parent_id"], ["id"])
        .withColumn("parent_id", F.when(F.col("_known"), F.col("parent_id")))
        .drop("_known")
    )


PATH_KEYS = 8


def tree_paths(pages: DataFrame, sibling_order: Sequence[str]) -> DataFrame:
    """Depth of each page and ``path``, by which pages of one depth are ordered as by the sibling sort
    keys from the root down.

    Each round doubles the length of the known path pieces, so a tree of depth d takes about
    log2(d) joins. Pieces of ``PATH_KEYS`` keys are replaced by their ranks, so a row stays narrow in
    a tree of any depth. Pages in a circle of parents never reach a root and are left out, as are the
    pages below them; ``unreached_pages`` lists them.
    """
    key = F.struct(*sibling_order)
    rows = known_parents(pages.select("id", "parent_id", *sibling_order)).select(
        "id", "parent_id", F.col("parent_id").alias("up"), F.array(key).alias("path"),
        F.lit(0).alias("depth"),
    )
    # Written tables are planned by the size of their files. A checkpoint keeps the estimate of its plan, in which
    # each join multiplies the sizes of its sides: within some rounds that number alone fills the driver.
    rows = landed(rows, "tree-rows")
    waiting = rows.where("up IS NOT NULL").count()
    held = 1
    while waiting:
        if held >= PATH_KEYS:
            rows, held = _ranked(rows), 1
        above = rows.select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"),
            F.col("depth").alias("_depth"),
        )
        grown = lookup(rows.where("up IS NOT NULL"), above, ["up"], ["id"]).select(
            "id", "parent_id", F.col("_up").alias("up"), F.concat("_path", "path").alias("path"),
            (F.col("_depth") + F.col("depth") + 1).alias("depth"),
        )
        rows = landed(rows.where("up IS NULL").unionByName(grown), "tree-rows")
        held *= 2
        left = rows.where("up IS NOT NULL").count()
        if left == waiting:
            break
        waiting = left
    return rows.where("up IS NULL").select("id", "parent_id", "depth", "path")


def _ranked(rows: DataFrame) -> DataFrame:
    """Each path as one number that orders as the path does; equal paths have equal numbers.

    Pages of one depth hold as many keys as each other in every round, so their paths stay comparable.
    """
    paths = rows.groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
    ranks = with_index(paths, ["path"], "_rank")
    found = lookup(
        rows, ranks.select("path", "_rank"), ["path"], ["id"], "inner", counts=ranks.select("path", "_n")
    )
    return landed(found.withColumn("path", F.array("_rank")).drop("_rank"), "tree-ranked")


def unreached_pages(pages: DataFrame, paths: DataFrame) -> DataFrame:
    """Pages that hang on a circle of parents."""
    return pages.join(paths.select("id"), "id", "left_anti")


def push_order(paths: DataFrame, partition: Sequence[str] = ()) -> DataFrame:
    """Breadth-first order: by depth, then by path, then by id. Parents come before their children."""
    return with_index(paths, [*partition, "depth", "path", "id"], "ord")


def root_counts(pages: DataFrame) -> DataFrame:
    rooted = known_parents(pages)
    return rooted.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("parent_id").isNull()).alias("roots"),
        F.count_if(F.col("parent_id").isNotNull()).alias("nested"),
    )


def with_parent_title(pages: DataFrame) -> DataFrame:
    """Wiki title of the parent, null where the parent is not moved itself."""
    titles = pages.select(
        F.col("id").alias("parent_id"), F.col("wiki_title").alias("parent_title")
    )
    return lookup(pages, titles, ["parent_id"], ["id"])


def pages_with_children(pages: DataFrame) -> DataFrame:
    return pages.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("id")).agg(
        F.count(F.lit(1)).alias("children")
    )


# Fixed values
CHILD_MACRO = "\n\n---\n\n{{child_pages}}\n"
CHILD_HEADING = "\n\n---\n\n## Child pages\n\n"


def child_macro(pages: DataFrame) -> DataFrame:
    """Text appended to pages that have children."""
    return pages_with_children(pages).select("id", F.lit(CHILD_MACRO).alias("child_text"))


def child_links(pages: DataFrame, sibling_order: Sequence[str], part_rows: int = 10_000) -> DataFrame:
    """Sorted list of links to the children, appended to the parent's text: one row per parent.

    The lines are sorted over all tasks and joined in parts of ``part_rows`` before a parent's row
    is made, so the size of a part never shows in the text.
    """
    line = F.concat(
        F.lit("- [["), F.col("wiki_title"), F.lit("|"), F.col("title"), F.lit("]]\n")
    )
    parts = listed_in_parts(
        pages.where("parent_id IS NOT NULL").select(
            "parent_id", "wiki_title", "title", *sibling_order
        ),
        ["parent_id"],
        list(sibling_order),
        line,
        "lines",
        part_rows,
    )
    part = F.struct("part", F.array_join("lines", "").alias("text"))
    whole = parts.groupBy(F.col("parent_id").alias("id")).agg(
        F.array_sort(F.collect_list(part)).alias("_parts")
    )
    text = F.concat(F.lit(CHILD_HEADING), F.array_join(F.col("_parts.text"), ""))
    return whole.select("id", text.alias("child_text"))


def sorted_pages(pages: DataFrame) -> DataFrame:
    """Review order: by parent, then position."""
    return pages.orderBy(F.coalesce("parent_id", F.lit("")), "position", "id")


def listing(ordered: DataFrame, rows: int = 30) -> DataFrame:
    """Dry-run lines of the first pages of each space in push order, and one line for the rest of it.

    ``ordered`` holds ``ord, depth, wiki_title, parent_title`` (as written) and ``body_length``. With a
    column ``space``, ``ord`` counts from 0 within the space; else all pages are one space.
    """
    space = ["space"] if "space" in ordered.columns else []

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    line = F.concat(
        F.repeat(F.lit("  "), F.col("depth")),
        F.col("wiki_title"),
        F.lit(" [parent: "),
        F.coalesce("parent_title", F.lit("(root)")),
        F.lit(", body: "),
        text("body_length"),
        F.lit("b]"),
    )
    head = ordered.where(F.col("ord") < rows).select(*space, "ord", line.alias("line"))
    more = F.concat(F.lit("... and "), (F.col("_n") - rows).cast("string"), F.lit(" more"))
    rest = (
        ordered.groupBy(*space).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows)
        .select(*space, F.lit(rows).cast("long").alias("ord"), more.alias("line"))
    )
    return head.unionByName(rest)


def cooldown_points(ordered: DataFrame, heavy: int = 50, every: int = 50) -> DataFrame:
    """Pages after which a migration rests: long histories and every 50th page.

    ``ordered`` holds ``space, ord`` (from 0 within the space), ``versions``.
    """
    totals = ordered.groupBy("space").agg(F.count(F.lit(1)).alias("_n"))
    number = F.col("ord") + 1
    marked = lookup(ordered, totals, ["space"], ["ord"], "inner",
                    counts=totals).select(
        "space",
        "id",
        "ord",
        (F.col("versions") > heavy).alias("heavy"),
        ((number % every == 0) & (number < F.col("_n"))).alias("periodic"),
    )
    return marked.where("heavy OR periodic")
