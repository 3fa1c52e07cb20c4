"""Version histories: order, caps, batches, gaps, comparison and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.keys import fingerprint
from wikiloom.scale import lookup, with_group_position, with_index

SECONDS_PER_VERSION = 0.15
LARGE_HISTORY = 500


def history(versions: DataFrame) -> DataFrame:
    """Versions of each page from oldest to newest with ``position`` and ``total``.

    ``versions(page_id, number)``: keep bodies out, they are joined later by page and number. The
    last position is the current version.
    """
    placed = with_group_position(versions, ["page_id"], ["number"])
    return placed.withColumn("is_current", F.col("position") == F.col("total"))


def merged_history(old: DataFrame, current: DataFrame) -> DataFrame:
    """One history from old versions and current ones; the current one is always the newest."""
    both = old.withColumn("is_current", F.lit(False)).unionByName(
        current.withColumn("is_current", F.lit(True))
    )
    return with_group_position(both, ["page_id"], ["is_current", "number"])


def capped(placed: DataFrame, newest: int = 0) -> DataFrame:
    """Old versions to move: all but the current one, of these the ``newest`` (0 = all)."""
    old = placed.where("position < total")
    if newest > 0:
        old = old.where(F.col("position") >= F.col("total") - newest)
    return old


def cap_report(placed: DataFrame, newest: int = 0) -> DataFrame:
    """Per page: versions in total, old ones kept, oldest ones skipped, and the large-history flag."""
    old = F.greatest(F.col("total") - 1, F.lit(0))
    kept = F.least(old, F.lit(newest)) if newest > 0 else old
    return placed.where("position = 1").select(
        "page_id",
        "total",
        kept.alias("kept"),
        (old - kept).alias("skipped"),
        ((old > LARGE_HISTORY) & ((old == kept) if newest > 0 else F.lit(True))).alias("large"),
    )


def coverage(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("total").alias("versions"),
        F.sum("kept").alias("kept"),
        F.sum("skipped").alias("skipped"),
        F.count_if("large").alias("large_pages"),
    )


def version_batches(kept: DataFrame, newest: int = 0, size: int = 25) -> DataFrame:
    """Batch of each kept old version, counted from its first kept version on."""
    first = F.greatest(F.col("total") - newest, F.lit(1)) if newest > 0 else F.lit(1)
    return kept.withColumn("batch", F.floor((F.col("position") - first) / size))


def batch_totals(batches: DataFrame) -> DataFrame:
    return batches.groupBy("page_id", "batch").agg(
        F.count(F.lit(1)).alias("versions"),
        F.min("number").alias("first_number"),
        F.max("number").alias("last_number"),
    )


def last_versions(placed: DataFrame, count: int = 3) -> DataFrame:
    return placed.where(F.col("position") > F.col("total") - count)


def named_versions(placed: DataFrame, numbers: list[int]) -> DataFrame:
    return placed.where(F.col("number").isin(numbers))


def missing_numbers(versions: DataFrame, block: int = 10_000) -> DataFrame:
    """Numbers between the first and the last version of a page that it does not have.

    In the order of (page, number) each version is joined to its neighbour by the global index, so
    the versions of one page may lie in any number of tasks. Long gaps are unrolled in blocks.
    """
    have = versions.select("page_id", F.col("number").cast("long").alias("number")).distinct()
    placed = with_index(have, ["page_id", "number"], "_at")
    before = placed.select(
        "page_id", (F.col("_at") + 1).alias("_at"), F.col("number").alias("_before")
    )
    gaps = (
        placed.join(before, ["page_id", "_at"])
        .where(F.col("number") > F.col("_before") + 1)
        .select(
            "page_id",
            (F.col("_before") + 1).alias("_from"),
            (F.col("number") - 1).alias("_to"),
        )
    )
    blocks = gaps.withColumn(
        "_at", F.explode(F.sequence("_from", "_to", F.lit(block).cast("long")))
    )
    return blocks.select(
        "page_id",
        F.explode(F.sequence("_at", F.least(F.col("_at") + (block - 1), F.col("_to")))).alias(
            "number"
        ),
    )


def content_groups(bodies: DataFrame) -> DataFrame:
    """Per page and fingerprint: how many sources give this content, its size, the first source.

    ``bodies(page_id, source, body)``. Null bodies are failed fetches and count nowhere.
    """
    return (
        bodies.where("body IS NOT NULL")
        .withColumn("fingerprint", fingerprint(F.col("body")))
        .groupBy("page_id", "fingerprint")
        .agg(
            F.count(F.lit(1)).alias("sources"),
            F.max(F.length("body")).alias("size"),
            F.min("source").alias("first_source"),
        )
    )


def content_verdict(groups: DataFrame) -> DataFrame:
    many = F.count(F.lit(1))
    return groups.groupBy("page_id").agg(
        many.alias("contents"),
        F.when(many == 1, F.lit("identical")).otherwise(F.lit("mismatch")).alias("verdict"),
    )


def content_members(bodies: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source with the first source of its content; groups may be of any size."""
    marked = bodies.where("body IS NOT NULL").select(
        "page_id", "source", fingerprint(F.col("body")).alias("fingerprint")
    )
    firsts = groups.select("page_id", "fingerprint", "first_source")
    return lookup(marked, firsts, ["page_id", "fingerprint"], ["source"], "inner",
                  counts=groups.withColumnRenamed("sources", "_n"))


def consecutive_pairs(placed: DataFrame, bodies: DataFrame) -> DataFrame:
    """Each version beside the one before it: ``number, previous``, their sizes and fingerprints.

    Positions are known, so the neighbour is found by an equi-join on (page, position) and the
    history of one page may lie in any number of tasks. No body is moved.
    """
    body = F.coalesce("body", F.lit(""))
    marks = bodies.select(
        "page_id", "number", F.length(body).alias("size"), F.sha2(body, 256).alias("mark")
    )
    found = placed.select("page_id", "number", "position").join(marks, ["page_id", "number"], "left")
    # A version without a body counts as empty.
    texts = found.select(
        "page_id", "number", "position", F.coalesce("size", F.lit(0)).alias("size"),
        F.coalesce("mark", F.sha2(F.lit(""), 256)).alias("mark"),
    )
    before = texts.select(
        "page_id",
        (F.col("position") + 1).alias("position"),
        F.col("number").alias("previous"),
        F.col("size").alias("previous_size"),
        F.col("mark").alias("previous_mark"),
    )
    return texts.join(before, ["page_id", "position"])


def version_changes(pairs: DataFrame) -> DataFrame:
    """What changed against the version before: nothing, or the sizes."""
    same = (F.col("size") == F.col("previous_size")) & (F.col("mark") == F.col("previous_mark"))
    state = (
        F.when((F.col("size") == 0) & (F.col("previous_size") == 0), F.lit("both empty"))
        .when(same, F.lit("identical"))
        .otherwise(F.lit("changed"))
    )
    return pairs.select(
        "page_id", "previous", "number", state.alias("state"), "previous_size", "size"
    )


def line_changes(changes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Add the lines added and removed: the difference of the two bodies as multisets of lines.

    A line that only moved counts nowhere. Bodies are joined for changed pairs only, and counted
    line by line, so no body is too long and no pair is one task.
    """
    keys = ["page_id", "number", "previous"]
    changed = changes.where("state = 'changed'").select(*keys)
    texts = bodies.where("body <> ''").select(
        "page_id", F.col("number").alias("_of"), F.split("body", "\n").alias("_lines")
    )

    def lines(side: str, sign: int) -> DataFrame:
        both = changed.withColumn("_of", F.col(side)).join(texts, ["page_id", "_of"])
        return both.select(*keys, F.explode("_lines").alias("_line"), F.lit(sign).alias("_sign"))

    counts = (
        lines("number", 1).unionByName(lines("previous", -1))
        .groupBy(*keys, "_line").agg(F.sum("_sign").alias("_n"))
        .groupBy(*keys).agg(
            F.sum(F.greatest("_n", F.lit(0))).alias("added"),
            F.sum(F.greatest(-F.col("_n"), F.lit(0))).alias("removed"),
        )
    )
    return changes.join(counts, keys, "left").fillna(0, ["added", "removed"])


def version_totals(versions: DataFrame) -> DataFrame:
    """Versions in total, mean per page and estimated minutes to move them."""
    per_page = versions.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return per_page.agg(
        F.count(F.lit(1)).alias("pages"),
        total.alias("versions"),
        F.round(total / F.count(F.lit(1)), 1).alias("mean_versions"),
        F.round(total * SECONDS_PER_VERSION / 60, 2).alias("minutes"),
    )


def cut_after_failures(fetches: DataFrame, limit: int = 5) -> DataFrame:
    """Where the fetches of a page stop: the ``limit``-th failure in a row.

    ``fetches(page_id, attempt, outcome)`` with outcome ok, not_found or failed. A missing version
    neither counts as a failure nor ends a run of them. Runs are found by two indexes: within a
    run, the index among all rows and the index among failures grow together.
    """
    counted = fetches.where("outcome <> 'not_found'").select("page_id", "attempt", "outcome")
    every = with_index(counted, ["page_id", "attempt"], "_all")
    failed = with_index(
        every.where("outcome = 'failed'").select("page_id", "attempt", "_all"), ["_all"], "_failed"
    )
    runs = failed.groupBy("page_id", (F.col("_all") - F.col("_failed")).alias("_run")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_all").alias("_first")
    )
    cuts = (
        runs.where(F.col("_n") >= limit)
        .groupBy("page_id")
        .agg((F.min("_first") + (limit - 1)).alias("_all"))
    )
    return every.join(cuts, ["page_id", "_all"]).select("page_id", F.col("attempt").alias("cut_at"))


def before_cut(fetches: DataFrame, cuts: DataFrame) -> DataFrame:
    """The fetches that were still made."""
    joined = lookup(fetches, cuts, ["page_id"], ["attempt"])
    return joined.where("cut_at IS NULL OR attempt <= cut_at").drop("cut_at")


def fetched_against_asked(asked: DataFrame, got: DataFrame, pushed: DataFrame | None = None) -> DataFrame:
    """State of each asked version: ok, ``no_data`` or ``push_fail``.

    ``asked(page_id, number, ..)``, ``got(page_id, number)``, ``pushed(page_id, number, ok)``.
    """
    rows = asked.join(
        got.select("page_id", "number", F.lit(True).alias("_got")), ["page_id", "number"], "left"
    )
    state: Column = F.when(F.col("_got").isNull(), F.lit("no_data"))
    if pushed is not None:
        rows = rows.join(
            pushed.select("page_id", "number", F.col("ok").alias("_ok")),
            ["page_id", "number"],
            "left",
        )
        state = state.when(~F.coalesce("_ok", F.lit(False)), F.lit("push_fail"))
    return rows.withColumn("state", state.otherwise(F.lit("ok"))).drop("_got", "_ok")


def failed_entries(states: DataFrame) -> DataFrame:
    return states.where("state <> 'ok'").select(
        "page_id",
        "number",
        F.concat(F.lit("v"), F.col("number").cast("string"), F.lit(":"), "state").alias("entry"),
    )


def revision_check(states: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Per page: asked, fetched, pushed, new revisions on the target, and whether some are missing.

    ``before`` and ``after`` hold ``page_id, revision``. Failed entries are rows of
    ``failed_entries``.
    """
    counts = states.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("asked"),
        F.count_if(F.col("state") != "no_data").alias("fetched"),
        F.count_if(F.col("state") == "ok").alias("pushed"),
        F.count_if(F.col("state") != "ok").alias("failed"),
    )
    new = F.coalesce("_after", F.lit(0)) - F.coalesce("_before", F.lit(0))
    return (
        counts.join(before.select("page_id", F.col("revision").alias("_before")), "page_id", "left")
        .join(after.select("page_id", F.col("revision").alias("_after")), "page_id", "left")
        .withColumn("new_revisions", new)
        .withColumn("mismatch", F.col("new_revisions") < F.col("pushed"))
        .drop("_before", "_after")
    )
