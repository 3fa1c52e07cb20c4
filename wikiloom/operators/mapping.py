"""Spaces, projects and the mapping between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.keys import identifier
from wikiloom.scale import lookup


def without_spaces(spaces: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drop the spaces whose key is listed in ``excluded(key)``, whatever the case."""
    left = spaces.withColumn("_key", F.upper("key"))
    right = excluded.select(F.upper(F.trim("key")).alias("_key"))
    return left.join(right, "_key", "left_anti").drop("_key")


def list_spaces(spaces: DataFrame) -> DataFrame:
    return spaces.select("key", "name", F.coalesce("type", F.lit("?")).alias("type")).orderBy("key")


def _key_table(entries: DataFrame, keys: str, value: str) -> DataFrame:
    """One row per key, as written and in upper case; the last sheet row wins."""
    pairs = entries.select(
        F.explode(keys).alias("_key"), F.col(value).alias("value"), F.col("row_no")
    )
    both = pairs.select(
        F.explode(F.array(F.col("_key"), F.upper("_key"))).alias("key"), "value", "row_no"
    )
    return both.groupBy("key").agg(F.max_by("value", "row_no").alias("value"))


def wiki_key_table(entries: DataFrame) -> DataFrame:
    return _key_table(entries, "wiki_keys", "identifier").withColumnRenamed("value", "identifier")


def jira_key_table(entries: DataFrame) -> DataFrame:
    return _key_table(entries, "jira_keys", "wiki_keys").withColumnRenamed("value", "wiki_keys")


def space_map(spaces: DataFrame, projects: DataFrame, entries: DataFrame | None) -> DataFrame:
    """Target project of each space: by mapping, lower key, cleaned key, else a new one.

    Each lookup table has one row per key. Catalyst broadcasts those it finds small.
    """
    known = projects.select(F.col("identifier").alias("_id")).distinct()
    keyed = spaces.select(
        "key",
        "name",
        F.upper("key").alias("_upper"),
        F.lower("key").alias("_lower"),
        identifier(F.col("key")).alias("_clean"),
        identifier(F.col("name")).alias("_from_name"),
    )
    if entries is None:
        mapped = keyed.withColumn("_mapped", F.lit(None).cast("string"))
    else:
        table = wiki_key_table(entries).where("identifier <> ''")
        exact = table.select(F.col("key"), F.col("identifier").alias("_exact"))
        upper = table.select(F.col("key").alias("_upper"), F.col("identifier").alias("_by_upper"))
        mapped = (
            keyed.join(exact, "key", "left")
            .join(upper, "_upper", "left")
            .withColumn("_mapped", F.coalesce("_exact", "_by_upper"))
        )

    def exists(df: DataFrame, column: str, flag: str, shared: bool = False) -> DataFrame:
        found = known.select(F.col("_id").alias(column), F.lit(True).alias(flag))
        joined = lookup(df, found, [column], ["key"]) if shared else df.join(found, column, "left")
        return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))

    # Many spaces may go to one mapped project; the other names come from the space's own key.
    checked = exists(mapped, "_mapped", "_has_mapped", shared=True)
    checked = exists(checked, "_lower", "_has_lower")
    checked = exists(checked, "_clean", "_has_clean")
    by_map = F.col("_mapped").isNotNull()
    return checked.select(
        "key",
        F.when(by_map, F.col("_mapped"))
        .when(F.col("_has_lower"), F.col("_lower"))
        .otherwise(F.coalesce("_clean", "_from_name"))
        .alias("identifier"),
        "name",
        F.when(by_map, F.col("_has_mapped"))
        .otherwise(F.col("_has_lower") | F.col("_has_clean"))
        .alias("exists"),
        F.when(by_map, F.lit("excel"))
        .when(F.col("_has_lower"), F.lit("exact_match"))
        .when(F.col("_has_clean"), F.lit("sanitized_match"))
        .otherwise(F.lit("new"))
        .alias("source"),
    )


def with_project(mapped: DataFrame) -> DataFrame:
    """Spaces whose project exists: only these are moved."""
    return mapped.where("`exists`")


def map_counts(mapped: DataFrame) -> DataFrame:
    return mapped.agg(
        F.count_if(F.col("exists")).alias("existing_projects"),
        F.count_if(~F.col("exists")).alias("new_projects"),
    )


def mapping_summary(entries: DataFrame) -> DataFrame:
    has_keys = F.size("wiki_keys") > 0
    counts = entries.agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(has_keys).alias("with_space"),
        F.count_if(~has_keys).alias("without_space"),
        F.coalesce(F.sum(F.size("wiki_keys")), F.lit(0)).alias("space_keys"),
    )

    def size(keys: str, name: str) -> DataFrame:
        written = entries.select(F.explode(keys).alias("_key"))
        both = written.select(F.explode(F.array(F.col("_key"), F.upper("_key"))).alias("_key"))
        return both.agg(F.count_distinct("_key").alias(name))

    # Three tables of one row each.
    return counts.join(size("wiki_keys", "wiki_mappings")).join(size("jira_keys", "jira_mappings"))


def resolve_keys(requested: DataFrame, entries: DataFrame, spaces: DataFrame) -> DataFrame:
    """For each requested key the spaces it stands for: its own, else those of its jira key.

    A key that leads nowhere keeps one row with a null space, as does a mapped key whose space
    is missing.
    """
    available = spaces.select(F.upper("key").alias("_upper"), F.col("key").alias("space"))
    available = available.groupBy("_upper").agg(F.max("space").alias("space"))
    asked = requested.select("key", F.upper("key").alias("_upper")).distinct()
    direct = asked.join(available, "_upper", "inner").select(
        "key", F.lit("space").alias("via"), F.lit(None).cast("string").alias("wiki_key"), "space"
    )
    rest = asked.join(available, "_upper", "left_anti")
    jira = jira_key_table(entries).withColumnRenamed("key", "_upper")
    named = rest.join(jira, "_upper", "left").select(
        "key", F.explode_outer("wiki_keys").alias("wiki_key")
    )
    by_jira = named.join(available, F.upper("wiki_key") == F.col("_upper"), "left").select(
        "key",
        F.when(F.col("wiki_key").isNull(), F.lit("none")).otherwise(F.lit("jira")).alias("via"),
        "wiki_key",
        "space",
    )
    return direct.unionByName(by_jira)


def resolved_keys(resolution: DataFrame) -> DataFrame:
    """The set of spaces found."""
    return resolution.where("space IS NOT NULL").select(F.col("space").alias("key")).distinct()


def unresolved_keys(resolution: DataFrame) -> DataFrame:
    """Requested keys without any space."""
    return (
        resolution.groupBy("key")
        .agg(F.count("space").alias("_found"))
        .where("_found = 0")
        .select("key")
    )


def requested_spaces(spaces: DataFrame, resolution: DataFrame) -> DataFrame:
    return spaces.join(resolved_keys(resolution), "key", "left_semi")


def project_plan(entries: DataFrame, projects: DataFrame) -> DataFrame:
    """Parents and subprojects to create, existing, or skipped.

    A parent is known by identifier, then by name. A parent without identifier cannot be created,
    and its subprojects are skipped. Of subprojects with one identifier the first is created.
    """
    by_id = projects.select(F.col("identifier"), F.col("id").alias("_by_id"))
    by_name = projects.groupBy(F.col("name")).agg(F.max("id").alias("_by_name"))
    parents = entries.groupBy(F.col("parent").alias("name")).agg(
        F.min("row_no").alias("row_no")
    ).withColumn("identifier", identifier(F.replace("name", F.lit(" "), F.lit("-"))))
    parents = (
        parents.join(by_id, "identifier", "left")
        .join(by_name, "name", "left")
        .select(
            F.lit("parent").alias("level"),
            "name",
            "identifier",
            F.lit(None).cast("string").alias("parent"),
            F.coalesce("_by_id", "_by_name").alias("project_id"),
            "row_no",
        )
        .withColumn(
            "action",
            F.when(F.col("project_id").isNotNull(), F.lit("exists"))
            .when(F.col("identifier").isNull(), F.lit("skip"))
            .otherwise(F.lit("create")),
        )
    )
    # Parents that are created come first, so their identifiers count as known.
    created_parents = parents.where("action = 'create'").select(
        "identifier", F.lit(True).alias("_is_parent")
    ).distinct()
    subs = entries.select(
        F.col("subproject").alias("name"),
        F.coalesce(identifier(F.col("identifier")), identifier(F.col("subproject"))).alias(
            "identifier"
        ),
        "parent",
        "row_no",
    ).where("identifier IS NOT NULL")
    parent_action = parents.select(
        F.col("name").alias("parent"), F.col("action").alias("_parent_action")
    )
    # A skipped subproject does not take its identifier from a later one.
    sub_rows = lookup(subs, parent_action, ["parent"], ["row_no"], "inner")
    first = (
        sub_rows.where("_parent_action <> 'skip'")
        .groupBy("identifier")
        .agg(F.min("row_no").alias("_first"))
    )
    known = (
        first.join(by_id, "identifier", "full")
        .join(created_parents, "identifier", "left")
    )
    subs = (
        lookup(sub_rows, known, ["identifier"], ["row_no"])
        .withColumn(
            "action",
            F.when(
                F.col("_by_id").isNotNull()
                | F.col("_is_parent").isNotNull()
                | (F.col("row_no") > F.col("_first")),
                F.lit("exists"),
            )
            .when(F.col("_parent_action") == "skip", F.lit("skip"))
            .otherwise(F.lit("create")),
        )
        .select(
            F.lit("subproject").alias("level"),
            "name",
            "identifier",
            "parent",
            F.col("_by_id").alias("project_id"),
            "row_no",
            "action",
        )
    )
    return parents.unionByName(subs)


def new_project_plan(mapped: DataFrame, projects: DataFrame) -> DataFrame:
    """Projects to create for spaces that have none, below one common parent."""
    # Fixed values
    parent_identifier, parent_name = "unmapped-confluence", "Unmapped Confluence Spaces"
    missing = mapped.where("NOT `exists`")
    children = missing.select(
        "identifier", "name", F.lit(parent_identifier).alias("parent"), F.lit("create").alias("action")
    )
    have = projects.where(F.col("identifier") == parent_identifier).select("identifier")
    parent = missing.limit(1).select(
        F.lit(parent_identifier).alias("identifier"),
        F.lit(parent_name).alias("name"),
        F.lit(None).cast("string").alias("parent"),
        F.lit("create").alias("action"),
    ).join(have, "identifier", "left_anti")
    return parent.unionByName(children)
