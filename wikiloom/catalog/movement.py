"""Exports, links and the plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import standins
from wikiloom.catalog.names import sql_title
from wikiloom.catalog.registry import query, string, table, texts, whole
from wikiloom.operators import links as link_ops
from wikiloom.operators import pages as page_ops
from wikiloom.plans import export as export_plan
from wikiloom.plans import site as site_plan
from wikiloom.scale import scratch_path, with_index
from wikiloom.sources import export, sinks

X, FILES = standins.SQL_EXPORT, standins.SQL_EXPORT_FILES


@query(
    "s10_export_objects",
    f"""SELECT class, id, (row_number() OVER (ORDER BY doc_id, class))::BIGINT AS place, body FROM (
          SELECT doc_id, 'BodyContent' AS class, 'b' || doc_id AS id, md5({standins.SQL_EXPORT_BODY}) AS body
          FROM documents
          UNION ALL SELECT doc_id, 'Page', 'c' || doc_id, NULL FROM documents)""",
)
def s10(spark: SparkSession, sf: str) -> DataFrame:
    body = F.get(F.filter("property", lambda p: p["_name"] == "body"), F.lit(0))["_VALUE"]
    objects = standins.export_text(spark, sf).select(
        "ord", F.col("_class").alias("class"), F.col("id._VALUE").alias("id"),
        F.md5(export.repair_cdata(body)).alias("body"),
    )
    placed = with_index(objects, ["ord"], "_at")
    return placed.select("class", "id", (F.col("_at") + 1).alias("place"), "body")


@query(
    "a11_objects_by_class",
    """SELECT e_type AS class, count(*) AS objects FROM (
         SELECT 'Page' AS e_type FROM conversations UNION ALL
         SELECT 'BodyContent' FROM conversations UNION ALL SELECT 'Attachment' FROM documents)
       GROUP BY e_type""",
)
def a11(spark: SparkSession, sf: str) -> DataFrame:
    return export.class_counts(standins.export_objects(spark, sf))


@query(
    "s11_export_pages",
    f"""SELECT id, 'Topic ' || conv_id || '.' || turn AS title, turn::INT AS version, status, parent_id,
               CASE WHEN NOT is_last THEN page_id END AS original_version_id, 'b' || id AS body_ids,
               position::INT AS position, '2024-01-0' || (turn + 1) || ' 10:00:00.000' AS modified,
               role AS modifier FROM ({X})""",
)
def s11(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_pages(standins.export_objects(spark, sf)).select(
        "id", "title", "version", "status", "parent_id", "original_version_id",
        F.array_join("body_content_ids", " ").alias("body_ids"), "position", "modified", "modifier",
    )


@query(
    "s12_export_bodies",
    f"""SELECT 'b' || id AS id, '<p>' || text || '</p>' AS body, id AS content_id,
               CASE WHEN role = 'user' THEN '2' ELSE '0' END AS body_type FROM ({X})""",
)
def s12(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_bodies(standins.export_objects(spark, sf)).drop("ord")


@query(
    "s13_export_attachments",
    f"""SELECT id, filename, content_id, version::INT AS version, content_status,
               n_chars::VARCHAR AS file_size
        FROM ({FILES}) f JOIN documents USING (doc_id)""",
)
def s13(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_attachments(standins.export_objects(spark, sf)).select(
        "id", "filename", "content_id", "version", "content_status", "file_size"
    )


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of the documents' files, in a different place per language."""
    documents = table(spark, sf, "documents")
    page = F.concat(F.lit("c"), F.floor(F.col("doc_id") / 10).cast("string"))
    att = F.concat(F.lit("a"), string("doc_id"))
    lang = F.col("lang")

    def path(*parts: Column | str) -> Column:
        return F.concat_ws("/", F.lit("/export/attachments"), *[F.lit(p) if isinstance(p, str) else p for p in parts])

    paths = (
        F.when(lang == "en", F.array(path(page, att, "1"), path(page, att, "2")))
        .when(lang == "fr", F.array(path(page, att, "9"), path(page, att, "10"), path(page, att, "x")))
        .when(lang == "es", F.array(path(page, att), path(page, att, "10")))
        .otherwise(F.array(path(att, "1"), path(page, att, "name"), path(att, "2")))
    )
    return documents.select(F.explode(paths).alias("path"), F.col("n_chars").alias("length"))


@query(
    "s14_bound_files",
    f"""SELECT id, '/export/attachments/' || CASE lang WHEN 'en' THEN content_id || '/' || id || '/1'
               WHEN 'fr' THEN content_id || '/' || id || '/10' WHEN 'es' THEN content_id || '/' || id
               ELSE id || '/1' END AS path FROM ({FILES})""",
)
def s14(spark: SparkSession, sf: str) -> DataFrame:
    attachments = export.export_attachments(standins.export_objects(spark, sf))
    return export.bind_files(attachments, _files(spark, sf)).select("id", "path")


_CURRENT = f"SELECT * FROM ({X}) WHERE is_last AND status = 'current'"


@query("p6_current_pages", f"SELECT id, 'Topic ' || conv_id || '.' || turn AS title FROM ({_CURRENT})")
def p6(spark: SparkSession, sf: str) -> DataFrame:
    pages = export.export_pages(standins.export_objects(spark, sf))
    return page_ops.current_pages(pages).select("id", "title")


@query("p7_kept_attachments", f"SELECT id, filename FROM ({FILES}) WHERE content_status <> 'deleted'")
def p7(spark: SparkSession, sf: str) -> DataFrame:
    attachments = export.export_attachments(standins.export_objects(spark, sf))
    return page_ops.kept_attachments(attachments).select("id", "filename")


@query("j6_body_links", f"SELECT id AS page_id, 'b' || id AS body_id FROM ({X})")
def j6(spark: SparkSession, sf: str) -> DataFrame:
    objects = standins.export_objects(spark, sf)
    pairs = page_ops.body_links(export.export_pages(objects), export.export_bodies(objects))
    return pairs.select("page_id", "body_id")


def _body_choice_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A conversation as a page with all its turns as bodies; the page lists the last turn first."""
    turns = table(spark, sf, "conversations")
    body_id = F.concat_ws("-", string("conv_id"), string("turn"))
    bodies = turns.select(
        body_id.alias("id"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("body"),
        F.when(F.col("turn") > 0, string("conv_id")).alias("content_id"),
        F.when(F.col("role") == "assistant", "2").otherwise("0").alias("body_type"),
        F.col("turn").alias("ord"),
    )
    pages = turns.groupBy(string("conv_id").alias("id")).agg(
        F.max("turn").alias("last"), F.min("turn").alias("first")
    ).select(
        "id",
        F.array(
            F.concat_ws("-", "id", F.col("last").cast("string")),
            F.concat_ws("-", "id", F.col("first").cast("string")),
            F.lit("gone"),
        ).alias("body_content_ids"),
    )
    return pages, bodies


@query(
    "p12_chosen_bodies",
    """WITH b AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN '' ELSE text END AS body,
                    CASE WHEN role = 'assistant' THEN 0 ELSE 1 END AS preference,
                    CASE WHEN turn > 0 THEN turn ELSE 1000 + turn END AS place FROM conversations)
       SELECT DISTINCT c.conv_id::VARCHAR AS page_id, coalesce(x.body, '') AS body
       FROM conversations c LEFT JOIN (
         SELECT conv_id, body, row_number() OVER (PARTITION BY conv_id ORDER BY preference, place) AS n
         FROM b WHERE body <> '') x ON x.conv_id = c.conv_id AND n = 1""",
)
def p12(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.chosen_bodies(*_body_choice_tables(spark, sf))


@query(
    "p11_body_choice",
    """SELECT conv_id * 100 + turn AS page_id, CASE WHEN role = 'user' THEN text
              WHEN turn % 4 = 1 THEN 'direct ' || text WHEN role = 'system' THEN '' ELSE text END AS body
       FROM conversations""",
)
def p11(spark: SparkSession, sf: str) -> DataFrame:
    key = (F.col("conv_id") * 100 + F.col("turn")).alias("page_id")
    turns = table(spark, sf, "conversations")
    empty, text = F.lit(""), F.col("text")
    listing = turns.select(
        key, empty.alias("view"), F.when(F.col("role") == "assistant", text).otherwise("").alias("storage")
    )
    historical = turns.select(
        key, F.when(F.col("role") == "user", text).otherwise("").alias("view"), empty.alias("storage")
    )
    direct = turns.where("turn % 4 = 1").select(
        key, empty.alias("view"), F.concat(F.lit("direct "), "text").alias("storage")
    )
    return page_ops.current_bodies(listing, historical, direct)


@query(
    "j7_attachments_of_pages",
    f"""SELECT f.id, f.content_id FROM ({FILES}) f JOIN ({_CURRENT}) p ON f.content_id = p.id""",
)
def j7(spark: SparkSession, sf: str) -> DataFrame:
    objects = standins.export_objects(spark, sf)
    pages = page_ops.current_pages(export.export_pages(objects))
    attachments = export.export_attachments(objects)
    return page_ops.attachments_of_pages(attachments, pages).select("id", "content_id")


@query(
    "j8_versions_of_pages",
    f"""SELECT page_id, id, turn::INT AS version, is_last AS current FROM ({X}) WHERE page_id IN (
          SELECT id FROM ({_CURRENT}))""",
)
def j8(spark: SparkSession, sf: str) -> DataFrame:
    return page_ops.versions_of_pages(export.export_pages(standins.export_objects(spark, sf)))


_HELD = f"SELECT id, content_id, filename FROM ({FILES}) WHERE content_status <> 'deleted'"


@query(
    "s15_manifest",
    f"""SELECT p.id, 'Topic ' || conv_id || '.' || turn AS title, parent_id, turn::INT AS version,
               (length(text) + 7)::INT AS body_length, coalesce(n, 0) AS attachment_count,
               coalesce(files, '') AS files
        FROM ({_CURRENT}) p LEFT JOIN (
          SELECT content_id, count(*) AS n, string_agg(id || '=' || filename, ' ' ORDER BY id) AS files
          FROM ({_HELD}) GROUP BY content_id) h ON h.content_id = p.id""",
)
def s15(spark: SparkSession, sf: str) -> DataFrame:
    """Written as JSON and read back."""
    objects = standins.export_objects(spark, sf)
    all_pages = export.export_pages(objects)
    bodies = page_ops.chosen_bodies(all_pages, export.export_bodies(objects))
    pages = page_ops.current_pages(all_pages).join(
        bodies.withColumnRenamed("page_id", "id"), "id"
    )
    kept = page_ops.kept_attachments(export.export_attachments(objects))
    rows = sinks.manifest(pages, kept)
    path = scratch_path(spark, "manifest")
    sinks.write_json(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    files = F.transform("attachments", lambda a: F.concat_ws("=", a["id"], a["filename"]))
    return back.select(
        "id", "title", "parent_id", "version", "body_length", "attachment_count",
        F.array_join(files, " ").alias("files"),
    )


# Links and images ------------------------------------------------------------------------------

LINKS = standins.SQL_LINKS


@query(
    "x2_page_links",
    f"""SELECT page_id, pos::INT AS pos, href, label, class,
               CASE WHEN class = 'page' THEN (page_id * 7 + 3)::VARCHAR END AS target_id FROM ({LINKS})""",
)
def x2(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.page_links(standins.linked_bodies(spark, sf))


@query(
    "x2_link_counts",
    f"SELECT page_id, class, count(*) AS links FROM ({LINKS}) GROUP BY page_id, class",
)
def x2_counts(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.link_counts(link_ops.page_links(standins.linked_bodies(spark, sf)))


def _languages(spark: SparkSession, sf: str) -> DataFrame:
    """Languages of the pages as spaces, each with a project."""
    pages = standins.site_pages(spark, sf)
    return pages.groupBy(F.col("space_key").alias("key")).agg(F.min("ord").alias("ord")).select(
        "key", F.concat(F.lit("p-"), "key").alias("identifier"), "ord"
    )


_MAP = sql_title("title", "id, 'p-' || space_key AS project", f"({standins.SQL_SITE_PAGES})")


def _seen_twice(spark: SparkSession, sf: str) -> DataFrame:
    """All pages, and once more as pages of the space that comes last, which must not win."""
    pages = standins.site_pages(spark, sf)
    return pages.unionByName(pages.withColumns({"title": F.lit("again"), "ord": F.col("ord") + 10**9}))


@query("j3_page_map", _MAP)
def j3(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.page_map(_seen_twice(spark, sf), _languages(spark, sf))


_RESOLVED = f"""
  SELECT l.page_id, l.pos::INT AS pos, label, h.project, t.wiki_title AS target_title,
         t.project AS target_project, CASE WHEN t.project IS NULL THEN 'unknown'
           WHEN t.project <> h.project THEN 'cross project' ELSE 'same project' END AS kind
  FROM ({LINKS}) l JOIN ({_MAP}) h ON h.id = l.page_id::VARCHAR
  LEFT JOIN ({_MAP}) t ON t.id = (l.page_id * 7 + 3)::VARCHAR WHERE class = 'page'"""


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    targets = link_ops.page_map(standins.site_pages(spark, sf), _languages(spark, sf))
    homes = targets.select(F.col("id").cast("long").alias("page_id"), "project")
    links = link_ops.page_links(standins.linked_bodies(spark, sf)).where("class = 'page'")
    held = links.join(homes, "page_id")
    return link_ops.resolved_links(held, targets).drop("href", "class", "target_id")


@query("j4_resolved_links", _RESOLVED)
def j4(spark: SparkSession, sf: str) -> DataFrame:
    return resolved(spark, sf)


@query(
    "flagship_link_resolution",
    f"""SELECT page_id, kind, count(*) AS links FROM ({_RESOLVED}) GROUP BY page_id, kind
        UNION ALL SELECT page_id, class, count(*) FROM ({LINKS}) WHERE class <> 'page'
        GROUP BY page_id, class""",
)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Links of all pages per page and kind, page links resolved over all spaces."""
    targets = link_ops.page_map(standins.site_pages(spark, sf), _languages(spark, sf))
    homes = targets.select(F.col("id").cast("long").alias("page_id"), "project")
    links = link_ops.page_links(standins.linked_bodies(spark, sf)).join(homes, "page_id", "left")
    to_pages = link_ops.resolved_links(links, targets)
    kind = F.when(F.col("class") == "page", F.col("kind")).otherwise(F.col("class"))
    return to_pages.groupBy("page_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("links"))


@query(
    "same_wiki_titles",
    f"""SELECT project, wiki_title, count(*) AS pages, min(id) AS first_id FROM ({_MAP})
        GROUP BY project, wiki_title HAVING count(*) > 1""",
)
def same_titles(spark: SparkSession, sf: str) -> DataFrame:
    targets = link_ops.page_map(standins.site_pages(spark, sf), _languages(spark, sf))
    return link_ops.same_titles(targets)


def image_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose relative links became images of the link's word, with blanks and queries."""
    number = string("page_id")
    image = F.concat(
        F.lit('<img src="/download/attachments/'), number, F.lit('/pic%20$2.png?version=1" alt="$2">'),
        F.lit('<img src="/download/thumbnails/'), number, F.lit('/pic $2.png">'),
    )
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("html", r'<a href="/([^"]*)">([\p{L}]+)[^<]*</a>', image).alias("body")
    )


_IMAGES = r"""
  SELECT DISTINCT page_id, 'pic_' || word || '.png' AS filename,
         '/download/attachments/' || page_id || '/pic%20' || word || '.png' AS url
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/[^"]*">(\p{L}+)[^<]*</a>', 1)) AS word
        FROM pages)"""


@query("x1_page_images", _IMAGES)
def x1(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.page_images(image_bodies(spark, sf))


def _held_images(spark: SparkSession, sf: str) -> DataFrame:
    """Attachments of the pages: the images with short names."""
    images = link_ops.page_images(image_bodies(spark, sf))
    return images.where(F.length("filename") < 11).select(
        "page_id", "filename", F.lit("image/png").alias("content_type"), F.lit(0).alias("ord")
    )


@query("j9_missing_images", f"SELECT * FROM ({_IMAGES}) WHERE length(filename) >= 11")
def j9(spark: SparkSession, sf: str) -> DataFrame:
    images = link_ops.page_images(image_bodies(spark, sf))
    return page_ops.missing_images(images, _held_images(spark, sf)).select("page_id", "filename", "url")


@query(
    "u1_uploads",
    f"""SELECT page_id, filename, CASE WHEN length(filename) < 11 THEN 'image/png'
               ELSE 'application/octet-stream' END AS content_type,
               CASE WHEN length(filename) < 11 THEN 'attachment' ELSE 'image' END AS origin,
               CASE WHEN length(filename) >= 11 THEN url END AS url FROM ({_IMAGES})""",
)
def u1(spark: SparkSession, sf: str) -> DataFrame:
    images = link_ops.page_images(image_bodies(spark, sf))
    return page_ops.uploads(_held_images(spark, sf), images)


def storage_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in storage form: macros, mentions and headings around the whole text."""
    body = F.concat(
        F.lit('<ac:structured-macro ac:name="toc"/><ac:structured-macro ac:name="src-'),
        F.col("lang"),
        F.lit('"><ac:parameter ac:name="a">1</ac:parameter></ac:structured-macro><h2>Part &amp; '),
        string("doc_id"),
        F.lit(".</h2><p>"),
        whole(F.col("text")),
        F.lit('</p><ac:link><ri:user ri:username="u'),
        string("doc_id"),
        F.lit('"/></ac:link><ac:link><ri:page ri:content-title="x"/></ac:link>'),
        F.lit('<a class="confluence-userlink user-mention" href="/u"> Ann '),
        F.col("source"),
        F.lit(' </a><ac:structured-macro ac:name="toc"></ac:structured-macro>'),
    )
    return texts(spark, sf, "documents", "doc_id").select(F.col("doc_id").alias("page_id"), body.alias("body"))


@query(
    "x3_page_macros",
    """SELECT doc_id AS page_id, 'toc' AS macro, 2::BIGINT AS uses FROM documents
       UNION ALL SELECT doc_id, 'src-' || lang, 1 FROM documents""",
)
def x3(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.page_macros(storage_bodies(spark, sf))


@query(
    "x4_page_mentions",
    """SELECT doc_id AS page_id, 0 AS pos, 'stored' AS form, 'u' || doc_id AS name FROM documents
       UNION ALL SELECT doc_id, 0, 'shown', 'Ann ' || source FROM documents""",
)
def x4(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.page_mentions(storage_bodies(spark, sf))


@query(
    "x5_page_headings",
    """SELECT doc_id AS page_id, 0 AS pos, 2 AS level, 'Part & ' || doc_id || '.' AS heading,
              'Part-' || doc_id AS anchor FROM documents""",
)
def x5(spark: SparkSession, sf: str) -> DataFrame:
    return link_ops.page_headings(storage_bodies(spark, sf))


# Plans -----------------------------------------------------------------------------------------


def site_tables(spark: SparkSession, sf: str) -> site_plan.SiteTables:
    """Conversations as pages with history: the last turn is current, the one before its parent."""
    turns = table(spark, sf, "conversations")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    conv = string("conv_id")
    pages = last.select(
        conv.alias("id"),
        F.concat(F.lit("Talk "), conv).alias("title"),
        F.when(F.col("conv_id") % 2 == 0, "AA").otherwise("BB").alias("space_key"),
        F.when(
            F.col("conv_id") > 1,
            F.array(
                F.struct(
                    (F.col("conv_id") - 2).cast("string").alias("id"), F.lit("t").alias("title")
                )
            ),
        ).alias("ancestors"),
        F.col("conv_id").alias("ord"),
    )
    versions = turns.select(conv.alias("page_id"), F.col("turn").cast("int").alias("number"))
    when = F.lit("2024-02-03T04:05:06.000Z").alias("when")
    body = F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("body")
    old = turns.select(
        conv.alias("page_id"), F.col("turn").cast("int").alias("number"), body,
        F.col("role").alias("author"), when,
    )
    current = turns.join(last, "conv_id").where("turn = last").select(
        conv.alias("page_id"), body, F.col("role").alias("author"), when
    )
    spaces = turns.select(
        F.when(F.col("conv_id") % 2 == 0, "AA").otherwise("BB").alias("key")
    ).distinct().select(
        "key", F.concat(F.lit("Space "), "key").alias("name"), F.lit("global").alias("type"),
        F.when(F.col("key") == "AA", 0).otherwise(1).cast("long").alias("ord"),
    )
    projects = spaces.select(
        F.lower("key").alias("identifier"), (F.col("ord") + 1).alias("id"), "name"
    )
    attachments = turns.where("role = 'system'").select(
        conv.alias("page_id"), F.lit("a b.png").alias("title"), F.lit("image/png").alias("media_type"),
        F.lit("/d").alias("download"), F.col("turn").alias("ord"),
    )
    return site_plan.SiteTables(
        spaces, projects, None, pages, versions, old, current, attachments
    )


_NO_TITLE = "'Talk_' || lpad({0}::VARCHAR, greatest(length({0}::VARCHAR), 3)::INT, '0')"
_PLAIN = r"""regexp_replace(regexp_replace(trim(text, e' \t\n\r'), '[ \t]+\n', e'\n', 'g'),
    '\n{{3,}}', e'\n\n', 'g')""".replace("{{", "{").replace("}}", "}")
_SITE = f"""
  WITH v AS (SELECT conv_id, turn, role, text, turn = max(turn) OVER (PARTITION BY conv_id) AS is_current,
               count(*) OVER (PARTITION BY conv_id) AS total FROM conversations),
  k AS (SELECT DISTINCT conv_id FROM conversations)
  SELECT lower(CASE WHEN conv_id % 2 = 0 THEN 'AA' ELSE 'BB' END) AS project,
         {_NO_TITLE.format("conv_id")} AS wiki_title,
         dense_rank() OVER (ORDER BY conv_id % 2, conv_id) - 1 AS push_ord,
         CASE WHEN NOT is_current THEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) END AS position,
         CASE WHEN NOT is_current THEN turn::INT END AS number, is_current,
         CASE WHEN is_current AND conv_id > 1 AND conv_id - 2 IN (SELECT conv_id FROM k)
              THEN {_NO_TITLE.format("(conv_id - 2)")} END AS parent_title,
         CASE WHEN is_current THEN 'Current version by ' || role || ' (2024-02-03T04:05:06)'
              ELSE 'v' || turn || '/' || total || ' by ' || role || ' (2024-02-03T04:05:06)' END
           AS comments,
         '# Talk ' || conv_id || chr(10) || chr(10) || {_PLAIN} || CASE
           WHEN NOT is_current THEN chr(10) || chr(10) || '<!-- Confluence version ' || turn || '/' ||
             total || ' -->'
           WHEN conv_id + 2 IN (SELECT conv_id FROM k) THEN chr(10) || chr(10) || '---' || chr(10) ||
             chr(10) || '{{{{child_pages}}}}' || chr(10) ELSE '' END AS text
  FROM v"""


@query("plan_site_revisions", _SITE)
def site_revisions(spark: SparkSession, sf: str) -> DataFrame:
    """The whole migration plan of a running wiki."""
    return site_plan.revisions(site_tables(spark, sf)).drop("page_id")


@query("s16_wiki_payload", _SITE)
def s16(spark: SparkSession, sf: str) -> DataFrame:
    """The plan, written by project and read back."""
    payload = site_plan.revisions(site_tables(spark, sf)).withColumnRenamed("push_ord", "ord")
    path = scratch_path(spark, "payload")
    sinks.write_payload(payload, path)
    return spark.read.parquet(path).drop("page_id").withColumnRenamed("ord", "push_ord")


@query(
    "plan_site_uploads",
    """SELECT DISTINCT conv_id::VARCHAR AS page_id, 'a_b.png' AS filename, 'image/png' AS content_type,
              'attachment' AS origin, NULL::VARCHAR AS url FROM conversations WHERE role = 'system'""",
)
def site_uploads(spark: SparkSession, sf: str) -> DataFrame:
    return site_plan.page_uploads(site_tables(spark, sf))


def _export(spark: SparkSession, sf: str) -> export_plan.ExportTables:
    return export_plan.load_export(standins.export_objects(spark, sf))


@query(
    "plan_export_uploads",
    f"""SELECT content_id AS page_id, id, CASE WHEN lang = 'es' THEN 't_' || doc_id || '.png'
               ELSE 'f_' || doc_id || '.' || lang END AS filename,
               'application/octet-stream' AS content_type, '/export/attachments/' || CASE lang
               WHEN 'en' THEN content_id || '/' || id || '/1'
               WHEN 'fr' THEN content_id || '/' || id || '/10' ELSE content_id || '/' || id END AS path
        FROM ({FILES}) WHERE content_status <> 'deleted'
          AND content_id IN (SELECT id FROM ({_CURRENT}))""",
)
def export_uploads(spark: SparkSession, sf: str) -> DataFrame:
    return export_plan.export_uploads(_export(spark, sf), _files(spark, sf))


_TOPIC = "'Topic_' || conv_id || turn"
_EXPORT = f"""
  WITH RECURSIVE c AS ({_CURRENT}),
  k AS (SELECT c.*, p.id AS known FROM c LEFT JOIN c p ON c.parent_id = p.id),
  links AS (SELECT known AS page_id, chr(10) || chr(10) || '---' || chr(10) || chr(10) ||
              '## Child pages' || chr(10) || chr(10) || string_agg('- [[' || {_TOPIC} || '|Topic ' ||
              conv_id || '.' || turn || ']]' || chr(10), '' ORDER BY position, conv_id) AS child_text
            FROM k WHERE known IS NOT NULL GROUP BY known),
  held AS (SELECT DISTINCT content_id AS page_id FROM ({_HELD})),
  v AS (SELECT x.*, row_number() OVER (PARTITION BY page_id ORDER BY is_last, turn) AS place,
               count(*) OVER (PARTITION BY page_id) AS total
        FROM ({X}) x WHERE page_id IN (SELECT id FROM c)),
  r AS (SELECT v.page_id, v.place, is_last, total, turn, role,
               '# Topic ' || v.conv_id || '.' || v.turn || chr(10) || chr(10) || {_PLAIN} ||
               coalesce(child_text, '') AS text FROM v LEFT JOIN links USING (page_id)),
  a AS (SELECT page_id, place AS position, text, is_last AS is_current,
               CASE WHEN total = 1 THEN 'Migrated from Confluence — last edit by ' || role || ' (2024-01-0'
                 || (turn + 1) || ' 10:00:00)' ELSE 'v' || turn || ' by ' || role || ' (2024-01-0' ||
                 (turn + 1) || ' 10:00:00)' END AS comments FROM r
        UNION ALL
        SELECT page_id, place + 1, text, TRUE, 'Final version with attachments' FROM r
        WHERE is_last AND total > 1 AND page_id IN (SELECT page_id FROM held)),
  t AS (SELECT id, conv_id, turn, known, 0 AS depth,
               [{{'p': position, 'u': coalesce(parent_id, '')}}] AS path FROM k
        WHERE known IS NULL
        UNION ALL
        SELECT k.id, k.conv_id, k.turn, k.known, t.depth + 1, list_append(t.path,
               {{'p': k.position, 'u': k.parent_id}})
        FROM t JOIN k ON k.known = t.id),
  o AS (SELECT *, row_number() OVER (ORDER BY depth, path) - 1 AS ord FROM t)
  SELECT a.page_id, 'Topic_' || o.conv_id || o.turn AS wiki_title, o.ord, a.position, a.text,
         CASE WHEN is_current AND p.id IS NOT NULL THEN 'Topic_' || p.conv_id || p.turn END
           AS parent_title, a.comments, is_current
  FROM a JOIN o ON o.id = a.page_id LEFT JOIN o p ON p.id = o.known"""


@query("plan_export_revisions", _EXPORT)
def export_revisions(spark: SparkSession, sf: str) -> DataFrame:
    """The whole import plan of an XML export."""
    return export_plan.export_revisions(_export(spark, sf))
