"""Names, comments and page texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog.registry import query, string, table, texts
from wikiloom.functions import keys
from wikiloom.markup import convert
from wikiloom.operators import requests
from wikiloom.operators.tree import CHILD_MACRO
from wikiloom.sources.export import repair_cdata

# White space and words as the library reads them.
_S = r"\s\x1c-\x1f\x85\p{Z}"
_TITLE_WORDS = (
    r"regexp_replace(trim(regexp_replace({}, '[^\p{{L}}\p{{N}}_" + _S.replace("{", "{{").replace("}", "}}")
    + r"-]', '', 'g'), e' \t\n\r'), '[" + _S.replace("{", "{{").replace("}", "}}") + r"]+', '_', 'g')"
)
_FINISH = (
    "CASE WHEN w = '' THEN 'Untitled' "
    r"ELSE left(CASE WHEN regexp_matches(w, '^\p{{N}}') THEN 'Page_' || w ELSE w END, 255) END"
).replace("{{", "{").replace("}}", "}")


@query(
    "p1_identifier",
    r"""SELECT doc_id, nullif(left(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}_-]', '', 'g'),
               100), '') AS identifier FROM documents""",
)
def p1(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "documents", "doc_id").select(
        "doc_id", keys.identifier(F.col("text")).alias("identifier")
    )


# A mark (character 1) in front of each number lets plain patterns tell the lengths apart.
_PADDED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({},
    '(\p{{Nd}}+)', chr(1) || '00\1', 'g'), chr(1) || '00(\p{{Nd}}{{3,}})', '\1', 'g'),
    chr(1) || '00(\p{{Nd}}\p{{Nd}})', '0\1', 'g'), chr(1), '', 'g')"""
_UNDOTTED = (
    r"regexp_replace(regexp_replace(strip_accents({}), '(\p{{Nd}})\.(\p{{Nd}})', '\1_\2', 'g'), "
    r"'(\p{{Nd}})\.(\p{{Nd}})', '\1_\2', 'g')"
)


def sql_title(text: str, key: str, source: str) -> str:
    """Columns ``key`` and the wiki title of ``text``."""
    padded = _PADDED.format(_TITLE_WORDS.format(_UNDOTTED.format(text)))
    return f"SELECT {key}, {_FINISH} AS wiki_title FROM (SELECT *, {padded} AS w FROM {source})"


@query(
    "p2_wiki_title",
    sql_title("doc_id % 100 || '.' || doc_id || '.7 ' || text", "doc_id", "documents"),
)
def p2(spark: SparkSession, sf: str) -> DataFrame:
    numbered = F.concat(
        (F.col("doc_id") % 100).cast("string"), F.lit("."), string("doc_id"), F.lit(".7 "), "text"
    )
    return texts(spark, sf, "documents", "doc_id").select(
        "doc_id", keys.wiki_title(numbered).alias("wiki_title")
    )


@query(
    "p3_wiki_title_plain",
    f"""SELECT doc_id, {_FINISH} AS wiki_title FROM (SELECT doc_id, {_TITLE_WORDS.format(
        "strip_accents(text)")} AS w FROM documents)""",
)
def p3(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "documents", "doc_id").select(
        "doc_id", keys.wiki_title_plain(F.col("text")).alias("wiki_title")
    )


@query(
    "p4_file_name",
    r"""SELECT doc_id, CASE WHEN s = '' THEN 'attachment' ELSE s END || '.png' AS filename
        FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_.-]', '_', 'g'),
                     '_+', '_', 'g'), '_') AS s FROM documents)""",
)
def p4(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "documents", "doc_id").select(
        "doc_id", keys.file_name(F.concat("text", F.lit(".png"))).alias("filename")
    )


@query("p13_cdata_repair", "SELECT doc_id, replace(text, '. ', '.]]>') AS body FROM documents")
def p13(spark: SparkSession, sf: str) -> DataFrame:
    damaged = F.replace("text", F.lit(". "), F.lit(".]] >"))
    return texts(spark, sf, "documents", "doc_id").select("doc_id", repair_cdata(damaged).alias("body"))


@query(
    "p14_comments",
    """SELECT conv_id, turn, 'v' || turn || '/9 by ' || role || ' (2024-01-01T10:11:12)' AS old,
              CASE WHEN role <> 'system' THEN 'Current version by ' || role || ' (2024-01-01T10:11:12)'
                END AS "current",
              'v' || turn || ' by ' || role || ' (2024-01-01T10:11:12)' AS export_version,
              'Migrated from Confluence — last edit by ' || role || ' (2024-01-01T10:11:12)'
                AS export_page FROM conversations""",
)
def p14(spark: SparkSession, sf: str) -> DataFrame:
    role, turn = F.col("role"), F.col("turn")
    when = F.lit("2024-01-01T10:11:12.345Z")
    named = F.when(role != "system", role)
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        convert.old_comment(turn, F.lit(9), role, when).alias("old"),
        convert.current_comment(named, when).alias("current"),
        convert.export_version_comment(turn, role, when).alias("export_version"),
        convert.export_page_comment(role, when).alias("export_page"),
    )


@query(
    "p15_page_text",
    """SELECT conv_id, turn, '# T' || conv_id || chr(10) || chr(10) ||
              CASE WHEN role = 'user' THEN text ELSE '*Empty page*' END ||
              CASE WHEN turn = 0 THEN chr(10) || chr(10) || '---' || chr(10) || chr(10) ||
                   '{{child_pages}}' || chr(10) ELSE '' END AS page,
              '# T' || conv_id || chr(10) || chr(10) ||
              CASE WHEN role = 'user' THEN text ELSE '*Empty version*' END || chr(10) || chr(10) ||
              '<!-- Confluence version ' || turn || '/9 -->' AS version FROM conversations""",
)
def p15(spark: SparkSession, sf: str) -> DataFrame:
    title = F.concat(F.lit("T"), string("conv_id"))
    text = F.when(F.col("role") == "user", F.col("text")).otherwise("")
    zero = F.concat(F.lit("\x00"), text)
    child = F.when(F.col("turn") == 0, F.lit(CHILD_MACRO))
    page = convert.page_text(title, F.when(text != "", zero).otherwise(""), child)
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        page.alias("page"),
        convert.version_text(title, text, F.col("turn"), F.lit(9)).alias("version"),
    )


@query(
    "p18_delays",
    """SELECT event_id, CASE WHEN value / 10 > 8 THEN 10.0::DOUBLE WHEN value / 10 > 3 THEN 5.0::DOUBLE
              ELSE 0.0::DOUBLE END AS throttle,
              CASE WHEN event_type = 'error' THEN 60.0::DOUBLE WHEN value / 10 > 8 THEN 30.0::DOUBLE
                   WHEN value / 10 > 3 THEN 10.0::DOUBLE ELSE 5.0::DOUBLE END AS probe FROM events""",
)
def p18(spark: SparkSession, sf: str) -> DataFrame:
    elapsed = F.col("value") / 10
    answered = F.when(F.col("event_type") != "error", elapsed)
    return table(spark, sf, "events").select(
        "event_id",
        requests.throttle_delay(elapsed).alias("throttle"),
        requests.probe_delay(answered).alias("probe"),
    )


@query("p19_fingerprint", "SELECT doc_id, left(md5(text), 12) AS fingerprint FROM documents")
def p19(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "documents", "doc_id").select(
        "doc_id", keys.fingerprint(F.col("text")).alias("fingerprint")
    )
