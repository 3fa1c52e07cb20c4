"""Conversion rules. Each rule runs over bodies that Spark builds around the whole texts of
the documents, so the expected text follows from the making and SQL can state it.

Templates hold ``{w}`` (the whole text on one line, escaped for HTML in a body and plain in what is
expected), ``{lines}`` (the same with its line breaks), ``{cell}`` (with bars escaped in what is
expected), ``{words}`` (its letters only), ``{id}`` (the document's number), ``{id3}`` (padded
to three digits), ``{raw}`` (the text as it is) and ``{lang}``. ``\\n`` is a line break.
"""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import movement, standins
from wikiloom.catalog.registry import SQL_LINED, SQL_WHOLE, SQL_WORDS, lined, query, string, texts, whole, words
from wikiloom.markup.convert import convert_pages, with_link_targets
from wikiloom.operators.links import page_map
from wikiloom.scale import landed

_FIELDS = {
    "w": (lambda: whole(F.col("text")), SQL_WHOLE),
    "lines": (lambda: lined(F.col("text")), SQL_LINED),
    "cell": (lambda: whole(F.col("text")), f"replace({SQL_WHOLE}, '|', '\\|')"),
    "words": (lambda: words(F.col("text")), SQL_WORDS),
    "id": (lambda: string("doc_id"), "doc_id::VARCHAR"),
    "id3": (
        lambda: F.lpad(string("doc_id"), F.greatest(F.length(string("doc_id")), F.lit(3)), F.lit("0")),
        "lpad(doc_id::VARCHAR, greatest(length(doc_id::VARCHAR), 3)::INT, '0')",
    ),
    "raw": (lambda: F.col("text"), "text"),
    "lang": (lambda: F.col("lang"), "lang"),
}
_FIELD = re.compile(r"\{(" + "|".join(_FIELDS) + r")\}")


def _filled(template: str) -> Column:
    parts = _FIELD.split(template)
    return F.concat(
        *[_FIELDS[p][0]() if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    )


def _sql(template: str) -> str:
    parts = _FIELD.split(template)
    pieces = [
        f"({_FIELDS[p][1]})" if i % 2 else "'" + p.replace("'", "''") + "'"
        for i, p in enumerate(parts)
        if i % 2 or p
    ]
    return " || ".join(pieces) or "''"


def rule(name: str, body: str, expected: str, fmt: str = "markdown", form: str = "site") -> None:
    """Register a query that converts ``body`` for every document."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        bodies = texts(spark, sf, "documents", "doc_id").select("doc_id", _filled(body).alias("body"))
        return convert_pages(bodies, fmt, form).select("doc_id", "text")

    query(name, f"SELECT doc_id, {_sql(expected)} AS text FROM documents")(run)


def macro(name: str, inner: str = "") -> str:
    return f'<ac:structured-macro ac:name="{name}">{inner}</ac:structured-macro>'


def par(name: str, value: str) -> str:
    return f'<ac:parameter ac:name="{name}">{value}</ac:parameter>'


def rich(content: str) -> str:
    return f"<ac:rich-text-body>{content}</ac:rich-text-body>"


def plain(content: str) -> str:
    return f"<ac:plain-text-body><![CDATA[{content}]]></ac:plain-text-body>"


def link(content: str, label: str | None = None) -> str:
    shown = "" if label is None else f"<ac:plain-text-link-body><![CDATA[{label}]]></ac:plain-text-link-body>"
    return f"<ac:link>{content}{shown}</ac:link>"


T, E = "textile", "export"

# Macros ----------------------------------------------------------------------------------------
rule("c1_self_closed_macro", 'a<ac:structured-macro ac:name="children" />{lines}', "a\n\n{{child_pages}}\n\n{lines}")
rule("c2_toc", "a" + macro("toc", par("maxLevel", "2")) + "{lines}", "a\n\n{{toc}}\n\n{lines}")
rule("c2_toc_export", "a" + macro("toc") + "{lines}", "a\n{{>toc}}\n{lines}", form=E)
rule(
    "c3_anchor",
    "{lines} " + macro("anchor", par("", " p{id} ")) + "z",
    '{lines} <a name="p{id}" id="p{id}"></a>z',
)
rule("c3_anchor_export", "{lines} " + macro("anchor", par("", "p")) + "z", "{lines} z", form=E)
rule(
    "c4_include",
    macro("include", '<ri:page ri:space-key="ABC" ri:content-title="Tïtle {id}"/>') + "{lines}"
    + macro("excerpt-include", '<ri:page ri:content-title="T {id}.5"/>'),
    "{{include(abc:Title_{id3})}}\n{lines}\n{{include(T_{id3}_005)}}",
)
rule(
    "c4_include_export",
    macro("include", '<ri:page ri:content-title="T {id}"/>') + "{lines}",
    "> *Included from:* [[T_{id}|T {id}]]\n{lines}",
    form=E,
)
rule("c5_excerpt", "a " + macro("excerpt", rich("{lines}")) + " z", "a {lines} z")
_CODE = macro("code", par("language", "Py") + par("title", "T {id}") + plain("{raw}"))
rule("c6_code", "a" + _CODE + "z", "a\n**T {id}**\n```python\n{raw}\n```\nz")
rule(
    "c6_code_textile",
    "a" + _CODE + "z",
    'a\n**T {id}**\n<pre><code class="python">\n{raw}\n</code></pre>\nz',
    fmt=T,
)
rule("c6_code_export", "a" + _CODE + "z", "a\n```Py\n{raw}\n```\nz", form=E)
rule("c6_noformat", "a" + macro("noformat", plain("{raw}")) + "z", "a\n```\n{raw}\n```\nz")
_FILE = '<ri:attachment ri:filename="my file {id}.pdf"/>'
rule("c7_view_file", macro("view-file", _FILE) + "{lines}", "[my file {id}.pdf](my_file_{id}.pdf)\n{lines}")
rule("c7_view_file_textile", macro("view-file", _FILE) + "{lines}", 'attachment:"my_file_{id}.pdf"\n{lines}', fmt=T)
rule("c7_view_file_export", macro("view-file", _FILE) + "{lines}", "[📎 my file {id}.pdf](my_file_{id}.pdf)\n{lines}", form=E)
rule(
    "c8_multimedia",
    macro("multimedia", par("url", "https://www.youtube.com/watch?v=ab_{id}") + par("width", "300")) + "{lines}"
    + macro("multimedia", par("url", "https://vimeo.com/{id}"))
    + macro("multimedia", par("URL", "https://docs.google.com/{id}") + par("height", "50"))
    + macro("multimedia", par("url", "https://e.org/{id}")) + macro("multimedia", _FILE),
    "{{youtube(ab_{id}, width=300, height=360)}}\n{lines}\n{{vimeo({id}, width=640, height=360)}}\n\n"
    "{{google_docs(https://docs.google.com/{id}, width=100%, height=50)}}\n\n"
    "{{iframe(https://e.org/{id}, width=640, height=360)}}\n\n![my file {id}.pdf](my_file_{id}.pdf)",
)
rule("c8_multimedia_export", macro("multimedia", _FILE) + "{lines}", "[🎬 my file {id}.pdf](my_file_{id}.pdf)\n{lines}", form=E)
rule(
    "c9_widget",
    macro("widget", par("url", "https://youtu.be/x{id}")) + "{lines}" + macro("widget", par("url", "https://e.org")),
    "{{youtube(x{id}, width=640, height=360)}}\n{lines}\n{{iframe(https://e.org, width=640, height=360)}}",
)
rule(
    "c10_api_docs",
    macro("swagger", par("specUrl", "https://e.org/{id}")) + "{lines}" + macro("openapi"),
    "**API Documentation (Swagger/OpenAPI)**\n{{iframe(https://e.org/{id}, width=100%, height=600)}}\n{lines}\n"
    "> **API Documentation (Swagger/OpenAPI)** -- *embedded content not migrated*",
)
rule(
    "c10_api_docs_export",
    macro("swagger", par("url", "https://e.org/{id}")) + "{lines}" + macro("open-api"),
    "> 📋 **API Documentation (Swagger/OpenAPI)**\n> URL: [https://e.org/{id}](https://e.org/{id})\n{lines}\n"
    "> 📋 **API Documentation (Swagger/OpenAPI)** — *embedded content not migrated*",
    form=E,
)
rule(
    "c11_expand",
    macro("expand", par("title", "More {id}") + rich("{lines}")) + macro("expand", rich("b")),
    "{{collapse(More {id})\n{lines}\n}}\n\n{{collapse(Details)\nb\n}}",
)
rule("c11_expand_export", macro("expand", par("title", "M") + rich("{lines}")), "**▸ M**\n{lines}", form=E)
rule(
    "c11_nested_macros",
    macro("expand", rich("<p>a</p>" + macro("expand", rich(macro("info", rich("<p>{w}</p>")) + macro("code", plain("{raw}")))))),
    "{{collapse(Details)\n\na\n\n{{collapse(Details)\n\n> **INFO**\n> {w}\n\n```\n{raw}\n```\n\n}}\n\n}}",
)
rule(
    "c12_columns",
    macro("section", rich(macro("column", rich(" {w} ")) + "\n" + macro("column", rich("c{id}"))))
    + macro("column", rich("alone")),
    "{w}\n\n---\n\nc{id}\n\nalone",
)
rule(
    "c13_status",
    "{lines}" + macro("status", par("colour", "Green") + par("title", "OK {id}")) + macro("status", par("colour", "Odd")),
    '{lines} <span style="background:#00875A;color:#fff;padding:1px 6px;border-radius:3px;font-size:0.85em">'
    "OK {id}</span>  **Status**",
)
rule(
    "c13_status_textile",
    "{lines}" + macro("status", par("colour", "Red") + par("title", "No")),
    "{lines} %{background:#DE350B;color:#fff;padding:1px 6px;border-radius:3px}No%",
    fmt=T,
)
rule(
    "c14_panels",
    macro("info", par("title", "T{id}") + rich("<p>{w}</p><p>b</p>")) + macro("tip", rich("c")),
    "> **INFO: T{id}**\n> {w} b\n\n> **TIP**\n> c",
)
rule("c14_panels_export", macro("warning", rich("<p>{w}</p>")), "> ⚠️ **Warning**\n> {w}", form=E)
rule("c15_children", "{lines}" + macro("children") + "z", "{lines}\n\n{{child_pages}}\n\nz")
rule("c15_children_export", "{lines}" + macro("children") + "z", "{lines}\n*See child pages in the sidebar.*\nz", form=E)
rule("c16_dynamic_lists", "{lines}" + macro("recently-updated", par("a", "b")) + macro("user-list") + "z", "{lines}z")
rule(
    "c16_dynamic_lists_export",
    "{lines}" + macro("recently-updated") + macro("profile"),
    "{lines}\n*Recently updated pages — see sidebar for navigation.*\n\n*Contributors information — not migrated.*",
    form=E,
)
rule(
    "c17_jira",
    macro("jira", par("key", "AB-{id}")) + " {lines}" + macro("jira", par("jqlQuery", "x = {id}"))
    + macro("jira", par("server", "s")) + macro("jira"),
    "`AB-{id}` {lines}\n*Jira query: `x = {id}`*\n\n*Jira issue list -- not migrated*",
)
rule("c17_jira_export", macro("jira", par("key", "AB-{id}")) + " {lines}", "`AB-{id}` {lines}", form=E)
rule(
    "c18_diagrams",
    macro("drawio", par("diagramName", "D{id}")) + "{lines}" + macro("gliffy"),
    "> **Diagram (drawio):** D{id}\n> *Embedded diagram not migrated — see original Confluence page*\n{lines}\n"
    "> **Diagram (gliffy)** — *embedded diagram not migrated*",
)
rule("c19_roadmap", "{lines}" + macro("roadmap"), "{lines}\n> *Calendar/Roadmap macro — not migrated*")
rule("c20_details", "a " + macro("details", rich("{lines}")) + macro("page-info", rich(" b")), "a {lines} b")
rule("c21_other_macro", "a" + macro("odd-{lang}", rich("gone")) + "{lines}", "a<!-- Confluence macro: odd-{lang} -->{lines}")
rule("c21_other_macro_export", "a" + macro("odd", rich("x")) + "{lines}", "a<!-- Confluence macro: odd -->{lines}", form=E)

# Images, links, emoticons ------------------------------------------------------------------------
_PICTURE = '<ac:image ac:alt="q"><ri:attachment ri:filename="a {id}.png"/></ac:image>'
rule(
    "c22_images",
    _PICTURE + "{lines}" + '<ac:image><ri:url ri:value="http://e.org/{id}.png"/></ac:image>',
    "![a_{id}.png](a_{id}.png)\n{lines}\n![](http://e.org/{id}.png)",
)
rule("c22_images_textile", _PICTURE + "{lines}", "!a_{id}.png!\n{lines}", fmt=T)
rule("c22_images_export", _PICTURE + "{lines}", "![a {id}.png](a_{id}.png)\n{lines}", form=E)
_WRAPPED = (
    '<p><span class="confluence-embedded-file-wrapper x"> <img src="/download/thumbnails/1/u%20{id}.png?v=1" {}> '
    "</span></p>"
)
rule(
    "c23_wrapped_images",
    _WRAPPED.replace("{}", 'data-linked-resource-default-alias="al {id}.png"') + "{lines}" + _WRAPPED.replace("{}", ""),
    "![al_{id}.png](al_{id}.png)\n\n{lines}\n\n![u_{id}.png](u_{id}.png)",
)
rule(
    "c24_attachment_links",
    link(_FILE, "see {id}") + "{lines}" + link(_FILE),
    "[see {id}](my_file_{id}.pdf) {lines} [my file {id}.pdf](my_file_{id}.pdf)",
)
rule("c24_attachment_links_textile", "{lines}" + link(_FILE, "see"), '{lines} attachment:"my_file_{id}.pdf"', fmt=T)
_PAGE = '<ri:page ri:content-title="Älpha {id}.2"/>'
rule(
    "c25_page_links",
    link(_PAGE, "{w}") + " " + link('<ri:page ri:space-key="XY" ri:content-title="B {id}"/>')
    + ' <ac:link ac:anchor="s{id}"><ri:page ri:content-title="C"/></ac:link>',
    "[[Alpha_{id3}_002|{w}]] {{wiki(xy, B_{id3}, B {id})}} [[C#s{id}|C]]",
)
rule("c25_page_links_export", link(_PAGE, "{w}"), "[[Alpha_{id}2|{w}]]", form=E)
rule(
    "c26_anchor_links",
    '<ac:link ac:anchor="s{id}"><ac:link-body><b>{w}</b></ac:link-body></ac:link> '
    '<ac:link ac:anchor="t"></ac:link>',
    "[{w}](#s{id}) [t](#t)",
)
rule(
    "c27_other_links",
    link('<ri:url ri:value="http://e.org/{id}"/>', "{w}") + " " + link('<ri:space ri:space-key="KEY"/>')
    + " <ac:link><ac:link-body>plain</ac:link-body></ac:link>",
    "[{w}](http://e.org/{id}) [[key:]] plain",
)
rule("c27_other_links_textile", link('<ri:url ri:value="http://e.org/{id}"/>', "{w}"), '"{w}":http://e.org/{id}', fmt=T)
rule("c27_other_links_export", link('<ri:url ri:value="http://e.org/{id}"/>', "{w}"), "[{w}](http://e.org/{id})", form=E)
rule(
    "c28_stored_mentions",
    "{lines} <ac:link><ri:user ri:userkey=\"k\"/><ac:link-body>Ann {id}</ac:link-body></ac:link> "
    + link('<ri:user ri:username="u{id}"/>') + " " + link('<ri:user ri:userkey="k"/>'),
    "{lines} @Ann {id} @u{id} @user",
)
rule(
    "c29_emoticons",
    '{lines} <ac:emoticon ac:name="tick"/><ac:emoticon ac:name="broken_heart" /><ac:emoticon ac:name="o{id}"/>',
    "{lines} {{fa(check-circle, color=green)}}{{fa(heart-broken, color=red)}}[o{id}]",
)
rule("c29_emoticons_export", '{lines} <ac:emoticon ac:name="cross"/><ac:emoticon ac:name="o{id}"/>', "{lines} ❌[o{id}]", form=E)
rule("c30_leftover_tags", '<ac:layout><ac:x y="{id}"/>{lines}<ri:z></ac:layout>', "{lines}")

# Plain HTML --------------------------------------------------------------------------------------
rule("c31_font_colours", '<font color="#f00" size="2">{lines}</font><font>b</font>', '<span style="color:#f00">{lines}</span>b')
rule("c31_colours_export", '<span style="color: red;">{lines}</span>', "{lines}", form=E)
rule(
    "c32_tables",
    '<table class="wrapped confluenceTable" data-x="{id}"><tr><td class="confluenceTd">{w}</td></tr></table>',
    "<table><tr><td>{w}</td></tr></table>",
)
rule(
    "c32_pipe_tables",
    "<table><tr><th>A</th><th><b>B</b></th><th>C</th></tr><tr></tr><tr><td>{cell}<br/>x|{id}</td><td><em>e</em></td></tr></table>",
    "| A | **B** | C |\n| --- | --- | --- |\n| {cell} x\\|{id} | *e* |  |",
    form=E,
)
rule(
    "c32_nested_tables",
    "<table><tr><th>{w}</th><th>x<table><tr><td>y|{id}</td><td><b>v</b></td></tr></table></th></tr>"
    "<tr><td><table><tr><td><table><tr><td>deep</td></tr></table></td></tr></table></td><td>z</td></tr></table>"
    "<table><tr><td>alone</td></tr></table>",
    "| {cell} | x y\\|{id} **v** |\n| --- | --- |\n| deep | z |\n\n| alone |\n| --- |",
    form=E,
)
rule("c34_headings", "<h1>{w}</h1><h3 id=\"x\">b {id}</h3>c", "# {w}\n\n### b {id}\nc")
rule("c34_headings_textile", "<h1>{w}</h1><h6>b {id}</h6>c", "h1. {w}\n\nh6. b {id}\nc", fmt=T)
_BOLD = "x<strong> {w}\n b </strong>y<b>1</b><b>2</b><br/><em>i <span>j</span></em><i> </i>z ** ** *"
rule("c35_bold_italic", _BOLD, "x **{w} b** y**1** **2**\n*i j* z ** ** *")
rule("c35_bold_italic_textile", _BOLD, "x *{w} b* y*1**2*\n_i j_ z ** ** *", fmt=T)
rule("c36_strikes", "<del>{lines}</del> <s>b</s> <u>u</u><span>c</span>", "~~{lines}~~ ~~b~~ <u>u</u>c")
rule("c36_strikes_textile", "<del>{lines}</del> <s>b</s> <u>u</u>", "-{lines}- -b- +u+", fmt=T)
rule("c36_strikes_export", "<del>{lines}</del> <s>b</s> <u>u</u>", "~~{lines}~~ ~~b~~ u", form=E)
_PRE = '<pre class="p"><code class="java">{w} &lt; &amp;\n\n\n\n<i>x</i></code></pre><pre>q</pre><code>a  b</code>'
rule("c37_code_blocks", _PRE, "```\n{w} < &\n\n\n\nx\n```\n\n```\nq\n```\n`a  b`")
rule(
    "c37_code_blocks_textile",
    _PRE,
    '<pre><code class="java">\n{w} < &\n\n\n\nx\n</code></pre>\n\n<pre>\nq\n</pre>\n`a  b`',
    fmt=T,
)
rule(
    "c38_shown_mentions",
    '{lines} <a class="confluence-userlink x" data-username="u{id}" href="/u"><b></b></a> '
    '<a href="/v" class="confluence-userlink">Ann {id}</a>',
    "{lines} @u{id} @Ann {id}",
)
rule(
    "c39_shown_images",
    '<img src="/download/attachments/12/a%20{id}.png?x=1">{lines}<img alt="q" src="http://e.org/{id}.png"/>'
    '<img src="/download/attachments/1/x.png" data-linked-resource-default-alias="al {id}.png">',
    "![a_{id}.png](a_{id}.png)\n\n{lines}![q](http://e.org/{id}.png)\n\n![al_{id}.png](al_{id}.png)",
)
rule("c39_shown_images_textile", '{lines}<img src="http://e.org/{id}.png"/>', "{lines}!http://e.org/{id}.png!", fmt=T)
rule("c39_shown_images_export", '<img src="http://e.org/{id}.png" alt="q"/>{lines}<img src="b">', "![q](http://e.org/{id}.png){lines}![](b)", form=E)
_LIST = (
    '<ul><li><b>{lines}</b><ol start="4"><li><p>b {id}</p></li><li>5. c</li></ol></li>'
    '<li class="checked">d</li><li class="unchecked">e</li></ul>tail'
)
rule("c40_lists", _LIST, "- **{w}**\n   4. b {id}\n   5. c\n- [x] d\n- [ ] e\n\ntail")
rule("c40_lists_textile", _LIST, "* *{w}*\n## b {id}\n## c\n* d\n* e\n\ntail", fmt=T)
rule(
    "c40_lists_export",
    "<ul><li>{w}</li><li><b>b</b> {id}</li></ul><ol><li>c</li><li>d</li></ol>",
    "- {w}\n- **b** {id}\n\n1. c\n2. d",
    form=E,
)
_MIXED = (
    "<ol start=\"8\"><li>{w}<ul><li>b {id}<ol><li>3) c</li><li>d<pre>1\n 2</pre></li></ol>e</li></ul></li>"
    "<li class=\"checked\">f</li></ol><ul><li>g<ol><li>h</ul>i<ul><li>j</ul></ul>"
)
rule(
    "c40_mixed_lists",
    _MIXED,
    "8. {w}\n   - b {id}e\n      1. c\n      2. d\n         ```\n         1\n          2\n         ```\n- [x] f\n\n"
    "- g\n- h\n\ni\n- j",
)
rule(
    "c40_mixed_lists_export",
    _MIXED,
    "8. {w}\n   - b {id}e\n      1. c\n      2. d\n         ```\n         1\n          2\n         ```\n- [x] f\n\n"
    "- g\n- h\n\ni\n- j",
    form=E,
)
rule("c41_paragraphs", "<p>a</p><p class=\"x\">{lines}</p>b<br/>c<hr />d", "a\n\n{lines}\nb\nc\n---\nd")
rule("c42_definitions", "<dl><dt>t{id}</dt> <dd><i>{w}</i></dd><dt>u</dt><dd>v</dd></dl>z", "**t{id}**: *{w}*\n\n**u**: v\n\nz")
rule("c42_definitions_textile", "<dl><dt>t{id}</dt><dd>{w}</dd></dl>z", "- *t{id}*: {w}\nz", fmt=T)
rule("c43_quotes", "a<blockquote><p>{w}</p><p>b</p></blockquote>z", "a\n> {w}\n> b\nz")
rule(
    "c43_nested_quotes",
    "<blockquote><p>{w}</p><blockquote>b<br/>c<blockquote>{id}</blockquote></blockquote>d"
    "<pre>1\n 2</pre></blockquote>z",
    "> {w}\n> > b\n> > c\n> > > {id}\n> d\n> ```\n> 1\n>  2\n> ```\nz",
)
rule(
    "c44_other_tags",
    '<div><article>{lines}</article></div><span style="x:1">s<span>t</span></span><span class="q">v</span><!-- c -->',
    '{lines}<span style="x:1">st</span>v',
)
rule("c44_other_tags_export", '<div>{lines}</div><span style="x:1">s</span><!-- c -->', "{lines}s", form=E)
rule("c45_entities", "{lines} &amp;amp; &eacute;&#233;&#x41;&lt;b&gt;&copy;", "{lines} &amp; ééA<b>©")
rule("c45_entities_export", "{lines} &amp; &eacute;&lt;b&gt;", "{lines} & é<b>", form=E)
_NAMES = sorted(html5)
_CHARS = "([" + ", ".join("'" + html5[n].replace("'", "''") + "'" for n in _NAMES) + f"])[1 + doc_id % {len(_NAMES)}]"


@query("c45_named_entities", f"SELECT doc_id, 'x' || {_CHARS} || 'z ' || {SQL_WHOLE} || '.' AS text FROM documents")
def c45_named(spark: SparkSession, sf: str) -> DataFrame:
    """Every name of an entity, one per document."""
    names = F.from_json(F.lit(json.dumps(["&" + n for n in _NAMES])), "array<string>")
    name = F.get(names, (F.col("doc_id") % len(_NAMES)).cast("int"))
    body = F.concat(F.lit("x"), name, F.lit("z "), whole(F.col("text")), F.lit("."))
    bodies = texts(spark, sf, "documents", "doc_id").select("doc_id", body.alias("body"))
    return convert_pages(bodies).select("doc_id", "text")


rule("c46_issue_numbers", "#{id} {lines}\n  #7\n# head\n##8", "\\#{id} {lines}\n  \\#7\n# head\n##8")
rule("c46_issue_numbers_export", "#{id} {lines}\n# head", "\\#{id} {lines}\n# head", form=E)
rule("c47_empty_emphasis", "{w}<b><i></i></b><b>a</b><b>b</b> lit ****", "{w}**a** **b** lit ****")
rule("c48_blank_lines", "<p> {lines}  </p>\n\n\n\n<p>b\t</p> ", "{lines}\n\nb")
rule("c49_dialect", "<h2>{w}</h2><p><strong>b</strong> <em>i</em> <del>d</del></p>", "h2. {w}\n\n*b* _i_ -d-", fmt=T)


# C33 and whole pages ---------------------------------------------------------------------------


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    """Links of every class around the words; page ids lead to given pages or nowhere."""
    body = _filled(
        '<a href="/pages/viewpage.action?pageId={id}">{words}</a> <a href="#s">Head &amp; {id}</a> '
        '<a href="/display/EN/My+Page%20{id}?x=1">d</a> <a href="/display/zz/T">e</a> '
        '<a href="/rel/{id}">rel</a> <a href="//e.org">f</a> <a href="http://e.org/{id}"></a>'
    )
    bodies = texts(spark, sf, "documents", "doc_id").select(
        "doc_id", body.alias("body"), F.lit("p-en").alias("project")
    )
    spaces = movement._languages(spark, sf)
    targets = page_map(standins.site_pages(spark, sf), spaces)
    return with_link_targets(landed(bodies, "bodies"), ["doc_id"], targets, spaces)


def _links_sql(textile: bool) -> str:
    def made(label: str, href: str) -> str:
        return f"'\"' || {label} || '\":' || {href}" if textile else f"'[' || {label} || '](' || {href} || ')'"

    w = SQL_WORDS
    return f"""
      SELECT doc_id, CASE WHEN t.project IS NULL THEN '[[' || replace(left(w, 255), ' ', '_') || '|' || w || ']]'
               WHEN t.project <> 'p-en' THEN '{{{{wiki(' || t.project || ', ' || t.wiki_title || ', ' || w || ')}}}}'
               ELSE '[[' || t.wiki_title || '|' || w || ']]' END || ' ' ||
             {made("'Head & ' || doc_id", "'#Head-' || doc_id")} || ' ' ||
             '{{{{wiki(p-en, My_Page_' || {_FIELDS['id3'][1]} || ', d)}}}} {{{{wiki(zz, T, e)}}}} rel ' ||
             {made("'f'", "'//e.org'")} || ' ' || {made("'http://e.org/' || doc_id", "'http://e.org/' || doc_id")}
             AS text
      FROM (SELECT doc_id, {w} AS w0, {w} AS shown, strip_accents({w}) AS folded FROM documents) d
      LEFT JOIN ({movement._MAP}) t ON t.id = d.doc_id::VARCHAR""".replace(
        "replace(left(w, 255), ' ', '_')", "left(replace(folded, ' ', '_'), 255)"
    ).replace("|| w ||", "|| shown ||")


@query("c33_links", _links_sql(False))
def c33(spark: SparkSession, sf: str) -> DataFrame:
    return convert_pages(_linked(spark, sf)).select("doc_id", "text")


@query("c33_links_textile", _links_sql(True))
def c33_textile(spark: SparkSession, sf: str) -> DataFrame:
    return convert_pages(_linked(spark, sf), "textile").select("doc_id", "text")


rule("c33_links_export", '<a class="x" href="/r/{id}">{w}</a>', "[{w}](/r/{id})", form=E)


_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
# The rules that the given pages can meet, one after the other. Their links all stand in one list.


def _page_sql(listing: str, heading: str, html: str = "html", source: str = "pages") -> str:
    """Text of whole pages, ``listing`` being the lines of the link list per page."""
    clean_up = [
        "replace(replace(replace(%s, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')",
        "regexp_replace(%s, '&amp;?', '&', 'g')",
        r"regexp_replace(%s, '\n\n\n+', chr(10) || chr(10), 'g')",
        r"regexp_replace(%s, '[ \t]+\n', chr(10), 'g')",
        rf"regexp_replace(%s, '^{_SPACE}+|{_SPACE}+$', '', 'g')",
    ]
    text = (
        rf"regexp_replace({html}, '(?s)<nav><ul>.*?</ul></nav>', chr(1))"
    )
    text = rf"regexp_replace({text}, '(?s)<h1>(.*?)</h1>', chr(10) || '{heading} ' || '\1' || chr(10), 'g')"
    text = rf"regexp_replace({text}, '</?p>|<br>', chr(10), 'g')"
    text = rf"regexp_replace({text}, '<[^>]+>', '', 'g')"
    text = f"replace({text}, chr(1), coalesce(chr(10) || items || chr(10), ''))"
    for step in clean_up:
        text = step % text
    return f"SELECT p.page_id, {text} AS text FROM {source} p LEFT JOIN ({listing}) USING (page_id)"


def _link_title(text: str) -> str:
    kept = rf"trim(regexp_replace(strip_accents({text}), '[^\p{{L}}\p{{N}}_\s-]', '', 'g'))"
    words_of = rf"regexp_replace({kept}, '\s+', '_', 'g')"
    return f"CASE WHEN {words_of} = '' THEN 'Untitled' ELSE left({words_of}, 255) END"


_SHOWN = "replace(label, '&amp;', '&')"
_MARKDOWN_LINK = f"""CASE class
  WHEN 'page' THEN CASE WHEN t.project IS NULL THEN '[[' || {_link_title(_SHOWN)} || '|' || {_SHOWN} || ']]'
    WHEN t.project <> 'p-en' THEN '{{{{wiki(' || t.project || ', ' || t.wiki_title || ', ' || {_SHOWN} || ')}}}}'
    ELSE '[[' || t.wiki_title || '|' || {_SHOWN} || ']]' END
  WHEN 'anchor' THEN '[' || {_SHOWN} || '](#' || trim(regexp_replace(regexp_replace({_SHOWN},
    '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g'), '\\s+[\\s-]*', '-', 'g'), '-') || ')'
  WHEN 'display' THEN '{{{{wiki(p-en, ' || {_link_title("replace(substr(href, 13), '+', ' ')")} || ', ' ||
    {_SHOWN} || ')}}}}'
  WHEN 'external' THEN '[' || {_SHOWN} || '](' || href || ')' ELSE {_SHOWN} END"""
_MARKDOWN_LINK = _MARKDOWN_LINK.replace("\\\\", "\\")
_LINKS_TO = f"""SELECT l.*, t.wiki_title, t.project FROM ({standins.SQL_LINKS}) l
  LEFT JOIN ({movement._MAP}) t ON t.id = (l.page_id * 7 + 3)::VARCHAR"""
_RAW_LINKS = r"""SELECT page_id, unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1)) AS href,
  unnest(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2)) AS label,
  generate_subscripts(regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1), 1) AS pos FROM pages"""


def _list_sql(mark: str, link_text: str, links: str) -> str:
    return (
        f"SELECT page_id, string_agg('{mark} ' || ({link_text}) || chr(10), '' ORDER BY pos) AS items "
        f"FROM ({links}) t GROUP BY page_id"
    )


@query("convert_pages_markdown", _page_sql(_list_sql("-", _MARKDOWN_LINK, _LINKS_TO), "#"))
def pages_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """All given pages, with links resolved over all spaces."""
    spaces = movement._languages(spark, sf)
    targets = page_map(standins.site_pages(spark, sf), spaces)
    bodies = standins.linked_bodies(spark, sf).withColumn("project", F.lit("p-en"))
    linked = with_link_targets(bodies, ["page_id"], targets, spaces)
    return convert_pages(linked).select("page_id", "text")


@query("convert_pages_textile", _page_sql(_list_sql("*", _SHOWN, _RAW_LINKS), "h1."))
def pages_textile(spark: SparkSession, sf: str) -> DataFrame:
    return convert_pages(standins.bodies(spark, sf), "textile").select("page_id", "text")


@query(
    "convert_pages_export",
    _page_sql(_list_sql("-", f"'[' || {_SHOWN} || '](' || href || ')'", _RAW_LINKS), "#"),
)
def pages_export(spark: SparkSession, sf: str) -> DataFrame:
    return convert_pages(standins.bodies(spark, sf), form="export").select("page_id", "text")
