"""Goldens per rule, and one test for each place where the intent and a simple rewrite differ."""

from __future__ import annotations

import html
import re
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from wikiloom.catalog.markup import link, macro, par, plain, rich
from wikiloom.functions import text
from wikiloom.functions.text import unescape, where_held
from wikiloom.markup import html as html_rules
from wikiloom.markup import marks
from wikiloom.markup.convert import convert_pages, with_link_targets


def converted(spark, bodies, fmt="markdown", form="site"):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    return [r.text for r in convert_pages(frame, fmt, form).orderBy("i").collect()]


MARKDOWN = {
    # elements
    "<strong>a</strong>": "**a**",
    "<b>a</b>": "**a**",
    "<em>a</em>": "*a*",
    "<i>a</i>": "*a*",
    "<del>a</del>": "~~a~~",
    "<s>a</s>": "~~a~~",
    "<u>a</u>": "<u>a</u>",
    "<code>a</code>": "`a`",
    "<pre><code>a\nb</code></pre>": "```\na\nb\n```",
    "<h1>a</h1>": "# a",
    "<h6>a</h6>": "###### a",
    "<ol><li>a</li><li>b</li></ol>": "1. a\n2. b",
    "<ul><li>a</li></ul>": "- a",
    "<table><tr><td>a</td></tr></table>": "<table><tr><td>a</td></tr></table>",
    "<blockquote>a</blockquote>": "> a",
    '<a href="http://x.org">a</a>': "[a](http://x.org)",
    '<a href="#id-1">A b</a>': "[A b](#A-b)",
    '<a href="/pages/viewpage.action?pageId=9">A 1</a>': "[[A_001|A 1]]",
    '<a class="confluence-userlink" href="/x">Ann B</a>': "@Ann B",
    '<img src="/download/attachments/1/a.png">': "![a.png](a.png)",
    '<ac:image><ri:attachment ri:filename="a.png"/></ac:image>': "![a.png](a.png)",
    link('<ri:user ri:username="ann"/>'): "@ann",
    macro("code", par("language", "sql") + plain("a < b")): "```sql\na < b\n```",
    macro("note", rich("<p>a</p>")): "> **NOTE**\n> a",
    '<ac:emoticon ac:name="smile"/>': "{{fa(smile, color=#FFAB00)}}",
    # empty input
    "": "",
    None: "",
    "<p></p>": "",
}

FAULTS = {
    # bold text keeps its markers; adjacent runs are kept apart
    "<b>a</b><b>b</b>": "**a** **b**",
    # an unticked box stays unticked
    '<ul><li class="unchecked">a</li><li class="checked">b</li></ul>': "- [ ] a\n- [x] b",
    # a mention is no general link
    "<ac:link><ri:user ri:userkey=\"k\"/><ac:link-body>Ann</ac:link-body></ac:link>": "@Ann",
    # a link ends where it ends
    link('<ri:url ri:value="u"/>', "a") + link('<ri:attachment ri:filename="f.txt"/>', "b"): "[a](u) [b](f.txt)",
    # tags that begin like b, s, i, u, p
    "a<br>b<span>c</span>": "a\nbc",
    "<b>x<br/>y</b><ul><li><u>u</u></li></ul>": "**x<br/>y**\n- <u>u</u>".replace("<br/>", "\n"),
    "<strong>a</strong> <section>b</section>": "**a** b",
    # macros inside macros
    macro("panel", rich(macro("expand", rich("x")) + "y")): "> **PANEL**\n> {{collapse(Details) x }} y",
    macro("expand", rich(macro("code", plain("</ac:structured-macro>")))): "{{collapse(Details)\n\n```\n</ac:structured-macro>\n```\n\n}}",
    # styled spans stay
    '<span style="color:red">a</span><span>b</span>': '<span style="color:red">a</span>b',
    # code is not rewritten
    macro("code", plain("**a** #1\n\n\n\n<b>x</b> &amp;  \nz")): "```\n**a** #1\n\n\n\n<b>x</b> &amp;  \nz\n```",
    # literal asterisks stay
    "2 * 3 ** ** ****": "2 * 3 ** ** ****",
    # unclosed and stray tags
    "<b>a <ul><li>b": "a b",
    "<ul><li>a<li>b</ul>": "- a\n- b",
    "</ul></li>a": "a",
    "<ul><li>a</ul></ol></ul>b": "- a\n\nb",
}


def test_markdown(spark):
    assert converted(spark, MARKDOWN) == list(MARKDOWN.values())


def test_faults(spark):
    assert converted(spark, FAULTS) == list(FAULTS.values())


def test_textile(spark):
    cases = {
        "<strong>a</strong> <em>b</em> <del>c</del> <u>d</u>": "*a* _b_ -c- +d+",
        "<h2>a</h2>": "h2. a",
        "<ul><li>a<ul><li>b</li></ul></li></ul>": "* a\n** b",
        '<a href="http://x">a</a>': '"a":http://x',
        '<img src="/download/attachments/1/a.png">': "!a.png!",
        "<pre>a</pre>": "<pre>\na\n</pre>",
        '<ac:image><ri:attachment ri:filename="a b.png"/></ac:image>': "!a_b.png!",
    }
    assert converted(spark, cases, "textile") == list(cases.values())


def test_export(spark):
    cases = {
        "<table><tr><th>a</th></tr><tr><td>b|c</td><td>d</td></tr></table>": "| a |  |\n| --- | --- |\n| b\\|c | d |",
        macro("toc"): "{{>toc}}",
        macro("info", rich("a")): "> ℹ️ **Info**\n> a",
        '<a href="/x">a</a>': "[a](/x)",
        '<ac:emoticon ac:name="tick"/>': "✅",
        "<ul><li>a</li></ul>": "- a",
    }
    assert converted(spark, cases, form="export") == list(cases.values())


def test_nested_elements(spark):
    cases = {
        "<ul><ol><li>q</li></ul></ol>y": "- q\n\ny",
        "<ul><li>a<ol><li>b</ul>x": "- a\n- b\n\nx",
        "<ul><li>a<ul><li>b</li></ul>after</li></ul>": "- aafter\n   - b",
        "<ul></ul>t": "t",
        "<ul>text<li>a</li>gap<li>b</li></ul>": "- a\n- b",
        "<ol start=\"3\"><li>7) x</li><li><ul><li class=\"unchecked\">y</li></ul></li></ol>": "3. x\n4.\n   - [ ] y",
        "<ul><li>b<ul><li>c<pre>x\n y</pre></li></ul></li></ul>": "- b\n   - c\n      ```\n      x\n       y\n      ```",
        "<blockquote>a<blockquote>b</blockquote>c</blockquote>": "> a\n> > b\n> c",
        "<ul>" * 40 + "<li>deep</li>" + "</ul>" * 40: "- deep",
    }
    assert converted(spark, cases) == list(cases.values())
    tables = {
        "<table><tr><td>x<table><tr><td>y</td></tr></table></td><td>z</td></tr></table>": "| x y | z |\n| --- | --- |",
        "<table></table>a": "a",
        "<table><tr><td>a<tr><td>b</table>": "| a |\n| --- |\n| b |",
    }
    assert converted(spark, tables, form="export") == list(tables.values())


def test_all_entities(spark):
    texts = [f"x&{n}y" for n in html5] + [f"&{n} z" for n in html5]
    texts += [f"&#{n};" for n in (*range(400), *range(400, 1 << 17, 211), 0xD800, 0xFDD0, 0x10FFFF, 0x110000)]
    texts += [f"&#x{n:X}" for n in range(300)] + ["&#x" + "F" * 30 + ";", "&#" + "9" * 30 + ";", "&#00065;"]
    texts += ["&notit; &ampamp; &amp;amp; & &; &# &#x; &#xg; &zzz; a&b", "&" + "a" * 60 + ";", "&lt&gt&#65&#66", "no", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = [r.u for r in frame.select("i", unescape(F.col("t")).alias("u")).orderBy("i").collect()]
    assert got == [html.unescape(t) for t in texts]


def test_long_bodies_need_no_stack(spark):
    """Whole texts of a megabyte, with deep nesting, many links and an unclosed tag."""
    body = (
        "<p>" + "x<i>y</i> " * 40_000 + macro("expand", rich("z " * 200_000)) + "<b>"
        + "".join("<ul><li>" for _ in range(200)) + "deep" + "</li></ul>" * 200
    )
    text = converted(spark, [body])[0]
    assert text.count("*y*") == 40_000 and text.count("z ") >= 199_999 and "deep" in text


def test_deep_macros(spark):
    body = "core"
    for _ in range(30):
        body = macro("expand", rich(body))
    text = converted(spark, [body])[0]
    assert text.count("{{collapse(Details)") == 30 and "ac:" not in text


def test_links_to_pages_and_spaces(spark):
    bodies = spark.createDataFrame(
        [
            (1, 'a <a href="/pages/viewpage.action?pageId=7">X</a>', "p"),
            (2, '<a href="/pages/viewpage.action?pageId=8">Y</a> <a href="/display/Key/T+1">Z</a>', "p"),
            (3, "no links", "p"),
            (4, None, "p"),
        ],
        "i int, body string, project string",
    )
    targets = spark.createDataFrame(
        [("7", "Seven", "p"), ("8", "Eight", "q")], "id string, wiki_title string, project string"
    )
    spaces = spark.createDataFrame([("KEY", "mapped")], "key string, identifier string")
    linked = with_link_targets(bodies, ["i"], targets, spaces)
    texts = [r.text for r in convert_pages(linked).orderBy("i").collect()]
    assert texts == [
        "a [[Seven|X]]",
        "{{wiki(q, Eight, Y)}} {{wiki(mapped, T_001, Z)}}",
        "no links",
        "",
    ]


def test_bodies_are_searched_and_moved_once_for_links(spark):
    """Ids of links are written, and one join brings the maps of pages and spaces to a body."""
    bodies = spark.createDataFrame(
        [(1, '<a href="/x?pageId=7">a</a>'), (2, '<a href="/display/ab/T">b</a>'), (3, "no link"), (4, None)],
        "page_id int, body string",
    )
    targets = spark.createDataFrame([("7", "T_7", "p")], "id string, wiki_title string, project string")
    spaces = spark.createDataFrame([("AB", "p-ab")], "key string, identifier string")
    linked = with_link_targets(bodies, ["page_id"], targets, spaces)
    assert "regexp_extract_all" not in linked._jdf.queryExecution().optimizedPlan().toString()
    found = {r.page_id: (r.link_pages, r.link_spaces) for r in linked.collect()}
    assert found[1][0]["7"].title == "T_7" and found[1][1] is None
    assert found[2] == (None, {"AB": "p-ab"})
    assert found[3] == found[4] == (None, None)


def test_conversion_needs_no_shuffle(spark):
    frame = spark.createDataFrame([("a",)], "body string")
    plan = convert_pages(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_unknown_formats(spark):
    frame = spark.createDataFrame([("a",)], "body string")
    with pytest.raises(ValueError):
        convert_pages(frame, "html")
    with pytest.raises(ValueError):
        convert_pages(frame, "textile", "export")


def test_body_column_and_nulls(spark):
    frame = spark.createDataFrame([(None,), ("<b>a</b>",)], "html string")
    texts = {r.md for r in convert_pages(frame, body="html", out="md").select(F.col("md")).collect()}
    assert texts == {"", "**a**"}


def test_rules_are_skipped_where_no_tag_is_left(spark):
    rows = spark.createDataFrame([("no tag",), ("a\u0000<",), ("",), (None,)], "t string")
    loud = where_held(F.col("t"), lambda body: F.upper(body), "<", "no such")
    assert [r[0] for r in rows.select(loud).collect()] == ["no tag", "A\u0000<", "", None]
    failing = where_held(F.col("t"), lambda body: F.raise_error(body).cast("string"), "<")
    assert rows.where("t = 'no tag'").select(failing).first()[0] == "no tag"


def test_armoured_signs_begin_with_other_bytes_than_marks(spark):
    """Else a search for a mark stops at every blank of code; and code of all signs comes back as it was."""
    signs = {c.encode()[0] for c in marks._ARMOURED}
    assert len(set(marks._ARMOURED)) == len(marks._PLAIN)
    assert marks.GUARD.encode()[0] not in signs and marks.TITLE_OPEN.encode()[0] not in signs
    code = "a  b\t<c> & #1\r\n * ]] ]> 中 😀 </d>\n\n\n\n  z"
    row = spark.createDataFrame([(code,)], "t string")
    assert row.select(marks.disarm(marks.armour(F.col("t")))).first()[0] == code
    assert row.select(marks.disarm(F.lit(marks.armoured(code)))).first()[0] == code


def test_code_up_to_its_first_closing_tag(spark):
    body = (
        '<ac:structured-macro ac:name="code"><ac:plain-text-body><![CDATA[a ]] ]]> </b>\n<i>]]></ac:plain-text-body>'
        "</ac:structured-macro><h1>x < y\n<i>k</i></h1><b>1 < 2\n</c></b><b>3</b>"
    )
    assert converted(spark, [body]) == ["```\na ]] ]]> </b>\n<i>\n```\n\n# x ** **3**"]
    assert converted(spark, ["<h1>a<h1>b</h1>c</h1>", "<b>a<b>c</b>"]) == ["# ab\nc", "**ac**"]


def test_white_space_at_ends_goes_by_literal_searches(spark):
    """Bodies and emphasis: every white space character at both ends, and marks without a partner."""
    white = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    rows = [f"{white}a{white}b{white}", *[f"{c}<b>a\n{c} b{c}</b>{c}" for c in white]]
    out = [r["t"] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string").select(
        "i", text.strip_long(F.col("s")).alias("t")).orderBy("i").collect()]
    assert out == [r.strip() for r in rows]
    assert re.fullmatch(f"[{text.SPACE}]+", white)
    plan = str(html_rules.finish(F.col("b"), "markdown")._jc)
    assert f"[{marks.BOLD_OPEN}{marks.BOLD_CLOSE}]" not in plan
