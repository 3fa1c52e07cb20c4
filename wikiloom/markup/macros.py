"""Macro rules: what each structured macro becomes, per input form and target format.

All rules work on one innermost macro at a time, so a macro's body holds converted text already.
The texts and macro calls put out are fixed values of the target wiki.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.keys import file_name
from wikiloom.functions.text import bind, group, has, one_line, rewrite, strip, sub, upto, where_held
from wikiloom.markup.marks import (
    COLUMN_CLOSE,
    COLUMN_OPEN,
    NEWLINE_MARK,
    armour,
    armoured,
    swap,
    title_mark,
)
from wikiloom.markup.nesting import rewrite_nested

MACRO = "ac:structured-macro"

# Fixed values
LANGUAGES = {
    "c#": "csharp",
    "c++": "cpp",
    "js": "javascript",
    "py": "python",
    "rb": "ruby",
    "sh": "bash",
    "shell": "bash",
    "yml": "yaml",
    "objective-c": "objc",
    "actionscript3": "actionscript",
}
STATUS_COLOURS = {
    "Green": "#00875A",
    "Yellow": "#FF991F",
    "Red": "#DE350B",
    "Blue": "#0052CC",
    "Grey": "#97A0AF",
    "Purple": "#6554C0",
}
PANELS = ["info", "note", "warning", "tip", "panel"]
PANEL_ICONS = {"info": "ℹ️", "note": "📝", "warning": "⚠️", "tip": "💡", "panel": "📋"}
DIAGRAMS = ["drawio", "gliffy", "lucidchart", "cloudfortress-draw.io", "balsamiq"]
DYNAMIC_LISTS = ["recently-updated", "livesearch", "content-report-table", "popular-labels"]
PEOPLE = ["contributors", "profile", "contributors-summary", "user-profile", "user-list"]
ROADMAPS = ["roadmap", "calendar", "team-calendar"]
KEEP_CONTENT = ["excerpt", "details", "page-info", "details-summary"]
INCLUDES = ["excerpt-include", "include"]
API_DOCS = ["swagger", "open-api", "openapi"]


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])


def from_map(values: dict[str, str], key: Column, default: Column) -> Column:
    return F.coalesce(F.element_at(literal_map(values), key), default)


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _parameter_pattern(name: str) -> str:
    return f'<ac:parameter ac:name="{name}">([^<]*)</ac:parameter>'


def parameter(macro: Column, name: str) -> Column:
    return group(macro, _parameter_pattern(name))


def parameter_or(macro: Column, name: str, default: Column | str) -> Column:
    other = F.lit(default) if isinstance(default, str) else default
    return F.when(has(macro, _parameter_pattern(name)), parameter(macro, name)).otherwise(other)


def rich_body(macro: Column) -> Column:
    return group(macro, r"(?s)<ac:rich-text-body>(.*)</ac:rich-text-body>")


def plain_body(macro: Column) -> Column:
    closing = "</ac:plain-text-body>"
    return armour(group(macro, f"<ac:plain-text-body>({upto(closing)}){closing}"))


def attribute(element: Column, name: str) -> Column:
    return group(element, f'{name}="([^"]*)"')


def prepare(body: Column) -> Column:
    """Lift literal bodies out of reach of all rules and open self-closed macros."""
    cdata = (
        r"(?s)<ac:plain-text-body>\s*<!\[CDATA\[((?:[^\]]++|\](?!\]>\s*</ac:plain-text-body>))*+)"
        r"\]\]>\s*</ac:plain-text-body>"
    )
    body = rewrite(
        body,
        cdata,
        lambda m: text("<ac:plain-text-body>", armour(group(m, cdata)), "</ac:plain-text-body>"),
        needle="<ac:plain-text-body>",
    )
    return sub(
        body,
        r"<ac:structured-macro([^>]*)/\s*>",
        "<ac:structured-macro$1></ac:structured-macro>",
        "<ac:structured-macro",
    )


def _other(name: Column) -> Column:
    # Fixed value: the comment keeps the name of a macro that has no rule.
    return text(armoured("<!-- "), "Confluence macro: ", name, armoured(" -->"))


def _video(url: Column, width: Column, height: Column) -> Column:
    youtube = group(url, r"(?:youtube\.com/watch\?v=|youtu\.be/)([\p{L}\p{N}_-]+)")
    vimeo = group(url, r"vimeo\.com/(\d+)")
    size = text(", width=", width, ", height=", height, ")}}\n")
    return (
        F.when(youtube != "", text("\n{{youtube(", youtube, size))
        .when(vimeo != "", text("\n{{vimeo(", vimeo, size))
        .when(
            F.contains(url, F.lit("docs.google.com")),
            text("\n{{google_docs(", url, ", width=100%, height=", height, ")}}\n"),
        )
        .otherwise(text("\n{{iframe(", url, size))
    )


def _embed(macro: Column, url_name: str, otherwise: Column) -> Column:
    size = r'<ac:parameter ac:name="{}">(\d+)</ac:parameter>'
    width = F.coalesce(F.nullif(group(macro, size.format("width")), F.lit("")), F.lit("640"))
    height = F.coalesce(F.nullif(group(macro, size.format("height")), F.lit("")), F.lit("360"))
    url = parameter(macro, url_name)
    return F.when(has(macro, _parameter_pattern(url_name)), _video(url, width, height)).otherwise(
        otherwise
    )


def _file(macro: Column, fmt: str, before: str, label: str = "{}") -> Column:
    """Link or image of an attached file; '' when the macro names none."""
    name = attribute(macro, "ri:filename")
    if fmt == "textile":
        markup = text('\nattachment:"', file_name(name), '"\n')
    else:
        head, tail = label.split("{}")
        markup = text(f"\n{before}[{head}", name, f"{tail}](", file_name(name), ")\n")
    return F.when(has(macro, 'ri:filename="'), markup).otherwise("")


def _quote(lines: Column) -> Column:
    quoted = F.regexp_replace(lines, r"(?m)^[^\S\n]*(?=\S)", "> ")
    return F.replace(quoted, F.lit(NEWLINE_MARK), F.lit(NEWLINE_MARK + armoured("> ")))


def _macro_name(macro: Column) -> Column:
    return group(macro, r'^<ac:structured-macro[^>]*ac:name="([^"]*)"')


def _site_macro(fmt: str):
    def replace(macro: Column) -> Column:
        return bind(_macro_name(macro), lambda name: by_name(macro, name))

    def by_name(macro: Column, name: Column) -> Column:
        title = parameter(macro, "title")
        content = rich_body(macro)

        anchor_name = strip(
            parameter_or(macro, "", group(macro, "<ac:parameter[^>]*>([^<]*)</ac:parameter>"))
        )
        anchor = F.when(
            has(macro, "<ac:parameter[^>]*>[^<]*</ac:parameter>"),
            text('<a name="', anchor_name, '" id="', anchor_name, '"></a>'),
        ).otherwise("")

        page = title_mark(attribute(macro, "ri:content-title"))
        space = F.lower(attribute(macro, "ri:space-key"))
        include = (
            F.when(~has(macro, 'ri:content-title="'), F.lit(""))
            .when(has(macro, 'ri:space-key="'), text("\n{{include(", space, ":", page, ")}}\n"))
            .otherwise(text("\n{{include(", page, ")}}\n"))
        )

        written = F.lower(parameter(macro, "language"))
        language = from_map(LANGUAGES, written, written)
        heading = F.when(
            has(macro, _parameter_pattern("title")), text("**", title, "**\n")
        ).otherwise("")
        code = plain_body(macro)
        if fmt == "textile":
            opened = F.when(
                language != "",
                text(armoured("<pre><code class="), '"', language, '"', armoured(">")),
            ).otherwise(armoured("<pre>"))
            closed = F.when(language != "", armoured("</code></pre>")).otherwise(
                armoured("</pre>")
            )
            block = text("\n", heading, opened, "\n", code, "\n", closed, "\n")
        else:
            block = text("\n", heading, "```", language, "\n", code, "\n```\n")

        docs_url = group(macro, r'<ac:parameter ac:name="(?:url|specUrl)">([^<]*)</ac:parameter>')
        api_docs = F.when(
            has(macro, '<ac:parameter ac:name="(?:url|specUrl)">'),
            text(
                "\n**API Documentation (Swagger/OpenAPI)**\n{{iframe(",
                docs_url,
                ", width=100%, height=600)}}\n",
            ),
        ).otherwise("\n> **API Documentation (Swagger/OpenAPI)** -- *embedded content not migrated*\n")

        between = rf"\s*{COLUMN_CLOSE}\s*{COLUMN_OPEN}\s*"
        columns = F.regexp_replace(content, between, "\n\n---\n\n")
        columns = strip(swap(columns, COLUMN_OPEN + COLUMN_CLOSE, ""))

        colour = from_map(STATUS_COLOURS, parameter(macro, "colour"), F.lit(""))
        label = parameter_or(macro, "title", "Status")
        if fmt == "textile":
            coloured = text(
                " %{background:", colour, ";color:#fff;padding:1px 6px;border-radius:3px}", label, "% "
            )
        else:
            coloured = text(
                ' <span style="background:',
                colour,
                ';color:#fff;padding:1px 6px;border-radius:3px;font-size:0.85em">',
                label,
                "</span> ",
            )
        status = F.when(colour != "", coloured).otherwise(text(" **", label, "** "))

        inner = one_line(F.regexp_replace(content, "<[^>]+>", " "))
        panel_title = F.when(title != "", text(": ", title)).otherwise("")
        panel = text("\n> **", F.upper(name), panel_title, "**\n", _quote(inner), "\n")

        key = parameter(macro, "key")
        jira = (
            F.when(has(macro, _parameter_pattern("key")), text("`", key, "`"))
            .when(
                has(macro, _parameter_pattern("jqlQuery")),
                text("\n*Jira query: `", parameter(macro, "jqlQuery"), "`*\n"),
            )
            .when(
                has(macro, '<ac:parameter ac:name="(?:server|columns)">'),
                F.lit("\n*Jira issue list -- not migrated*\n"),
            )
            .otherwise("")
        )

        diagram_name = group(
            macro, r'<ac:parameter ac:name="(?:diagramName|name|filename)">([^<]*)</ac:parameter>'
        )
        diagram = F.when(
            has(macro, '<ac:parameter ac:name="(?:diagramName|name|filename)">'),
            text(
                "\n> **Diagram (",
                name,
                "):** ",
                diagram_name,
                "\n> *Embedded diagram not migrated — see original Confluence page*\n",
            ),
        ).otherwise(text("\n> **Diagram (", name, ")** — *embedded diagram not migrated*\n"))

        file_image = _file(macro, fmt, "!")
        return (
            F.when(name == "toc", F.lit("\n\n{{toc}}\n\n"))
            .when(name == "anchor", anchor)
            .when(name.isin(INCLUDES), include)
            .when(name.isin(KEEP_CONTENT), content)
            .when(name.isin("code", "noformat"), block)
            .when(name == "view-file", _file(macro, fmt, ""))
            .when(name == "multimedia", _embed(macro, "(?:url|URL)", file_image))
            .when(name == "widget", _embed(macro, "url", F.lit("")))
            .when(name.isin(API_DOCS), api_docs)
            .when(
                name == "expand",
                text("\n{{collapse(", parameter_or(macro, "title", "Details"), ")\n", content, "\n}}\n"),
            )
            .when(name == "section", F.when(columns != "", text("\n\n", columns, "\n\n")).otherwise(""))
            .when(name == "column", text(COLUMN_OPEN, content, COLUMN_CLOSE))
            .when(name == "status", status)
            .when(name.isin(PANELS), panel)
            .when(name == "children", F.lit("\n\n{{child_pages}}\n\n"))
            .when(name.isin(DYNAMIC_LISTS + PEOPLE), F.lit(""))
            .when(name == "jira", jira)
            .when(name.isin(DIAGRAMS), diagram)
            .when(name.isin(ROADMAPS), F.lit("\n> *Calendar/Roadmap macro — not migrated*\n"))
            .when(name != "", _other(name))
            .otherwise("")
        )

    return replace


def _export_macro(macro: Column) -> Column:
    return bind(_macro_name(macro), lambda name: _export_by_name(macro, name))


def _export_by_name(macro: Column, name: Column) -> Column:
    content = rich_body(macro)
    page = attribute(macro, "ri:content-title")
    include = F.when(
        has(macro, 'ri:content-title="'),
        text("\n> *Included from:* [[", title_mark(page), "|", page, "]]\n"),
    ).otherwise("")
    docs_url = group(macro, r'<ac:parameter ac:name="(?:url|specUrl)">([^<]*)</ac:parameter>')
    api_docs = F.when(
        has(macro, '<ac:parameter ac:name="(?:url|specUrl)">'),
        text(
            "\n> 📋 **API Documentation (Swagger/OpenAPI)**\n> URL: [", docs_url, "](", docs_url, ")\n"
        ),
    ).otherwise("\n> 📋 **API Documentation (Swagger/OpenAPI)** — *embedded content not migrated*\n")
    jira = (
        F.when(has(macro, _parameter_pattern("key")), text("`", parameter(macro, "key"), "`"))
        .when(
            has(macro, _parameter_pattern("jqlQuery")),
            text("\n*Jira query: `", parameter(macro, "jqlQuery"), "`*\n"),
        )
        .otherwise("")
    )
    inner = strip(F.regexp_replace(content, "<[^>]+>", " "))
    icon = from_map(PANEL_ICONS, name, F.lit("📋"))
    quoted = text("> ", F.replace(inner, F.lit("\n"), F.lit("\n> ")))
    quoted = F.replace(quoted, F.lit(NEWLINE_MARK), F.lit(NEWLINE_MARK + armoured("> ")))
    panel = text("\n> ", icon, " **", F.initcap(name), "**\n", quoted, "\n")
    return (
        F.when(name.isin(INCLUDES), include)
        .when(
            name.isin("code", "noformat"),
            text("\n```", parameter(macro, "language"), "\n", plain_body(macro), "\n```\n"),
        )
        .when(name == "view-file", _file(macro, "markdown", "", "📎 {}"))
        .when(name == "multimedia", _file(macro, "markdown", "", "🎬 {}"))
        .when(name.isin(API_DOCS), api_docs)
        .when(
            name == "expand",
            text("\n**▸ ", parameter_or(macro, "title", "Details"), "**\n", content, "\n"),
        )
        .when(name == "anchor", F.lit(""))
        .when(name == "children", F.lit("\n*See child pages in the sidebar.*\n"))
        .when(
            name == "recently-updated",
            F.lit("\n*Recently updated pages — see sidebar for navigation.*\n"),
        )
        .when(
            name.isin("contributors", "profile", "contributors-summary"),
            F.lit("\n*Contributors information — not migrated.*\n"),
        )
        .when(name == "jira", jira)
        .when(name.isin(PANELS), panel)
        .when(name == "toc", F.lit("\n{{>toc}}\n"))
        .when(name != "", _other(name))
        .otherwise("")
    )


def convert_macros(body: Column, form: str, fmt: str) -> Column:
    replace = _export_macro if form == "export" else _site_macro(fmt)
    done = where_held(body, lambda b: rewrite_nested(prepare(b), MACRO, replace), f"<{MACRO}", "<ac:plain-text-body>")
    return sub(done, f"[{COLUMN_OPEN}{COLUMN_CLOSE}]", "", COLUMN_OPEN)
