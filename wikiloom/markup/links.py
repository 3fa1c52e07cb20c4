"""Rules for images, stored links, emoticons, rendered links and mentions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.keys import file_name, heading_anchor
from wikiloom.functions.text import bind, drop_tags, group, has, rewrite, strip, url_unquote
from wikiloom.markup.macros import attribute, from_map, text
from wikiloom.markup.marks import title_mark
from wikiloom.markup.nesting import innermost
from wikiloom.operators.links import (
    LINK,
    SHOWN_MENTION,
    display_target,
    label_text,
    shown_mention,
    stored_mention,
)

# Icon and colour per emoticon
EMOTICONS = {
    "tick": ("check-circle", "green"),
    "cross": ("times-circle", "red"),
    "warning": ("exclamation-triangle", "#FF991F"),
    "information": ("info-circle", "#0052CC"),
    "plus": ("plus-circle", "green"),
    "minus": ("minus-circle", "red"),
    "question": ("question-circle", "#6554C0"),
    "light-on": ("lightbulb", "#FF991F"),
    "light-off": ("lightbulb", "#97A0AF"),
    "yellow-star": ("star", "#FFAB00"),
    "red-star": ("star", "red"),
    "green-star": ("star", "green"),
    "blue-star": ("star", "#0052CC"),
    "thumbs-up": ("thumbs-up", "green"),
    "thumbs-down": ("thumbs-down", "red"),
    "smile": ("smile", "#FFAB00"),
    "sad": ("frown", "#97A0AF"),
    "laugh": ("laugh", "#FFAB00"),
    "wink": ("grin-wink", "#FFAB00"),
    "cheeky": ("grin-tongue-wink", "#FFAB00"),
    "heart": ("heart", "red"),
    "broken_heart": ("heart-broken", "red"),
    "flag": ("flag", "red"),
}
EXPORT_EMOTICONS = {"tick": "✅", "cross": "❌", "warning": "⚠️", "information": "ℹ️"}

_IMAGE = r"(?s)<ac:image(?=[\s>])[^>]*>.*?</ac:image>"
_EMOTICON = r'<ac:emoticon ac:name="([^"]*)"\s*/?>'
_WRAPPER = (
    r'<span[^>]*class="[^"]*confluence-embedded-file-wrapper[^"]*"[^>]*>'
    r"\s*<img[^>]*/?\s*>\s*</span>"
)
_DOWNLOAD = r'src="[^"]*?/download/(?:attachments|thumbnails)/\d+/([^?"]+)'
_CDATA_LABEL = r"(?s)<ac:plain-text-link-body>\s*<!\[CDATA\[(.*?)\]\]>"
_BODY_LABEL = r"(?s)<ac:link-body>(.*?)</ac:link-body>"


def image_markup(name: Column, fmt: str) -> Column:
    safe = file_name(name)
    return text("!", safe, "!") if fmt == "textile" else text("![", safe, "](", safe, ")")


def _or(value: Column, default: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), default)


def stored_images(body: Column, form: str, fmt: str) -> Column:
    def replace(image: Column) -> Column:
        name = attribute(image, "ri:filename")
        by_file = has(image, 'ri:filename="')
        if form == "export":
            markup = text("\n![", name, "](", file_name(name), ")\n")
            return F.when(by_file, markup).otherwise("")
        url = group(image, 'ri:url ri:value="([^"]*)"')
        by_url = text("\n!", url, "!\n") if fmt == "textile" else text("\n![](", url, ")\n")
        return (
            F.when(by_file, text("\n", image_markup(name, fmt), "\n"))
            .when(has(image, 'ri:url ri:value="'), by_url)
            .otherwise("")
        )

    return rewrite(body, _IMAGE, replace, needle="<ac:image")


def wrapped_images(body: Column, fmt: str) -> Column:
    """Rendered attachments: a paragraph or span around an ``<img>``."""

    def replace(block: Column) -> Column:
        alias = attribute(block, "data-linked-resource-default-alias")
        name = _or(alias, url_unquote(group(block, _DOWNLOAD)))
        return F.when(name != "", text("\n\n", image_markup(name, fmt), "\n\n")).otherwise("")

    pattern = rf"<p>\s*{_WRAPPER}\s*</p>|{_WRAPPER}"
    return rewrite(body, pattern, replace, needle="confluence-embedded-file-wrapper")


def _stored_label(link: Column) -> Column:
    """Text of a stored link without tags, '' when it has none."""
    html = F.when(has(link, _CDATA_LABEL), group(link, _CDATA_LABEL)).otherwise(
        group(link, _BODY_LABEL)
    )
    return strip(drop_tags(html))


def stored_links(body: Column, form: str, fmt: str) -> Column:
    """Stored links, one at a time: user, attachment, page, anchor, URL, space, plain label."""

    def site(link: Column) -> Column:
        label = _stored_label(link)
        name = attribute(link, "ri:filename")
        if fmt == "textile":
            attached = text(' attachment:"', file_name(name), '" ')
        else:
            attached = text(" [", _or(label, name), "](", file_name(name), ") ")
        title = attribute(link, "ri:content-title")
        anchor = attribute(link, "ac:anchor")
        place = F.when(has(link, 'ac:anchor="'), text("#", anchor)).otherwise("")
        space = attribute(link, "ri:space-key")
        in_space = has(link, 'ri:space-key="')
        shown = _or(label, title)
        page = F.when(
            in_space,
            text("{{wiki(", F.lower(space), ", ", title_mark(title), place, ", ", shown, ")}}"),
        ).otherwise(text("[[", title_mark(title), place, "|", shown, "]]"))
        url = group(link, '<ri:url ri:value="([^"]*)"')
        if fmt == "textile":
            outside = text('"', _or(label, url), '":', url)
            jump = text('"', _or(label, anchor), '":#', anchor)
        else:
            outside = text("[", _or(label, url), "](", url, ")")
            jump = text("[", _or(label, anchor), "](#", anchor, ")")
        return (
            F.when(has(link, "<ri:user"), text("@", stored_mention(link)))
            .when(
                has(link, "<ri:attachment"),
                F.when(has(link, 'ri:filename="'), attached).otherwise(""),
            )
            .when(
                has(link, "<ri:page"),
                F.when(has(link, 'ri:content-title="'), page).otherwise(""),
            )
            .when(has(link, r'^<ac:link\s+ac:anchor="'), jump)
            .when(has(link, "<ri:url"), outside)
            .when(in_space, text("[[", F.lower(space), ":]]"))
            .otherwise(strip(drop_tags(group(link, _BODY_LABEL))))
        )

    def export(link: Column) -> Column:
        label = _stored_label(link)
        name = attribute(link, "ri:filename")
        title = attribute(link, "ri:content-title")
        url = group(link, '<ri:url ri:value="([^"]*)"')
        cdata = strip(group(link, _CDATA_LABEL))
        return (
            F.when(
                has(link, "<ri:attachment"),
                F.when(
                    has(link, 'ri:filename="'),
                    text(" [", _or(label, name), "](", file_name(name), ") "),
                ).otherwise(""),
            )
            .when(
                has(link, "<ri:page"),
                F.when(
                    has(link, 'ri:content-title="'),
                    text("[[", title_mark(title), "|", _or(label, title), "]]"),
                ).otherwise(""),
            )
            .when(
                has(link, "<ri:url"),
                text("[", F.when(has(link, _CDATA_LABEL), cdata).otherwise(url), "](", url, ")"),
            )
            .otherwise(strip(drop_tags(group(link, _BODY_LABEL))))
        )

    replace = export if form == "export" else site
    return rewrite(body, innermost("ac:link"), replace, needle="<ac:link")


def emoticons(body: Column, form: str) -> Column:
    def replace(tag: Column) -> Column:
        name = group(tag, _EMOTICON)
        unknown = text("[", name, "]")
        if form == "export":
            return from_map(EXPORT_EMOTICONS, name, unknown)
        icons = {k: f"{{{{fa({icon}, color={colour})}}}}" for k, (icon, colour) in EMOTICONS.items()}
        return from_map(icons, name, unknown)

    return rewrite(body, _EMOTICON, replace, needle="<ac:emoticon")


def shown_mentions(body: Column) -> Column:
    return rewrite(
        body, SHOWN_MENTION, lambda m: text("@", shown_mention(m)), needle="confluence-userlink"
    )


def shown_links(
    body: Column,
    fmt: str,
    page_targets: Column | None,
    space_targets: Column | None,
    project: Column | None,
) -> Column:
    """Rendered links. ``page_targets`` maps page ids to (title, project) and ``space_targets``
    upper space keys to projects, each for the ids in this body only."""
    no_text = F.lit(None).cast("string")

    def replace(tag: Column) -> Column:
        label = label_text(group(tag, LINK, 2))
        return bind(
            group(tag, LINK, 1),
            lambda href: bind(_or(label, href), lambda shown: made(href, shown)),
        )

    def made(href: Column, label: Column) -> Column:
        if fmt == "textile":
            outside = text('"', label, '":', href)
            jump = text('"', label, '":#', heading_anchor(label))
        else:
            outside = text("[", label, "](", href, ")")
            jump = text("[", label, "](#", heading_anchor(label), ")")

        page_id = group(href, r"pageId=(\d+)")
        target = F.element_at(page_targets, page_id) if page_targets is not None else None
        target_title = target["title"] if target is not None else no_text
        target_project = target["project"] if target is not None else no_text
        here = project if project is not None else no_text
        title = F.coalesce(target_title, title_mark(label))
        page = F.when(
            target_project != here, text("{{wiki(", target_project, ", ", title, ", ", label, ")}}")
        ).otherwise(text("[[", title, "|", label, "]]"))

        space, page_title = display_target(href)
        mapped = (
            F.element_at(space_targets, F.upper(space)) if space_targets is not None else no_text
        )
        shown = text(
            "{{wiki(", F.coalesce(mapped, F.lower(space)), ", ", title_mark(page_title), ", ", label,
            ")}}",
        )
        return (
            F.when(F.startswith(href, F.lit("#")), jump)
            .when(page_id != "", page)
            .when(has(href, "^/display/[^/?]+/[^?]"), shown)
            .when(F.startswith(href, F.lit("/")) & ~F.startswith(href, F.lit("//")), label)
            .otherwise(outside)
        )

    return rewrite(body, LINK, replace, needle="href=")


def plain_links(body: Column) -> Column:
    return F.regexp_replace(body, LINK, "[$2]($1)")


def shown_images(body: Column, form: str, fmt: str) -> Column:
    if form == "export":
        body = F.regexp_replace(
            body, r'<img\b[^>]*src="([^"]*)"[^>]*alt="([^"]*)"[^>]*/?>', "![$2]($1)"
        )
        return F.regexp_replace(body, r'<img\b[^>]*src="([^"]*)"[^>]*/?>', "![]($1)")

    def replace(tag: Column) -> Column:
        source = attribute(tag, "src")
        alias = attribute(tag, "data-linked-resource-default-alias")
        held = url_unquote(group(source, r"/download/(?:attachments|thumbnails)/\d+/([^?\"]+)"))
        name = _or(alias, held)
        other = (
            text("!", source, "!")
            if fmt == "textile"
            else text("![", attribute(tag, "alt"), "](", source, ")")
        )
        return (
            F.when(source == "", F.lit(""))
            .when(name != "", text("\n\n", image_markup(name, fmt), "\n\n"))
            .otherwise(other)
        )

    return rewrite(body, r"<img\b[^>]*>", replace, needle="<img")
