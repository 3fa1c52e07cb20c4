"""Nested lists, from the inside out, in built-in expressions.

A list that holds no other becomes a block of lines between two marks. The list around it meets the block
inside an item, puts one level of indent before its lines and sets them below the item's own
line. Each round closes one level of all lists of a body, whatever their kinds; a body has as many rounds
as it is deep.

List tags without a partner, and those that cross another pair, keep a list from being innermost.
They are dropped in a second run, which looks at one kind at a time; outside of all lists they stay for the
general rules.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikiloom.functions.text import SPACE, bind, fold_text, group, has, one_line, rewrite
from wikiloom.markup.marks import (
    GUARD,
    LINES_CLOSE,
    LINES_OPEN,
    NEWLINE_MARK,
    TITLE_CLOSE,
    TITLE_OPEN,
    swap,
)
from wikiloom.markup.nesting import depth, rewrite_nested

_LIST = "(?:ul|ol)"
_INDENT = "   "
_TITLE = re.compile(f"{TITLE_OPEN}([^{TITLE_CLOSE}]*){TITLE_CLOSE}")
_BLOCK = f"{LINES_OPEN}([^{LINES_CLOSE}]*+){LINES_CLOSE}"
_ITEM = r"<li\b([^>]*)>"
_BREAK = r"<br\s*/?>|</?(?:p|div)\b[^>]*>"
_DROP = r"<(?!/?u\b)(?!/span)(?!span\b[^>]*style=)[^>]+>"
_BOX = r'class="[^"]*\b(unchecked|checked)\b[^"]*"'
_FENCE = rf"\n(```[^\n]*\n){GUARD}([^\n]*+\n```)\n"
# An element of either kind that holds no list tag at all
_INNERMOST = rf"<(ul|ol)\b[^>]*+>(?:[^<]++|<(?!/?{_LIST}\b))*+</\1>"


def _below(lines: Column, textile: bool) -> Column:
    """Lines one level deeper; those of a code block are armoured and have marks for line ends."""
    if textile:
        return F.regexp_replace(lines, r"(?md)^([*#])", "$1$1")
    return F.regexp_replace(lines, rf"(?md)^(?=.)|(?<={NEWLINE_MARK})", _INDENT)


def _item(attributes: Column, content: Column, ordered: Column, number: Column, textile: bool) -> Column:
    """The lines of an item: its own, then those of the blocks in it and behind it."""
    if not textile:
        fence = F.regexp_replace(content, _FENCE, f"{LINES_OPEN}$1{GUARD}$2\n{LINES_CLOSE}")
        content = F.when(F.contains(content, F.lit("\n```")), fence).otherwise(content)

    def lines(whole: Column) -> Column:
        blocks = F.array_join(F.regexp_extract_all(whole, F.lit(_BLOCK), F.lit(1)), "")
        own = F.regexp_replace(F.get(F.split(whole, "</li>", 2), F.lit(0)), _BLOCK, "")

        def line(html: Column) -> Column:
            words = one_line(F.regexp_replace(F.regexp_replace(html, _BREAK, " "), _DROP, ""))
            words = F.when(ordered, F.regexp_replace(words, rf"^\d+[.)][{SPACE}]*", "")).otherwise(words)
            if textile:
                return F.concat(F.when(ordered, "# ").otherwise("* "), words, F.lit("\n"))
            box = F.coalesce(F.nullif(group(attributes, _BOX), F.lit("")), group(html, _BOX))
            mark = (
                F.when(box == "unchecked", "- [ ] ").when(box == "checked", "- [x] ")
                .when(ordered, F.concat(number.cast("string"), F.lit(". "))).otherwise("- ")
            )
            return F.concat(mark, words, F.lit("\n"))

        below = F.when(blocks != "", _below(blocks, textile)).otherwise("")
        return F.concat(bind(own, line), below)

    return bind(content, lines)


def _listing(element: Column, textile: bool) -> Column:
    """A list without lists in it, as a block of lines. Text between items goes, blocks there stay."""
    opening = r"^<(ul|ol)\b([^>]*+)>"
    ordered = group(element, opening) == "ol"
    first = F.coalesce(
        F.nullif(group(group(element, opening, 2), r'start="(\d{1,9})"'), F.lit("")).cast("long"), F.lit(1)
    )
    inner = F.regexp_replace(element, rf"{opening}|</{_LIST}>$", "")

    def items(body: Column) -> Column:
        parts = F.split(body, _ITEM, -1)
        attributes = F.regexp_extract_all(body, F.lit(_ITEM), F.lit(1))
        before = F.array_join(F.regexp_extract_all(F.get(parts, F.lit(0)), F.lit(_BLOCK), F.lit(1)), "")

        def made(parts: Column) -> Column:
            lines = F.transform(
                attributes,
                lambda a, i: _item(a, F.get(parts, i + 1), ordered, first + i, textile),
            )
            return F.concat(
                F.lit(LINES_OPEN), _below(before, textile), F.array_join(lines, ""), F.lit(LINES_CLOSE)
            )

        return bind(parts, made)

    return bind(inner, items)


def convert_lists(body: Column, textile: bool) -> Column:
    def rounds(text: Column) -> Column:
        levels = F.sequence(F.lit(1), F.greatest(depth(text, _LIST), F.lit(1)))
        return F.aggregate(
            levels, text, lambda acc, _: rewrite(acc, _INNERMOST, lambda e: _listing(e, textile))
        )

    def leftover(text: Column, kind: str, other: str) -> Column:
        """Lists of a kind in which tags of the other kind have no partner."""

        def cleared(element: Column) -> Column:
            return _listing(F.regexp_replace(element, rf"</?{other}\b[^>]*>", ""), textile)

        both = has(text, rf"<{kind}\b") & F.contains(text, F.lit(f"</{kind}>"))
        return F.when(both, rewrite_nested(text, kind, cleared)).otherwise(text)

    done = bind(body, rounds)
    done = bind(done, lambda text: leftover(text, "ul", "ol"))
    done = bind(done, lambda text: leftover(text, "ol", "ul"))
    done = swap(done, LINES_OPEN + LINES_CLOSE, "\n\n")
    return bind(body, lambda text: F.when(has(text, rf"<{_LIST}\b"), done).otherwise(text))


@F.pandas_udf(T.StringType())
def _with_folded_titles(bodies: pd.Series) -> pd.Series:
    def folded(body: str) -> str:
        return _TITLE.sub(lambda m: f"{TITLE_OPEN}{fold_text(m[1])}{TITLE_CLOSE}", body)

    return bodies.map(folded, na_action="ignore")


def fold_titles(body: Column) -> Column:
    """Marked titles without accents; only bodies with such titles leave the JVM."""
    title = has(body, f"{TITLE_OPEN}[^{TITLE_CLOSE}]*[^\\x00-\\x7f{TITLE_CLOSE}]")
    return F.coalesce(_with_folded_titles(F.when(title, body)), body)
