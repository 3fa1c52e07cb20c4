"""Small text expressions shared by keys, links and markup rules."""

from __future__ import annotations

import html
import json
import unicodedata
from collections.abc import Callable
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character classes with the usual Unicode meaning of word, digit and white space.
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
SPACE = r" \n\t\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # \s, \p{Z} and more

# All white space characters, as the class above
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(_SPACES))


def strip_long(text: Column) -> Column:
    """The same for whole bodies: the end is trimmed only where it is white, as that search lists all places."""

    def ends(body: Column) -> Column:
        white = F.endswith(body, F.lit(_SPACES[0]))
        for sign in _SPACES[1:]:
            white = white | F.endswith(body, F.lit(sign))
        return F.when(white, strip(body)).otherwise(F.ltrim(body, F.lit(_SPACES)))

    return bind(text, ends)


def drop_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def has(text: Column, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(pattern))


def group(text: Column, pattern: str, number: int = 1) -> Column:
    """First match of a group, '' when there is none."""
    return F.regexp_extract(text, pattern, number)


def upto(closing: str) -> str:
    """Pattern for all text before the first closing tag, as a loop that never steps back."""
    return f"[^<]*+(?:<(?!{closing[1:]})[^<]*+)*+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and let ``use`` name it many times."""
    return F.transform(F.array(value), use)[0]


def rewrite(
    text: Column, pattern: str, replace: Callable[[Column], Column], needle: str | None = None
) -> Column:
    """Replace each match of ``pattern`` by ``replace(match)``.

    ``needle`` is a literal that every match holds: rows without it skip the pattern.
    """

    def stitch(body: Column) -> Column:
        gaps = F.split(body, pattern, -1)
        matches = F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), replace)
        pairs = F.zip_with(gaps, matches, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
        return F.array_join(pairs, "")

    if needle is None:
        return bind(text, stitch)
    return bind(
        text, lambda body: F.when(F.contains(body, F.lit(needle)), stitch(body)).otherwise(body)
    )


def sub(text: Column, pattern: str, replacement: str, *needles: str) -> Column:
    """``regexp_replace`` for texts that hold one of the literals every match needs.

    A literal search is far cheaper than a pattern that finds nothing.
    """

    def replaced(body: Column) -> Column:
        return F.regexp_replace(body, pattern, replacement)

    return where_held(text, replaced, *needles) if needles else replaced(text)


def where_held(text: Column, rules: Callable[[Column], Column], *needles: str) -> Column:
    """Rules for texts that hold one of the literals that any of their matches needs; others pass as they are."""

    def gated(body: Column) -> Column:
        held = F.contains(body, F.lit(needles[0]))
        for needle in needles[1:]:
            held = held | F.contains(body, F.lit(needle))
        return F.when(held, rules(body)).otherwise(body)

    return bind(text, gated)


def url_unquote(text: Column) -> Column:
    """Decode %XX; a plus stays a plus and a stray percent sign stays as it is."""
    safe = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def decode_common(text: Column) -> Column:
    """Decode the handful of entities that occur in labels."""
    # Fixed values
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&apos;", "'"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def fold_text(text: str) -> str:
    """Compatibility form without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@F.pandas_udf(T.StringType())
def _fold(texts: pd.Series) -> pd.Series:
    return texts.map(fold_text, na_action="ignore")


def _only_where(text: Column, needed: Column, udf: Callable[[Column], Column]) -> Column:
    """Send a row to Python only where the function can change it."""
    return F.coalesce(udf(F.when(needed, text)), text)


def fold(text: Column) -> Column:
    """Drop accents and compatibility forms; ASCII rows never leave the JVM."""
    return _only_where(text, has(text, r"[^\x00-\x7f]"), _fold)


_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32};?)"
# Names that count without a semicolon, the longest first
_SHORT = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
# Numbers that stand for another character than their own
_ODD = {str(n): html.unescape(f"&#{n};") for n in (0, 13, *range(0x80, 0xA0))}


def _of_number(digits: Column, base: int) -> Column:
    """The character of a numeric reference; numbers beyond Unicode give the replacement character."""
    digits = F.regexp_replace(digits, "^0+(?=.)", "")

    def char(n: Column) -> Column:
        odd = F.element_at(F.from_json(F.lit(json.dumps(_ODD)), "map<string,string>"), n.cast("string"))
        none = (
            n.between(1, 8) | (n == 11) | n.between(14, 31) | n.between(0x7F, 0x9F)
            | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
        )
        bytes_ = F.unhex(F.lpad(F.hex(n), 8, "0"))
        return (
            F.when(odd.isNotNull(), odd)
            .when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd")
            .when(none, "")
            .otherwise(F.decode(bytes_, "UTF-32"))
        )

    number = F.when(F.length(digits) <= 7, F.conv(digits, base, 10).cast("int")).otherwise(F.lit(0x110000))
    return bind(number, char)


def _of_name(name: Column) -> Column:
    """The characters of a name; of an unknown one, those of its longest part that counts alone."""
    known = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def short(part: Column) -> Column:
        return F.when(part == "", F.concat(F.lit("&"), name)).otherwise(
            F.concat(F.element_at(known, part), F.substr(name, F.length(part) + 1))
        )

    return F.coalesce(F.element_at(known, name), bind(F.regexp_extract(name, f"^(?:{_SHORT})", 0), short))


def unescape(text: Column) -> Column:
    """Decode all HTML entities."""
    # Fixed values
    usual = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\xa0"}

    def char(found: Column) -> Column:
        out = F.when(found.startswith("&#"), F.when(
            F.lower(F.substr(found, F.lit(3), F.lit(1))) == "x",
            _of_number(F.regexp_extract(found, "([0-9a-fA-F]+);?$", 1), 16),
        ).otherwise(_of_number(F.regexp_extract(found, "([0-9]+)", 1), 10)))
        for entity, value in usual.items():
            out = out.when(found == entity, value)
        return out.otherwise(_of_name(F.substr(found, F.lit(2))))

    return rewrite(text, _REFERENCE, char, needle="&")
