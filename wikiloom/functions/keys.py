"""Names on the target side: identifiers, wiki titles, file names, anchors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.text import DIGIT, SPACE, WORD, decode_common, drop_tags, fold, strip

IDENTIFIER_LENGTH = 100
TITLE_LENGTH = 255


def identifier(raw: Column) -> Column:
    """Project identifier; null when nothing is left."""
    kept = F.regexp_replace(F.lower(strip(fold(raw))), r"[^\p{L}\p{N}_-]", "")
    return F.nullif(F.substring(kept, 1, IDENTIFIER_LENGTH), F.lit(""))


def _title_words(folded: Column) -> Column:
    kept = F.regexp_replace(folded, rf"[^{WORD}{SPACE}-]", "")
    return F.regexp_replace(strip(kept), rf"[{SPACE}]+", "_")


def _finish_title(words: Column) -> Column:
    prefixed = F.regexp_replace(words, r"^(?=\p{N})", "Page_")
    return F.when(words == "", F.lit("Untitled")).otherwise(
        F.substring(prefixed, 1, TITLE_LENGTH)
    )


def wiki_title_of_folded(folded: Column) -> Column:
    """``wiki_title`` for text that ``fold`` has already seen."""
    undotted = F.regexp_replace(folded, rf"(?<={DIGIT})\.(?={DIGIT})", "_")
    words = _title_words(undotted)
    padded = F.regexp_replace(words, rf"(?<!{DIGIT})({DIGIT})(?!{DIGIT})", "00$1")
    padded = F.regexp_replace(padded, rf"(?<!{DIGIT})({DIGIT}{DIGIT})(?!{DIGIT})", "0$1")
    return _finish_title(padded)


def wiki_title(title: Column) -> Column:
    """Wiki title whose numbers are padded to three digits, so that they sort as numbers."""
    return wiki_title_of_folded(fold(title))


def wiki_title_plain_of_folded(folded: Column) -> Column:
    return _finish_title(_title_words(folded))


def wiki_title_plain(title: Column) -> Column:
    """Wiki title with the numbers left as they are."""
    return wiki_title_plain_of_folded(fold(title))


def file_name(name: Column) -> Column:
    """Safe file name: unsafe characters of the stem become single underscores."""
    # The extension starts at the last dot of the last path part, leading dots aside.
    split = r"(?s)^(.*/)?(\.*)([^/]*?)(\.[^./]*)?$"
    stem = F.concat(*[F.regexp_extract(name, split, i) for i in (1, 2, 3)])
    extension = F.regexp_extract(name, split, 4)
    safe = F.regexp_replace(stem, rf"[^{WORD}.-]", "_")
    safe = F.regexp_replace(F.regexp_replace(safe, "_+", "_"), "^_+|_+$", "")
    return F.concat(F.when(safe == "", F.lit("attachment")).otherwise(safe), extension)


def heading_anchor(heading: Column) -> Column:
    """Anchor that the target wiki gives a heading."""
    clean = decode_common(drop_tags(heading))
    clean = F.regexp_replace(clean, rf"[^{WORD}{SPACE}-]", "")
    clean = F.regexp_replace(clean, rf"[{SPACE}]+[{SPACE}-]*", "-")
    return F.regexp_replace(clean, "^-+|-+$", "")


def fingerprint(body: Column) -> Column:
    return F.substring(F.md5(body), 1, 12)
