"""Internal marks, all Unicode noncharacters, which no text for interchange holds.

Code is *armoured*: characters that a later rule could touch are swapped for marks and swapped
back at the very end, so code passes through all rules unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.text import bind

_PLAIN = "<>*#\n \t\r&"
# Their bytes begin with others than those of the marks below, so that a search for a mark does not stop at
# every blank of code.
_ARMOURED = "".join(chr((4 + i) * 0x10000 + 0xFFFE) for i in range(len(_PLAIN)))
NEWLINE_MARK = _ARMOURED[_PLAIN.index("\n")]

COLUMN_OPEN, COLUMN_CLOSE = chr(0xFDD9), chr(0xFDDA)
BOLD_OPEN, BOLD_CLOSE = chr(0xFDDB), chr(0xFDDC)
ITALIC_OPEN, ITALIC_CLOSE = chr(0xFDDD), chr(0xFDDE)
TITLE_OPEN, TITLE_CLOSE = chr(0xFDDF), chr(0xFDE0)
LINES_OPEN, LINES_CLOSE = chr(0xFDE2), chr(0xFDE3)  # around the lines of a list
TABLE_OPEN, TABLE_HALF, TABLE_CLOSE = chr(0xFDE4), chr(0xFDE5), chr(0xFDE6)
GUARD = chr(0xFDE1)  # stands before armoured text, so that a literal search finds any


def swap(text: Column, signs: str, others: str) -> Column:
    """``translate`` by searches for one sign after the other, which make no string of each character."""
    for i, sign in enumerate(signs):
        text = F.replace(text, F.lit(sign), F.lit(others[i : i + 1]))
    return text


def armour(text: Column) -> Column:
    return F.concat(F.lit(GUARD), swap(text, _PLAIN, _ARMOURED))


def armour_shown(text: Column) -> Column:
    """Armour for rendered code, whose entities are still to be decoded."""
    return F.concat(F.lit(GUARD), swap(text, _PLAIN[:-1], _ARMOURED[:-1]))


def armoured(text: str) -> str:
    return GUARD + text.translate(str.maketrans(_PLAIN, _ARMOURED))


def disarm(text: Column) -> Column:
    return bind(
        text,
        lambda body: F.when(
            F.contains(body, F.lit(GUARD)), swap(body, _ARMOURED + GUARD, _PLAIN)
        ).otherwise(body),
    )


def title_mark(title: Column) -> Column:
    """A page title whose wiki title is made later, after accents are folded."""
    return F.concat(F.lit(TITLE_OPEN), title, F.lit(TITLE_CLOSE))
