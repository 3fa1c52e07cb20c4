"""Long texts in pieces, so that a task never holds the words of a whole text."""

from __future__ import annotations

import re
from collections.abc import Iterator

PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces of about a megabyte that end before a blank or line break."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end
