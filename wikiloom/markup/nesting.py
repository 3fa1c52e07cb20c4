"""Rewriting nested elements from the inside out, as deep as each body is nested."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.text import bind, rewrite


def innermost(tag: str) -> str:
    """Pattern for an element that holds no element of its own kind.

    The loop is possessive, so the matcher needs no stack however long the body is.
    """
    return rf"<{tag}(?=[\s>])[^>]*+>(?:[^<]++|<(?!/?{tag}[\s>]))*+</{tag}>"


def depth(body: Column, tag: str) -> Column:
    tags = F.regexp_extract_all(body, F.lit(rf"<(/?){tag}[\s>]"), F.lit(1))
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, slash: Column) -> Column:
        now = F.when(slash == "", acc["now"] + 1).otherwise(
            F.greatest(acc["now"] - 1, F.lit(0))
        )
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(tags, zero, step, lambda acc: acc["most"])


def rewrite_nested(text: Column, tag: str, replace: Callable[[Column], Column]) -> Column:
    """Replace all elements of a kind, innermost first, once per level of nesting."""

    def passes(body: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.greatest(depth(body, tag), F.lit(1)))
        done = F.aggregate(rounds, body, lambda acc, _: rewrite(acc, innermost(tag), replace))
        return F.when(F.contains(body, F.lit(f"<{tag}")), done).otherwise(body)

    return bind(text, passes)
