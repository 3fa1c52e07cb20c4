"""Small native expressions over arrays inside a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wikiloom.functions.text import bind

_BLOCK = 256


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def before(lengths: Column) -> Column:
    """For each item, the sum of the items before it, by sums of blocks of 256."""

    def by_blocks(items: Column) -> Column:
        count = F.floor((F.size(items) - 1) / _BLOCK).cast("int")
        sums = F.transform(
            F.sequence(F.lit(0), count), lambda b: total(F.slice(items, b * _BLOCK + 1, _BLOCK))
        )

        def place(sums: Column) -> Column:
            starts = F.transform(sums, lambda x, b: total(F.slice(sums, 1, b)))
            return bind(starts, lambda at: F.transform(
                items,
                lambda x, i: F.get(at, F.floor(i / _BLOCK).cast("int"))
                + total(F.slice(items, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, F.pmod(i, F.lit(_BLOCK)))),
            ))

        return bind(sums, place)

    empty = F.array().cast("array<bigint>")
    return bind(
        lengths.cast("array<bigint>"),
        lambda items: F.when(F.size(items) > 0, by_blocks(items)).otherwise(empty),
    )


def found(text: Column, pattern: str) -> Column:
    """Matches of a pattern, left to right: array of start, end (code points), value, gap before."""
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda p: (F.length(p["g"]) + F.length(p["v"])).cast("long"))
        return bind(before(lengths), lambda at: F.transform(pairs, lambda p, i: F.struct(
            (F.get(at, i) + F.length(p["g"])).cast("int").alias("start"),
            (F.get(at, i) + F.length(p["g"]) + F.length(p["v"])).cast("int").alias("end"),
            p["v"].alias("value"),
            p["g"].alias("gap"),
        )))

    pairs = bind(values, lambda v: F.zip_with(
        F.slice(gaps, F.lit(1), F.size(v)), v, lambda g, x: F.struct(g.alias("g"), x.alias("v"))
    ))
    return bind(pairs, spans)
