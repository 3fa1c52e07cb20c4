"""Running values over a global order, in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1024


def running(
    df: DataFrame, keys: Sequence[str], index: str, value: str, name: str, rows: int,
    gather: Callable[[str], Column], join: Callable[[Column, Column], Column],
) -> DataFrame:
    """Add ``name``: the values before each row, gathered by key in the order of ``index``.

    ``index`` counts rows up to ``rows``. Windows hold a chunk of 1024 places each; the totals of
    chunks are gathered in the same way, level by level. It is null where nothing comes before.
    Keys must not be null.
    """
    before = (Window.unboundedPreceding, -1)
    if rows <= CHUNK:
        window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(index).rowsBetween(*before)
        return df.withColumn(name, gather(value).over(window))
    # Each level has names of its own, as the columns of one are the input of the next.
    chunk, inside, whole, outside = (f"{index}_{part}" for part in ("chunk", "in", "total", "out"))
    placed = df.withColumn(chunk, F.floor(F.col(index) / CHUNK).cast("long"))
    window = Window.partitionBy(*keys, chunk).orderBy(index).rowsBetween(*before)
    inner = placed.withColumn(inside, gather(value).over(window))
    totals = placed.groupBy(*keys, chunk).agg(gather(value).alias(whole))
    totals = running(totals, keys, chunk, whole, outside, rows // CHUNK + 1, gather, join)
    out = inner.join(totals.drop(whole), [*keys, chunk], "left")
    both = F.when(F.col(inside).isNull(), F.col(outside)).when(
        F.col(outside).isNull(), F.col(inside)
    ).otherwise(join(F.col(outside), F.col(inside)))
    return out.withColumn(name, both).drop(chunk, inside, outside)


def running_sum(
    df: DataFrame, keys: Sequence[str], index: str, value: str, name: str, rows: int
) -> DataFrame:
    out = running(df, keys, index, value, name, rows, F.sum, lambda a, b: a + b)
    return out.withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def running_max(
    df: DataFrame, keys: Sequence[str], index: str, value: str, name: str, rows: int
) -> DataFrame:
    return running(df, keys, index, value, name, rows, F.max, lambda a, b: F.greatest(a, b))
