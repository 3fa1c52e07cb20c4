"""Connected components of a link table, with hot vertices kept spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.scale import landed


def components(links: DataFrame) -> DataFrame:
    """Component (its smallest vertex) of every vertex of a table of links ``a``, ``b``.

    Alternates two steps until nothing changes: each vertex links its larger neighbours to its
    smallest neighbour or itself, then each links its smaller neighbours and itself to the smallest.
    Both end in stars. A hot vertex is met only in minima, which tasks combine before the shuffle,
    and in joins to one row per vertex. Links are written to the shared folder between steps.
    """
    links = landed(
        links.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "links",
    )
    size = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = landed(large.where("a <> b").distinct(), "links-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))
        )
        links = landed(small.where("a <> b").distinct(), "links-small")
        # Stars at rest: every vertex has one smaller neighbour, which has none itself.
        state = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if (state["n"], state["h"]) == size:
            break
        size = (state["n"], state["h"])
    roots = links.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct()
    return links.select("a", F.col("b").alias("component")).union(roots).withColumnRenamed("a", "vertex")
