"""Building blocks that keep hot keys and global orders spread over many tasks.

One key may hold a third of all rows, so nothing here gathers a group in one task:

* ``lookup`` joins to a table that is unique per key and salts only the keys found to be hot;
* ``with_index`` numbers rows in a global order from a range-partitioned sort, where a hot key
  simply spans several partitions;
* ``with_group_position`` turns that index into a position and a total per group.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
_NULL_SALTS = 1 << 20
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit
_MAP_BITS = 15  # a bitmap of Spark holds 2**15 bits


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names; make one only for a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="wikiloom-checkpoint-")
    sc.setCheckpointDir(named)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint, which survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds one row per key, safely for hot keys of ``left``.

    Keys with more than ``hot_rows`` rows in ``left`` are salted by a hash of the ``spread``
    columns, into so many pieces that each has about ``hot_rows`` rows, and only their rows of
    ``right`` are copied. The table of hot keys has at most ``count(left) / hot_rows`` rows, which
    bounds the broadcast. ``counts`` (the key and ``_n``) saves the count when the caller has it.
    """
    on = list(on)
    if counts is None:
        counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = (
        counts.where(F.col("_n") > hot_rows)
        .where(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
        .select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    hot = F.broadcast(hot)
    place = F.xxhash64(*spread)
    # Null keys match nothing; spreading them keeps an outer join from piling them up.
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    salt = F.when(no_key, F.pmod(place, F.lit(_NULL_SALTS))).otherwise(
        F.pmod(place, F.coalesce("_salts", F.lit(1)))
    )
    pieces = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_left = left.join(hot, on, "left").withColumn("_salt", salt.cast("int"))
    salted_right = right.join(hot, on, "left").withColumn("_salt", F.explode(pieces))
    return (
        salted_left.drop("_salts")
        .join(salted_right.drop("_salts"), [*on, "_salt"], how)
        .drop("_salt")
    )


def with_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """Add a consecutive 0-based index in the given order. Keep ``df`` narrow: it is checkpointed.

    The rows are sorted by range, so the work is split by volume, not by key. The offsets table
    has one row per partition.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    placed = durable(placed)
    part = F.shiftright("_mid", _ROW_BITS)
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition: pair every partition with those before it.
    table = sizes.agg(
        F.map_from_entries(F.collect_list(F.struct("_part", "_size"))).alias("_sizes")
    ).first()["_sizes"] or {}
    offsets, total = [], 0
    for number in sorted(table):
        offsets.append((number, total))
        total += table[number]
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets or [(0, 0)], "_part long, _start long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + row)
        .drop("_mid", "_part", "_start")
    )


def with_group_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    position: str = "position",
    total: str = "total",
) -> DataFrame:
    """Add the 1-based position of each row in its group and the size of the group."""
    keys = list(keys)
    indexed = with_index(df, [*keys, *order], "_idx")
    groups = indexed.groupBy(*keys).agg(
        F.min("_idx").alias("_first"), F.count(F.lit(1)).alias(total)
    )
    return (
        lookup(
            indexed, groups, keys, ["_idx"], "inner",
            counts=groups.withColumnRenamed(total, "_n"),
        )
        .withColumn(position, F.col("_idx") - F.col("_first") + 1)
        .drop("_idx", "_first")
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: str, last: bool = False) -> DataFrame:
    """Keep the first (or last) row per key by a unique order column.

    Only keys and order values are aggregated; the join back is on key and order, so copies of a
    hot key stay spread.
    """
    pick = F.max if last else F.min
    winners = df.groupBy(*keys).agg(pick(order).alias(order))
    return df.join(winners, [*keys, order], "left_semi")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, for tables written on the way."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


PART_ROWS = 10_000


def listed_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    item: Column,
    name: str,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Collect the items of each group in order, in parts of at most ``part_rows``.

    Nearly every group has the one part 0; a hot group has more rows, each of bounded size.
    """
    placed = with_group_position(df, keys, order, "_position", f"{name}_count")
    return (
        placed.withColumn("part", F.floor((F.col("_position") - 1) / part_rows).cast("int"))
        .groupBy(*keys, "part", f"{name}_count")
        .agg(F.sort_array(F.collect_list(F.struct("_position", item.alias("item")))).alias("_rows"))
        .select(*keys, "part", f"{name}_count", F.col("_rows.item").alias(name))
    )


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps read only what they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rows_among(
    df: DataFrame, numbers: DataFrame, row: str, name: str, among: bool = True
) -> DataFrame:
    """Rows of ``df`` whose number in the column ``row`` is one of ``numbers``, or those whose number is not.

    Numbers (not negative, dense within files or partitions) are written as bitmaps of 2**15 rows each, a bit a row,
    so Spark copies them to all tasks under its size limit and moves no rows of ``df`` for far more
    rows than if the numbers were joined as they are. Beyond that limit rows are joined by bitmap.
    """
    block, place = F.shiftright(row, _MAP_BITS), F.col(row).bitwiseAND(F.lit((1 << _MAP_BITS) - 1))
    # Dealt by bitmap first: else each task would send a part of each bitmap.
    dealt = numbers.select(block.alias("_block"), place.alias("_place")).repartition("_block")
    maps = landed(dealt.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits")), name)
    byte = F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int"))
    marked = df.withColumn("_block", block).join(maps, "_block", "inner" if among else "left")
    return marked.where(bit == 1 if among else F.coalesce(bit, F.lit(0)) == 0).select(*df.columns)


def spread_scan(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deal out the rows of a file scan that has fewer splits than there are cores.

    Parquet is split no finer than its row groups, too coarse for CPU-bound text work on small
    tables. Large tables have splits enough and are left alone. Only for plain scans.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
