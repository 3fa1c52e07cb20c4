"""Exact duplicates by counting quotient filters and byte verification.

A text's 64-bit fingerprint is split: the leading bits name a filter block and a quotient in it, the
rest is the remainder. A block stores, per quotient in use, a run of sorted remainders, with a
bitmap of quotients in use, a bitmap of run ends, and a count per remainder. Each partition builds
the blocks of its own rows; blocks of equal number are merged by merging their sorted remainders and
adding the counts, so nothing is lost and a hot text is one entry per partition.

Fingerprints with a count above one are routed to verification: only their documents' texts are
grouped byte by byte. All others are single for certain.

Texts are equal when identical after replacing each run of blanks, tabs and line breaks by one
space; null counts as empty. Of equal texts the smallest id stays; a null id counts as smaller than
any other. Rows that repeat an id with an equal text each count and all carry the same flag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema
from wikiloom.scale import landed, lookup

QUOTIENT_BITS = 12  # quotients per block: 4096
BLOCK_ROWS = 1 << 16
FILTER_ROW = "block long, used binary, ends binary, remainders binary, counts binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def build_block(fingerprints: np.ndarray, counts: np.ndarray, shift: int) -> tuple[bytes, ...]:
    """Bitmaps, remainders and counts of sorted distinct fingerprints that share a block."""
    quotient = (fingerprints >> np.uint64(shift)) & np.uint64((1 << QUOTIENT_BITS) - 1)
    used = np.zeros(1 << QUOTIENT_BITS, dtype=bool)
    used[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)
    remainders = fingerprints & np.uint64((1 << shift) - 1)
    return (
        np.packbits(used).tobytes(),
        np.packbits(ends).tobytes(),
        remainders.astype("<u8").tobytes(),
        counts.astype("<u8").tobytes(),
    )


def read_block(
    block: int, used: bytes, ends: bytes, remainders: bytes, counts: bytes, shift: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of a block and their counts."""
    rest = np.frombuffer(remainders, "<u8")
    ends_at = np.unpackbits(np.frombuffer(ends, "u1"))[: len(rest)].astype(np.int64)
    run = np.cumsum(ends_at) - ends_at
    quotient = np.flatnonzero(np.unpackbits(np.frombuffer(used, "u1")))[run].astype(np.uint64)
    prefix = np.uint64(block) << np.uint64(shift + QUOTIENT_BITS) if shift + QUOTIENT_BITS < 64 else np.uint64(0)
    return prefix | (quotient << np.uint64(shift)) | rest, np.frombuffer(counts, "<u8")


def merge_sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted fingerprints and add the counts of equal ones."""
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")  # a merge of sorted runs
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else []
    return values[first], np.add.reduceat(counts, first) if len(values) else counts


def block_bits(rows: int) -> int:
    """So many leading bits that a block holds about BLOCK_ROWS rows, 6 at least."""
    return min(40, max(6, (max(rows, 1) // BLOCK_ROWS).bit_length()))


def partition_filters(prints: DataFrame, bits: int) -> DataFrame:
    """Filter blocks of each partition of a table with the long column ``print``."""
    shift = 64 - bits - QUOTIENT_BITS
    schema = arrow_schema(FILTER_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        held = 0

        def blocks() -> pa.RecordBatch:
            values, counts = merge_sorted(parts)
            number = (values >> np.uint64(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            edges = np.append(cut, len(values))
            rows = [
                (int(number[a]), *build_block(values[a:b], counts[a:b], shift))
                for a, b in zip(edges[:-1], edges[1:])
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(zip(*rows), schema)], schema=schema
            )

        for batch in batches:
            values, counts = np.unique(
                batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64),
                return_counts=True,
            )
            parts.append((values, counts.astype(np.uint64)))
            held += len(values)
            if held > 1 << 20:  # a filter of bounded size; the rest goes to another
                yield blocks()
                parts, held = [], 0
        if held:
            yield blocks()

    return prints.select("print").mapInArrow(run, FILTER_ROW)


def merged_counts(filters: DataFrame, bits: int) -> DataFrame:
    """Merge the blocks of all partitions; print and n of the fingerprints counted twice or more."""
    shift = 64 - bits - QUOTIENT_BITS

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = [
            read_block(r.block, r.used, r.ends, r.remainders, r.counts, shift)
            for r in group.itertuples(index=False)
        ]
        values, counts = merge_sorted(parts)
        many = counts > 1
        return pd.DataFrame(
            {"print": values[many].view(np.int64), "n": counts[many].astype(np.int64)}
        )

    return filters.groupBy("block").applyInPandas(merge, "print long, n long")


def repeated_prints(prints: DataFrame) -> DataFrame:
    """Fingerprints (long column ``print``) that occur twice or more, with their counts."""
    bits = block_bits(prints.count())
    return merged_counts(partition_filters(prints, bits), bits)


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, keep_id, group_size, kept, text_sha256."""
    norm = normalised(F.col(text))
    rows = docs.select(F.col(key).alias("doc_id"), norm.alias("norm"))
    narrow = landed(
        rows.select("doc_id", F.xxhash64("norm").alias("print"), F.sha2("norm", 256).alias("sha")),
        "dedup-prints",
    )
    again = landed(repeated_prints(narrow.select("print")), "dedup-repeated")
    # Texts of routed documents, grouped by their bytes. Spark copies the routed fingerprints to
    # all tasks only while they are under its size limit, and shuffles by fingerprint otherwise.
    routed = rows.withColumn("print", F.xxhash64("norm")).join(again.select("print"), "print")
    groups = landed(
        routed.groupBy("print", "norm")
        .agg(
            F.when(F.max(F.col("doc_id").isNull()), None)
            .otherwise(F.min("doc_id")).alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
        )
        .where("group_size > 1")
        .select("print", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"),
        "dedup-groups",
    )
    on = ["print", "sha"]
    sized = groups.select(*on, F.col("group_size").alias("_n"))
    joined = lookup(
        narrow, groups.withColumn("_grouped", F.lit(True)), on, ["doc_id"], "left", counts=sized
    )
    keep = F.when(F.col("_grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return joined.select(
        F.col("doc_id").alias(key),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
