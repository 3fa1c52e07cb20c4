"""Near copies by SimHash fingerprints, joined exactly by covering locality-sensitive hashing.

A fingerprint has a bit set where more than half of a text's shingle hashes have it. Two fingerprints
link at ``radius`` differing bits or fewer. Every bit gets a vector of radius + 1 bits; for each vector
v but zero, a mask holds the bits whose vector has an odd product with v. The vectors of up to
``radius`` differing bits never span the whole space, so some v is orthogonal to all of them: in that
mask's table both fingerprints look equal. Every pair within the radius therefore meets in one of the
2 ** (radius + 1) - 1 tables, and no pair is lost. The vectors are dealt evenly, so a mask keeps half
of the 64 bits and a bucket holds few fingerprints by chance.

Equal fingerprints are one row of the join, however many texts share them. Fingerprints of a bucket
agree in the mask, so they differ only in the other half: a bucket of more than ``HOT`` rows is dealt
anew by covering masks over those bits, after which at most some 16 bits are free and a bucket has no
more than 2 ** 16 distinct rows. Within a bucket a search from row to row gives the links of a spanning
forest, never all pairs.

Null text, empty text and text without words have fingerprint zero, which links like any other. Rows
with null or repeated ids each give a row; null ids do not count for the smallest id unless there is no
other. Extra columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema, per_row
from wikiloom.llm.components import components
from wikiloom.llm.pieces import pieces
from wikiloom.scale import landed, lookup

BITS = 64
SEED = 42
HOT = 4096
SMALL = 8


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bits, one per vector; any ``radius`` bits miss at least one mask."""
    vectors = list(range(1, 1 << (radius + 1)))
    random.Random(len(bits)).shuffle(vectors)
    of = {bit: vectors[i % len(vectors)] for i, bit in enumerate(bits)}
    return [sum(1 << b for b in bits if (of[b] & v).bit_count() % 2) for v in sorted(vectors)]


def fingerprint(data: bytes | None, words: int) -> int:
    """The fingerprint of a text in UTF-8; a text of fewer words is one shingle."""
    digest = xxhash.xxh64_intdigest
    held: list[bytes] = []
    counts, n = np.zeros(BITS, dtype=np.int64), 0

    def add(shingles: Iterator[bytes]) -> int:
        hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add(counts, bits.sum(axis=0, dtype=np.int64), out=counts)
        return len(hashes)

    for piece in pieces((data or b"").lower()):
        held += piece.split()
        if len(held) >= words:
            n += add(map(b" ".join, zip(*(held[i:] for i in range(words)))))
            held = held[len(held) - words + 1 :]
    if n == 0 and held:
        n = add(iter([b" ".join(held)]))
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, text: str, key: str) -> DataFrame:
    """Per row: doc_id and fp, the fingerprint as a signed long."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    )

    def make():
        def run(texts: list, batch: pa.RecordBatch) -> dict:
            found = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            return {"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))}

        return run

    return per_row(rows, "text", f"doc_id {kind}, fp long", make)


def forest(points: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of distinct fingerprints; each is compared with those not yet reached."""
    found, rest = [], points
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            point = reached.pop()
            near = np.bitwise_count(rest ^ point) <= radius
            if near.any():
                new = rest[near]
                found.append((np.full(len(new), point), new))
                reached.extend(new)
                rest = rest[~near]
    return found


def bucket_links(bucket: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole buckets that lie one after the other."""
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    sizes = np.diff(np.append(first, len(bucket)))
    found = []
    small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    live = np.flatnonzero(small)
    for step in range(1, SMALL):  # small buckets, all at once
        live = live[live + step < len(bucket)]
        live = live[bucket[live] == bucket[live + step]]
        near = live[np.bitwise_count(fp[live] ^ fp[live + step]) <= radius]
        found.append((fp[near], fp[near + step]))
    for at in np.flatnonzero(sizes > SMALL).tolist():
        found += forest(fp[first[at] : first[at] + sizes[at]], radius)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def links_in_buckets(rows: DataFrame, radius: int) -> DataFrame:
    """Links a, b within buckets of rows (bucket, fp)."""
    ddl = "a long, b long"
    schema = arrow_schema(ddl)
    dealt = rows.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0,), np.int64), np.empty((0,), np.uint64)

        def links(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = bucket_links(bucket, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], schema=schema)

        for batch in batches:
            bucket = np.concatenate([held[0], batch.column("bucket").to_numpy()])
            fp = np.concatenate([held[1], batch.column("fp").to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0
            if whole:
                yield links(bucket[:whole], fp[:whole])
            held = bucket[whole:], fp[whole:]
        if len(held[0]):
            yield links(*held)

    return dealt.mapInArrow(run, ddl)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _masked(fp: Column, masks: list[int]) -> Column:
    """One struct (table, part) per mask."""
    return F.array(*[
        F.struct(F.lit(i).alias("table"), fp.bitwiseAND(F.lit(_signed(m))).alias("part"))
        for i, m in enumerate(masks)
    ])


def covering_links(points: DataFrame, radius: int) -> DataFrame:
    """Links a, b that connect all pairs of distinct fingerprints within the radius."""
    masks = covering_masks(list(range(BITS)), radius)
    fp = F.col("fp")
    keyed = points.select("fp", F.explode(_masked(fp, masks)).alias("at")).select("fp", "at.*")
    keyed = keyed.withColumn("bucket", F.xxhash64("table", "part"))
    hot = landed(
        keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT).select("bucket"),
        "simhash-hot",
    )
    if hot.isEmpty():
        return links_in_buckets(keyed, radius)
    deeper = F.lit(None).cast("array<struct<table:int,part:bigint>>")
    for i, mask in enumerate(masks):
        free = [b for b in range(BITS) if not mask >> b & 1]
        deeper = F.when(F.col("table") == i, _masked(fp, covering_masks(free, radius))).otherwise(deeper)
    deep = (
        keyed.join(hot, "bucket", "left_semi")
        .select("fp", "bucket", F.explode(deeper).alias("at"))
        .select("fp", F.xxhash64("bucket", "at.table", "at.part").alias("bucket"))
    )
    cold = keyed.join(hot, "bucket", "left_anti").select("fp", "bucket")
    return links_in_buckets(cold.unionByName(deep), radius)


def simhash_components(
    docs: DataFrame, words: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id (the smallest id reachable by links)."""
    table = landed(fingerprints(docs, words, text, key), "simhash-texts")
    points = landed(
        table.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("_n")),
        "simhash-points",
    )
    joined = landed(components(covering_links(points.select("fp"), radius)), "simhash-components")
    placed = points.join(joined.withColumnRenamed("vertex", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("component", "fp").alias("component")
    )
    least = placed.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n")
    )
    named = lookup(
        placed.select("fp", "component"), least.drop("_n"), ["component"], ["fp"], "inner",
        counts=least.select("component", "_n"),
    )
    whole = lookup(
        table, named.select("fp", "component_id"), ["fp"], ["doc_id"], "inner",
        counts=points.select("fp", "_n"),
    )
    return whole.select(
        F.col("doc_id").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
