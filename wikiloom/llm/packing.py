"""Concatenate and cut: documents' ids in one row, cut into windows of equal length.

Pass one encodes each partition and writes ids with their place in the partition; pass two adds the
partitions' totals up and cuts each document where its global places cross a window's bound. A
document over a bound has one boundary record for each window that it touches. Only the last window
is not full, so at most one window's length of padding is needed in all.

Null texts count as empty and consist of the end id. Rows with equal ids stay separate rows. An
empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema, short_batches, slices
from wikiloom.llm.tokens import encoder
from wikiloom.scale import landed

WINDOW = 2048


def encode_placed(
    docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Pass one: part, place (ids before it in its part), key, n (ids with the end id), ids."""
    ddl = f"part int, place long, `{key}` {docs.schema[key].dataType.simpleString()}, n long, ids binary"
    rows = docs.select(key, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "_text", 1 << 22):
                ids = [b + end for b in encode(piece.column("_text"))]
                n = np.array([len(b) // 4 for b in ids], dtype=np.int64)
                ends = place + np.cumsum(n)
                place = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, dtype=np.int32)),
                        pa.array(ends - n),
                        piece.column(key),
                        pa.array(n),
                        pa.array(ids, type=pa.binary()),
                    ],
                    schema=schema,
                )

    return rows.mapInArrow(run, ddl)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Pieces: key, start, length, doc_tokens, sequence_id, offset, ids (binary, 4 bytes each).

    The encoded table is written once, so places hold even if a task is run again. Partition totals
    are one row per partition; the driver adds them up.
    """
    spark = docs.sparkSession
    with short_batches(spark):
        placed = landed(encode_placed(docs, tokenizer, end_id, text, key), "packing-ids")
    sums = placed.groupBy("part").agg(F.max(F.col("place") + F.col("n")).alias("n")).collect()
    starts, total = [], 0
    for row in sorted(sums, key=lambda r: r["part"]):
        starts.append((row["part"], total))
        total += row["n"]
    table = spark.createDataFrame(starts, "part int, _before long")
    begin = F.col("_before") + F.col("place")
    size = F.lit(window).cast("long")

    def piece(number):
        first = F.greatest(number * size, F.col("_begin"))
        last = F.least((number + 1) * size, F.col("_begin") + F.col("n"))
        start = (first - F.col("_begin")).cast("int")
        return F.struct(
            start.cast("long").alias("start"),
            (last - first).alias("length"),
            number.alias("sequence_id"),
            (first - number * size).alias("offset"),
            F.substring("ids", start * 4 + 1, (last - first).cast("int") * 4).alias("ids"),
        )

    def window_of(place):
        return ((place - F.pmod(place, size)) / size).cast("long")

    numbers = F.sequence(window_of(F.col("_begin")), window_of(F.col("_begin") + F.col("n") - 1))
    return (
        placed.join(F.broadcast(table), "part")
        .withColumn("_begin", begin)
        .select(F.col(key), F.col("n").alias("doc_tokens"), F.transform(numbers, piece).alias("_p"))
        .select(key, "doc_tokens", F.inline("_p"))
    )
