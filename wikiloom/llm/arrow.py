"""Helpers for Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_BYTES = 16 << 20
SHORT_BYTES = 4 << 20


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Texts that are written within go to Python in batches of some megabytes, as batches lie in the memory of both
    processes of each task, beside Spark's own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SHORT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Return unused Arrow memory of this worker: it lives on after its task and shares an executor's memory."""
    pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of one column pass a bound; a longer value stands alone."""
    rows = batch.num_rows
    values = batch.column(column)
    lengths = [0 if n is None else n for n in pa.compute.binary_length(values).to_pylist()]
    start, held = 0, 0
    for row, n in enumerate(lengths):
        if row > start and held + n > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += n
    if rows > start:
        yield batch.slice(start, rows - start)


def per_row(
    df: DataFrame, column: str, ddl: str, make: Callable[[], Callable[[list, pa.RecordBatch], dict]]
) -> DataFrame:
    """Map batches: ``make()`` runs once per task and gives f(values of column, batch) -> columns."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for piece in slices(batch, column):
                out = f(piece.column(column).to_pylist(), piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        out[s.name] if isinstance(out[s.name], pa.Array)
                        else pa.array(out[s.name], type=s.type)
                        for s in schema
                    ],
                    schema=schema,
                )

    return df.mapInArrow(run, ddl)
