"""Token-id files in Simple-8b: 64-bit words that hold a varying number of ids.

The upper four bits of a word select how many ids its lower 60 bits hold and how wide they are.
Selector 15 is an escape: the next word holds one id of 64 bits. Ids are cut into blocks of equal
count, which are coded on their own; the word offset of each block is stored, so blocks are coded
and decoded side by side with numpy.

A segment is self-contained bytes: header, documents, block offsets, words, all little-endian.
Segments are rows of a Parquet table (``file``, ``segment``, ``data``), which any store that Spark
writes can hold; files and segments are in ascending order of document ids.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema, slices
from wikiloom.llm.tokens import encoder
from wikiloom.scale import scratch_path

# Fixed values of the coding: ids per word and bits per id, by selector
COUNTS = [240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 1]
WIDTHS = [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 60]
ESCAPE = 15
BLOCK = 4096
SEGMENT = 1 << 20
MAGIC = b"S8B1"
FILE_ROW = "file int, segment int, n_ids long, n_docs long, data binary"


def _selectors() -> list[tuple[int, int, int]]:
    """(selector, ids, bits), the most ids first; selector 1 holds two ids, not 120 zeros."""
    rows = [(s, c, w) for s, (c, w) in enumerate(zip(COUNTS, WIDTHS)) if s != 1]
    rows.append((1, 2, 30))
    return sorted(rows, key=lambda r: -r[1])


SELECTORS = _selectors()
_LENGTHS = np.array([i.bit_length() for i in range(1 << 16)], dtype=np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit length of each id, 64 at most."""
    out = np.zeros(len(ids), dtype=np.uint8)
    rest = ids.astype(np.uint64)
    while len(rest) and rest.max() >= 1 << 16:
        more = rest >= 1 << 16
        out[more] += 16
        rest = np.where(more, rest >> np.uint64(16), rest)
    return out + _LENGTHS[rest.astype(np.uint16)]


def _fits(bits: np.ndarray) -> np.ndarray:
    """For each place, the index in SELECTORS of the selector that takes the most ids from there."""
    n = len(bits)
    best = np.full(n, 255, dtype=np.uint8)
    top = {1: bits}
    span = 1
    while span * 2 <= 240:
        a = top[span]
        top[span * 2] = np.maximum(a[:-span], a[span:]) if len(a) > span else a[:0]
        span *= 2
    for index in range(len(SELECTORS) - 1, -1, -1):
        _, count, width = SELECTORS[index]
        if count > n:
            continue
        half = 1 << (count.bit_length() - 1)
        a = top[half]
        m = n - count + 1
        most = a[:m] if half == count else np.maximum(a[:m], a[count - half : count - half + m])
        best[:m][most <= width] = index
    return best


def encode_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks and the word offset at which each block starts (one more than blocks)."""
    n = len(ids)
    if n == 0:
        return np.empty(0, dtype="<u8"), np.zeros(1, dtype="<u4")
    ids = ids.astype(np.uint64)
    blocks = -(-n // BLOCK)
    # Zeros behind each block's end would change the choice, so ends are marked as too wide.
    grid = np.full((blocks, BLOCK + 1), 255, dtype=np.uint8)
    bits = _bits(ids)
    full = n // BLOCK
    grid[:full, :BLOCK] = bits[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        grid[full, : n - full * BLOCK] = bits[full * BLOCK :]
    best = _fits(grid.ravel())
    counts = np.array([c for _, c, _ in SELECTORS] + [1] * (256 - len(SELECTORS)), dtype=np.int32)
    step = counts[best].astype(np.int32)
    at = np.arange(blocks, dtype=np.int64) * (BLOCK + 1)
    ends = at + np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    chosen, live = [], np.arange(blocks)
    while len(live):  # all blocks advance by a word
        here = at[live]
        chosen.append((live, here))
        here = here + step[here]
        at[live] = here
        live = live[here < ends[live]]
    block = np.concatenate([b for b, _ in chosen])
    place = np.concatenate([p for _, p in chosen])
    order = np.argsort(place, kind="stable")
    block, place = block[order], place[order]
    pick = best[place]
    size = np.where(pick == 255, 2, 1)
    start = np.zeros(len(place) + 1, dtype=np.int64)
    np.cumsum(size, out=start[1:])
    words = np.zeros(start[-1], dtype=np.uint64)
    source = place - block  # places count one mark per block
    for index, (selector, count, width) in enumerate(SELECTORS):
        rows = np.flatnonzero(pick == index)
        if not len(rows):
            continue
        word = np.full(len(rows), selector, dtype=np.uint64) << np.uint64(60)
        if width:
            base = source[rows]
            for i in range(count):
                word |= ids[base + i] << np.uint64(i * width)
        words[start[rows]] = word
    rows = np.flatnonzero(pick == 255)
    if len(rows):
        words[start[rows]] = np.uint64(ESCAPE << 60)
        words[start[rows] + 1] = ids[source[rows]]
    first = np.searchsorted(block, np.arange(blocks + 1), side="left")
    return words.astype("<u8"), start[first].astype("<u4")


def decode_words(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids of some blocks, whose words begin at the given offsets."""
    words = words.astype(np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    escapes = np.flatnonzero(selector == ESCAPE)
    raw = np.zeros(len(words), dtype=bool)
    if len(escapes):
        # A raw word may look like an escape: runs are settled from their start, within blocks.
        previous, settled = -2, []
        for e in escapes.tolist():
            if e != previous + 1 or e in offsets:
                settled.append(e)
                previous = e
            else:
                previous = -2
        raw[np.array(settled) + 1] = True
    counts = np.zeros(16, dtype=np.int64)
    for s, c, _ in SELECTORS:
        counts[s] = c
    size = counts[selector]
    size[raw] = 1
    size[(selector == ESCAPE) & ~raw] = 0
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    starts = ends - size
    for s, c, w in SELECTORS:
        rows = np.flatnonzero((selector == s) & ~raw)
        if len(rows) and w:
            word, place, mask = words[rows], starts[rows], np.uint64((1 << w) - 1)
            for i in range(c):
                out[place + i] = (word >> np.uint64(i * w)) & mask
    out[starts[raw]] = words[raw]
    if len(out) != n:
        raise ValueError(f"{len(out)} ids instead of {n}")
    return out


def pack_segment(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    """Header, documents (id, null mark, ids) and coded ids as bytes."""
    words, offsets = encode_words(ids)
    keys = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    head = struct.pack("<4sIQQQI", MAGIC, BLOCK, len(doc_ids), len(ids), len(words), len(offsets))
    tables = keys.tobytes() + nulls.tobytes() + np.array(counts, dtype="<u8").tobytes()
    return head + tables + offsets.tobytes() + words.tobytes()


def unpack_segment(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, number of ids of each, and all ids."""
    magic, block, docs, n, n_words, n_offsets = struct.unpack_from("<4sIQQQI", data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of this format")
    at = struct.calcsize("<4sIQQQI")

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    keys, nulls, counts = take("<i8", docs), take("u1", docs), take("<u8", docs)
    offsets, words = take("<u4", n_offsets), take("<u8", n_words)
    ids = decode_words(words, offsets, n)
    return [None if z else k for k, z in zip(keys.tolist(), nulls.tolist())], counts, ids


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, out: str | None = None,
    text: str = "text", key: str = "doc_id",
) -> str:
    """Encode every text, append the end id, and write the files in ascending order of ids.

    Null texts count as empty. Null ids come first; rows with equal ids are ordered by a hash of
    their texts. Texts are dealt by range of ids, so one task holds one file's ids, a segment at a
    time. Returns the path of the files.
    """
    spark = docs.sparkSession
    out = out or scratch_path(spark, "token-files")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    order = ["doc_id", F.xxhash64("text")]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(tasks, "doc_id").sortWithinPartitions(*order)
    schema = arrow_schema(FILE_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        file, segment = TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            data = pack_segment(keys, [len(b) // 4 for b in held], ids)
            row = [[file], [segment], [len(ids)], [len(keys)], [data]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(row, schema)], schema=schema
            )

        for batch in batches:
            for piece in slices(batch, "text", 1 << 23):
                found = encode(piece.column("text"))
                for doc, ids in zip(piece.column("doc_id").to_pylist(), found):
                    keys.append(doc)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= SEGMENT:
                        yield flush()
                        keys, held, size, segment = [], [], 0, segment + 1
        if keys:
            yield flush()

    placed.mapInArrow(run, FILE_ROW).write.parquet(out)
    return out


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids.

    The start of a segment is a sum over one row per segment and file, which the driver adds up:
    a segment holds a million ids, so 1e12 ids make a million rows of three numbers.
    """
    files = spark.read.parquet(path)
    sizes = files.select("file", "segment", "n_ids").collect()
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: (r["file"], r["segment"])):
        starts.append((row["file"], row["segment"], total))
        total += row["n_ids"]
    table = spark.createDataFrame(starts, "file int, segment int, start long")
    ddl = "doc_id long, start long, n_tokens long, ids binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start in zip(batch.column("data"), batch.column("start").to_pylist()):
                keys, counts, ids = unpack_segment(data.as_buffer())
                counts = counts.astype(np.int64)
                at = np.cumsum(counts) - counts
                ids = ids.astype("<u4")
                cut = [ids[a : a + n].tobytes() for a, n in zip(at.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, type=pa.int64()),
                        pa.array(at + start, type=pa.int64()),
                        pa.array(counts, type=pa.int64()),
                        pa.array(cut, type=pa.binary()),
                    ],
                    schema=schema,
                )

    joined = files.select("file", "segment", "data").join(F.broadcast(table), ["file", "segment"])
    return joined.select("start", "data").mapInArrow(run, ddl)
