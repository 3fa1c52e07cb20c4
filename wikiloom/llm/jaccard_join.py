"""Exact Jaccard join of texts as a join of regions in the metric space of shingle sets.

The distance 1 - J of two sets is a metric. Texts with equal sets are one point. The space is cut
in three steps, each exact: no pair within the radius is lost.

1. Size pivots. The distance to the set of all shingles depends on the size only, so sizes form
   shells; a point near the lower bound of the next shell is copied into it, as its partner may lie
   there.
2. Regions. Two points of a shell within the radius differ in at most d shingles. Shingles are dealt
   by hash into d + 1 parts and some more for parts that are empty, so such points agree on a whole
   part that is not empty: that part's content names a region. (Plain document pivots cannot
   cut the whole corpus: nearly all texts are at distance 1 from each other, so every window
   would hold every point.) Points with too many empty parts deal their shingles anew, by
   another hash, beneath each of the first empty parts.
3. Pivots. In each region the smallest point is the pivot. The distance of the others to it is
   bounded from sketches (shingles per hash bucket) and computed where the bound lies within the
   radius. Points within the radius of the pivot are linked to it, and need no links among each
   other: they are one component. A pair whose distances to the pivot differ by more than the
   radius cannot be linked. What is left, the points outside the ball and those of the ball in the
   window that the triangle inequality leaves, is cut into blocks of bounded size, which are
   joined recursively around pivots of their own (``near_pairs``), on sketches, whose distance
   never exceeds that of the sets. The pairs that are left are compared exactly: first those
   that connect points, then, from the components these links give, all that lie between two.

Most keys occur once. Tasks therefore send sorted blocks of shortened keys, as differences, with the
place of one point for each; only keys that meet again become rows. Shortened keys may name one
region for two keys, which costs time and loses nothing. Regions that hold the same points are one.

Hot regions are never gathered: a task sends one entry for a key however many of its points have it
and passes the other points on, the pivot is a minimum, members are joined to it in salted pieces,
and blocks hold BLOCK rows each.

Null text counts as empty; a text without words has an empty set and is linked with nothing. Rows
with equal ids each get a row. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema, give_back, short_batches, slices
from wikiloom.llm.components import components
from wikiloom.llm.shingles import SLICE, mix, shingle_sets
from wikiloom.scale import landed, lookup, rows_among

SHELL_RATIO = 1.3
BUCKETS = 256
FOLD = 4
CHUNK_KEYS = 1 << 20
BUCKET_KEYS = 1 << 22
SPARE_BITS = 10
BLOCK = 512
LEAF = 64
_PART, _SHELL, _CONTENT = (np.uint64(c) for c in (1000003, 0x51ED270B7A1B, 0x77))


class Shells:
    """Size shells and the number of parts in each, for a similarity in percent."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(max(bounds[-1] + 1, int(bounds[-1] * SHELL_RATIO)))
        self.bounds = bounds
        self.array = np.array(bounds, dtype=np.int64)
        self._parts: dict[int, tuple[int, int]] = {}

    def of(self, size: int) -> list[int]:
        """The shell of a size, and the next if a partner may lie there."""
        at = int(np.searchsorted(self.array, size, side="right")) - 1
        if 100 * size >= self.percent * self.bounds[at + 1]:
            return [at, at + 1]
        return [at]

    def parts(self, shell: int) -> tuple[int, int]:
        """Number of parts, and how many of them may be empty."""
        if shell not in self._parts:
            most = self.bounds[shell + 1] - 1
            least = max(1, math.ceil(self.bounds[shell] * self.percent / 100))
            differ = 2 * most * (100 - self.percent) // (100 + self.percent)
            spare = 0
            for _ in range(20 if differ else 0):
                n = differ + 1 + spare
                empty = n * math.exp(-least / n)
                spare = max(spare, math.ceil(empty + 3 * math.sqrt(empty)) if empty > 0.02 else 0)
            self._parts[shell] = (differ + 1 + spare, spare)
        return self._parts[shell]

    def keys(self, points: np.ndarray) -> np.ndarray:
        """Region keys of a set."""
        if not len(points):
            return points
        found = [self._deal(points, shell, 0, 0) for shell in self.of(len(points))]
        return np.concatenate(found)

    def _deal(self, points: np.ndarray, shell: int, seed: int, depth: int) -> np.ndarray:
        n, spare = self.parts(shell)
        salt = mix(np.array([(shell + 1) * 7919 + seed], dtype=np.uint64))
        part = (mix(points ^ salt) % np.uint64(n)).astype(np.uint32)
        order = np.argsort(part, kind="stable")
        sorted_part = part[order]
        first = np.flatnonzero(np.append(True, sorted_part[1:] != sorted_part[:-1]))
        content = np.add.reduceat(mix(points[order] ^ _CONTENT), first)
        named = sorted_part[first].astype(np.uint64)
        out = mix(content + named * _PART + salt)
        if n - len(first) > spare:
            empty = np.setdiff1d(np.arange(n), sorted_part[first])
            empty = empty[: len(empty) - spare]
            if depth < 2:
                deeper = [
                    self._deal(points, shell, seed * 1009 + int(e) + 1, depth + 1) for e in empty
                ]
                return np.concatenate([out, *deeper])
            return np.concatenate([out, mix(empty.astype(np.uint64) * _PART + salt)])
        return out


def set_name(points: np.ndarray) -> int:
    """A 64-bit name of a set, equal for equal sets."""
    total = mix(np.array([mix(points).sum(dtype=np.uint64)], dtype=np.uint64) + np.uint64(len(points)))
    return int(total.view(np.int64)[0])


def sketch_of(points: np.ndarray) -> bytes:
    """Shingles per hash bucket, cut at 255: their differences sum to at most those of the sets.

    Larger sets have more buckets, of four shingles at most on average; halves add up to fewer.
    """
    width = BUCKETS
    while 4 * width < len(points):
        width *= 2
    bucket = (mix(points ^ np.uint64(0xB0C)) % np.uint64(width)).astype(np.int64)
    return np.minimum(np.bincount(bucket, minlength=width), 255).astype(np.uint8).tobytes()


def folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of the given width, which none falls short of."""
    out = np.empty((len(sketches), width), dtype=np.int32)
    sizes = np.array([len(s) for s in sketches])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        same = np.frombuffer(b"".join([sketches[i] for i in at]), np.uint8)
        out[at] = same.reshape(len(at), -1, width).sum(axis=1, dtype=np.int32)
    return out


def varints(values: np.ndarray) -> bytes:
    """Numbers in as many bytes as they need, seven bits in each, the lowest first."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 10):
        size += values >= np.uint64(1 << 7 * k)
    starts = np.cumsum(size) - size
    out = np.empty(int(size.sum()), dtype=np.uint8)
    for i in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > i)
        low = (values[has] >> np.uint64(7 * i)) & np.uint64(127)
        out[starts[has] + i] = low.astype(np.uint8) | ((size[has] > i + 1).astype(np.uint8) << 7)
    return out.tobytes()


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    out = np.zeros(len(ends), dtype=np.uint64)
    for i in range(int((ends - starts).max(initial=-1)) + 1):
        has = np.flatnonzero(ends - starts >= i)
        out[has] |= (raw[starts[has] + i] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * i)
    return out


def near_pairs(
    vectors: np.ndarray, sizes: np.ndarray, groups: np.ndarray, percent: int, forest: bool = False
) -> np.ndarray:
    """Pairs of rows that may be within the radius, by recursion around pivots.

    ``vectors`` are bucket counts with the sum of differences as the metric. Around a pivot the rows
    are halved by distance; a pair over the middle needs both ends in the window around it. Rows of
    one group are not paired. With ``forest`` a pair joins its rows' groups, so of the pairs only as
    many are given as it takes to connect their rows. Buckets are folded first, which brings vectors only closer; the whole
    vectors decide about pairs that are left.
    """
    found: list[np.ndarray] = []
    whole = vectors.astype(np.int32)
    vectors = whole.reshape(len(whole), -1, FOLD).sum(axis=2, dtype=np.int32)
    share = 2 * (100 - percent) / (100 + percent)
    groups = groups.copy()

    def compare(a: np.ndarray, b: np.ndarray | None) -> None:
        for at, row in enumerate(a.tolist()):
            rest = a[at + 1 :] if b is None else b
            small = np.minimum(sizes[rest], sizes[row])
            large = np.maximum(sizes[rest], sizes[row])
            rest = rest[(groups[rest] != groups[row]) & (100 * small >= percent * large)]
            if len(rest):
                apart = np.abs(vectors[rest] - vectors[row]).sum(axis=1)
                close = (100 + percent) * apart <= (100 - percent) * (sizes[rest] + sizes[row])
                hit = rest[close]
                if len(hit):
                    apart = np.abs(whole[hit] - whole[row]).sum(axis=1)
                    close = (100 + percent) * apart <= (100 - percent) * (sizes[hit] + sizes[row])
                    hit = hit[close]
                if forest and len(hit):
                    joined, first = np.unique(groups[hit], return_index=True)
                    hit = hit[first]
                    groups[np.isin(groups, joined)] = groups[row]
                if len(hit):
                    found.append(np.stack([np.full(len(hit), row), hit], axis=1))

    def split(rows: np.ndarray) -> None:
        if len(rows) <= LEAF or (groups[rows] == groups[rows[0]]).all():
            compare(rows, None)
            return
        away = np.abs(vectors[rows] - vectors[rows[0]]).sum(axis=1)
        radius = share * sizes[rows].max()
        middle = np.median(away)
        low, high = rows[away <= middle], rows[away > middle]
        window_low = rows[(away <= middle) & (away >= middle - radius)]
        window_high = rows[(away > middle) & (away <= middle + radius)]
        if not len(high) or len(window_low) + len(window_high) > 0.9 * len(rows):
            compare(rows, None)  # the pivot does not separate these
            return
        split(low)
        split(high)
        compare(window_low, window_high)

    if len(vectors):
        split(np.arange(len(vectors)))
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


def described(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row (doc_id, row, text): doc_id, row, n (set size), point (name of the set, null if empty),
    most (about as many region keys) and sketch."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, row long, n long, point long, most long, sketch binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shells = Shells(percent)
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                sets = shingle_sets(piece.column("text").to_pylist(), words)
                most = [sum(shells.parts(k)[0] for k in shells.of(len(s))) if len(s) else 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("row"),
                        pa.array([len(s) for s in sets], type=pa.int64()),
                        pa.array([set_name(s) if len(s) else None for s in sets], type=pa.int64()),
                        pa.array(most, type=pa.int64()),
                        pa.array([sketch_of(s) if len(s) else None for s in sets], type=pa.binary()),
                    ],
                    schema=schema,
                )
        give_back()

    return rows.select("doc_id", "row", "text").mapInArrow(run, ddl)


def one_per_point(rows: DataFrame, table: DataFrame, points: DataFrame) -> DataFrame:
    """Row and text of one row of each point; only the row numbers of copies are joined."""
    several = points.where("_n > 1").select("point", F.col("row").alias("_kept"), "_n")
    copies = lookup(
        table.select("point", "row"), several.drop("_n"), ["point"], ["row"], "inner",
        counts=several.select("point", "_n"),
    )
    return rows_among(
        rows.select("row", "text"), copies.where("row <> _kept"), "row", "jaccard-copies", among=False
    )


def chunk_blocks(keys: np.ndarray, rows: np.ndarray, edges: np.ndarray):
    """Blocks of one chunk of shortened keys: bucket, base, keys, places; bucket -1 has further points.

    Of a key's points in the chunk the first has the entry, marked if there are more.
    """
    base = int(rows.min())
    order = np.lexsort((rows, keys))
    keys, at = keys[order], (rows - base)[order]
    first = np.append(True, keys[1:] != keys[:-1])
    keep = first | np.append(True, at[1:] != at[:-1])
    keys, at, first = keys[keep], at[keep], first[keep]
    several = np.append(~first[1:], False)[first]
    more = ~first
    if more.any():
        yield -1, base, varints(np.diff(keys[more], prepend=np.uint64(0))), varints(at[more])
    keys, at = keys[first], at[first]
    cut = np.searchsorted(keys, edges)
    for bucket in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        here = slice(cut[bucket], cut[bucket + 1])
        steps = np.diff(keys[here], prepend=np.uint64(0)) << np.uint64(1)
        yield bucket, base, varints(steps | several[here].astype(np.uint64)), varints(at[here])


def shared_keys(blocks: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and rows of a bucket's blocks, of keys that occur in two blocks or are marked."""
    steps = [from_varints(keys) for _, keys, _ in blocks]
    keys = np.concatenate([np.cumsum(s >> np.uint64(1), dtype=np.uint64) for s in steps])
    several = np.concatenate([(s & np.uint64(1)).astype(bool) for s in steps])
    rows = np.concatenate([from_varints(at).astype(np.int64) + base for base, _, at in blocks])
    order = np.argsort(keys, kind="stable")
    keys, several, rows = keys[order], several[order], rows[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    length = np.diff(np.append(begins, len(keys)))
    keep = np.repeat((length > 1) | np.logical_or.reduceat(several, begins), length)
    return keys[keep].astype(np.int64), rows[keep]


def shared_regions(texts: DataFrame, words: int, percent: int, most: int) -> DataFrame:
    """Regions of two points or more, of about ``most`` keys of texts (row, text): region, point.

    Keys are shortened to the bits of their number and some spare ones. Blocks of a bucket meet in one
    task; buckets are so many that each has at most about BUCKET_KEYS keys.
    """
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(60, max(most, 1).bit_length() + SPARE_BITS)
    buckets = max(4 * tasks, -(-most // BUCKET_KEYS))
    ddl = "bucket int, base long, keys binary, places binary"
    schema = arrow_schema(ddl)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shells = Shells(percent)
        edges = np.array([-(-(b << bits) // buckets) for b in range(buckets + 1)], dtype=np.uint64)
        part, chunk, size = TaskContext.get().partitionId(), 0, 0
        keys: list[np.ndarray] = []
        rows: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            made = chunk_blocks(np.concatenate(keys), np.concatenate(rows), edges)
            spread = -1 - (part * 31 + chunk) % tasks
            made = [(spread if b < 0 else b, *rest) for b, *rest in made]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(zip(*made), schema)], schema=schema
            )

        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                sets = shingle_sets(piece.column("text").to_pylist(), words)
                for row, points in zip(piece.column("row").to_pylist(), sets):
                    if not len(points):
                        continue
                    found = shells.keys(points) >> np.uint64(64 - bits)
                    # Places count from a chunk's first row: a chunk also ends where the rows jump.
                    if keys and (size + len(found) > CHUNK_KEYS or abs(row - int(rows[0][0])) > CHUNK_KEYS):
                        yield flush()
                        keys, rows, size, chunk = [], [], 0, chunk + 1
                    keys.append(found)
                    rows.append(np.full(len(found), row, dtype=np.int64))
                    size += len(found)
        if keys:
            yield flush()
        give_back()

    out = "region long, point long"
    out_schema = arrow_schema(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        current = None

        def made(keys: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rows)], schema=out_schema)

        for batch in batches:
            for bucket, base, keys, places in zip(*(batch.column(c).to_pylist() for c in schema.names)):
                if bucket < 0:
                    found = np.cumsum(from_varints(keys), dtype=np.uint64).astype(np.int64)
                    yield made(found, from_varints(places).astype(np.int64) + base)
                    continue
                if bucket != current and held:
                    yield made(*shared_keys(held))
                    held = []
                current = bucket
                held.append((base, keys, places))
        if held:
            yield made(*shared_keys(held))

    sent = texts.select("row", "text").mapInArrow(send, ddl)
    return sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, out)


def region_members(keyed: DataFrame) -> DataFrame:
    """Members of regions (region, point): region, pivot (its smallest point), point; written.

    Regions and points are sorted by range in one exchange, so a hot region goes over several tasks. A task
    keeps of each run all but the first point, which is the pivot; keys that occur once leave nothing. A task's first
    run may go on from an earlier task: one record per task tells whose pivot it gets.
    """
    rows = keyed.repartitionByRange("region", "point").sortWithinPartitions("region", "point")
    ddl = "part int, region long, pivot long, point long, first boolean, start long, runs long"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        region = pivot = last = start = None
        runs = 0

        def made(columns: list, n: int) -> pa.RecordBatch:
            arrays = [pa.array(np.full(n, part, np.int32)), *columns]
            return pa.RecordBatch.from_arrays(
                [a if isinstance(a, pa.Array) else pa.array(a, type=f.type) for a, f in zip(arrays, schema)],
                schema=schema,
            )

        for batch in batches:
            regions, points = batch.column("region").to_numpy(), batch.column("point").to_numpy()
            if not len(regions):
                continue
            begins = np.append(regions[0] != region or runs == 0, regions[1:] != regions[:-1])
            repeated = ~begins & (points == np.append(points[0] if last is None else last, points[:-1]))
            at = np.flatnonzero(begins)
            number = runs + np.cumsum(begins)
            pivots = points[at] if runs == 0 else np.append(pivot, points[at])
            own = pivots[np.cumsum(begins) - (1 if runs == 0 else 0)]
            first = number == 1
            keep = np.flatnonzero((~begins | first) & ~repeated)
            none = pa.nulls(len(keep), pa.int64())
            yield made([regions[keep], own[keep], points[keep], first[keep], none, none], len(keep))
            start = int(regions[0]) if runs == 0 else start
            runs = int(number[-1])
            region, pivot, last = int(regions[-1]), int(own[-1]), int(points[-1])
        if runs:
            yield made([[region], [pivot], [None], [None], [start], [runs]], 1)

    found = landed(rows.mapInArrow(run, ddl), "jaccard-runs")
    carried, before = [], (None, None)
    for end in sorted(found.where("point IS NULL").collect(), key=lambda e: e["part"]):
        pivot = end["pivot"]
        if end["start"] == before[0]:
            carried.append((end["part"], before[1]))
            pivot = before[1] if end["runs"] == 1 else pivot
        before = (end["region"], pivot)
    carried = keyed.sparkSession.createDataFrame(carried or [(-1, 0)], "part int, _pivot long")
    pivot = F.when(F.col("first"), F.col("_pivot"))
    members = (
        found.where("point IS NOT NULL").join(F.broadcast(carried), "part", "left")  # one row a task
        .select("region", F.coalesce(pivot, "pivot").alias("pivot"), "point")
        .where("point <> pivot")
    )
    return landed(members, "jaccard-members")


def distinct_regions(members: DataFrame) -> DataFrame:
    """Members of one region of those that hold the same points, if two or more beside the pivot."""
    same = [F.bit_xor(F.xxhash64("point", F.lit(i))).alias(f"_h{i}") for i in range(2)]
    regions = members.groupBy("region").agg(
        F.min("pivot").alias("pivot"), F.count(F.lit(1)).alias("_n"), *same
    )
    kept = regions.where("_n > 1").groupBy("pivot", "_n", "_h0", "_h1").agg(F.min("region").alias("region"))
    kept = landed(kept.select("region"), "jaccard-regions")
    return landed(members.join(kept, "region", "left_semi"), "jaccard-distinct")


def bounded(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with a lower bound of their distance, and whether it is within the radius."""
    ddl = "a long, b long, least double, near boolean"
    schema = arrow_schema(ddl)

    def side(point: str, n: str, sketch: str) -> DataFrame:
        return sketches.select(F.col("row").alias(point), F.col("n").alias(n), F.col("sketch").alias(sketch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "_s", 1 << 22):
                left, right = piece.column("_s").to_pylist(), piece.column("_t").to_pylist()
                width = np.array([min(len(x), len(y)) for x, y in zip(left, right)])
                apart = np.zeros(len(left), dtype=np.int64)
                for w in np.unique(width).tolist():
                    at = np.flatnonzero(width == w)
                    x, y = folded([left[i] for i in at], w), folded([right[i] for i in at], w)
                    apart[at] = np.abs(x - y).sum(axis=1)
                n, m = piece.column("_n").to_numpy(), piece.column("_m").to_numpy()
                apart = np.maximum(apart, np.abs(n - m))
                near = (100 + percent) * apart <= (100 - percent) * (n + m)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("a"), piece.column("b"), pa.array(2 * apart / (n + m + apart)), pa.array(near)],
                    schema=schema,
                )

    both = lookup(pairs, side("a", "_n", "_s"), ["a"], ["b"], "inner")
    both = lookup(both, side("b", "_m", "_t"), ["b"], ["a"], "inner", counts=counted(pairs, "b"))
    return both.select("a", "b", "_n", "_s", "_m", "_t").mapInArrow(run, ddl)


def counted(pairs: DataFrame, side: str) -> DataFrame:
    return pairs.groupBy(side).agg(F.count(F.lit(1)).alias("_n"))


def measured(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Written pairs (a, b) with the sizes of their sets' intersection and union.

    Texts (row, text) are moved, as sets are several times larger; only those of pairs.
    """
    ddl = "a long, b long, both long, either long"
    schema = arrow_schema(ddl)
    wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    picked = landed(rows_among(texts, wanted, "row", "jaccard-wanted"), "jaccard-picked")

    def sets_of(piece: pa.RecordBatch, point: str, text: str) -> list[np.ndarray]:
        points = piece.column(point).to_pylist()
        once = dict(zip(points, piece.column(text).to_pylist()))
        sets = dict(zip(once, shingle_sets(list(once.values()), words)))
        return [sets[p] for p in points]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in slices(batch, "_s", SLICE // 2):
                for piece in slices(half, "_t", SLICE // 2):
                    left, right = sets_of(piece, "a", "_s"), sets_of(piece, "b", "_t")
                    both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
                    either = [len(x) + len(y) - k for x, y, k in zip(left, right, both)]
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("a"), piece.column("b"), pa.array(both, pa.int64()), pa.array(either, pa.int64())],
                        schema=schema,
                    )

    left = picked.select(F.col("row").alias("a"), F.col("text").alias("_s"))
    right = picked.select(F.col("row").alias("b"), F.col("text").alias("_t"))
    pairs = pairs.select("a", "b")
    joined = lookup(pairs, left, ["a"], ["b"], "inner")
    joined = lookup(joined, right, ["b"], ["a"], "inner", counts=counted(pairs, "b"))
    return joined.select("a", "b", "_s", "_t").mapInArrow(run, ddl)


def block_pairs(rows: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Candidate pairs a, b within blocks of rows (block, point, part, n, sketch, grp).

    A block has the parts 0 and 1, or 0 only; with two, pairs go between them, unless ``forest``.
    """
    ddl = "a long, b long"
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["block", "part", "point", "n", "grp", "sketch"]
    dealt = rows.select(*columns).repartition(tasks, "block").sortWithinPartitions("block")

    def pairs_of(rows: pa.Table) -> np.ndarray:
        point = rows["point"].to_numpy()
        grp, sizes = rows["grp"].to_numpy(), rows["n"].to_numpy()
        part = rows["part"].to_numpy()
        sketches = rows["sketch"].to_pylist()
        vectors = folded(sketches, min(map(len, sketches)))
        hit = near_pairs(vectors, sizes, grp, percent, forest)
        if len(hit) and part.any() and not forest:
            hit = hit[part[hit[:, 0]] != part[hit[:, 1]]]
        return np.sort(point[hit], axis=1) if len(hit) else np.empty((0, 2), dtype=np.int64)
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            block = table["block"].to_numpy()
            cut = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
            found = [pairs_of(table.slice(a, b - a)) for a, b in zip(cut[:-1], cut[1:])]
            out = np.unique(np.concatenate(found), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], schema=schema
            )

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            block = table["block"].to_numpy()
            whole = int(np.searchsorted(block, block[-1], side="left"))  # blocks known to be whole
            if whole:
                yield done(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, ddl).distinct()


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id",
    row: str | None = None,
) -> DataFrame:
    """Per row: key, n_shingles, component_id (the smallest id reachable by links, or its own).

    Two texts are linked when 100 * intersection >= percent * union. ``row`` is a column of a written
    table that numbers its rows; without it, keys and texts are written with such numbers.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), number.alias("row")
    )
    rows = landed(rows, "jaccard-rows") if row is None else rows
    with short_batches(rows.sparkSession):
        table = landed(described(rows, words, percent), "jaccard-texts")
    points = landed(
        table.where(F.col("point").isNotNull())
        .groupBy("point").agg(
            F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.count(F.lit(1)).alias("_n"),
            F.max("most").alias("most"),
        ),
        "jaccard-points",
    )
    most = points.agg(F.sum("most")).first()[0] or 0
    texts = one_per_point(rows, table, points)
    with short_batches(rows.sparkSession):
        shared = landed(shared_regions(texts, words, percent, most), "jaccard-shared")
    members = region_members(shared)
    star = landed(members.select(F.col("pivot").alias("a"), F.col("point").alias("b")).distinct(), "jaccard-pairs")
    wanted = star.select(F.col("a").alias("row")).union(star.select("b")).distinct()
    sketches = rows_among(table.select("row", "n", "sketch"), wanted, "row", "jaccard-sketched")
    sketches = landed(sketches, "jaccard-sketches")
    members = distinct_regions(members)

    # The ball and the window of each pivot.
    near = landed(bounded(star, sketches, percent), "jaccard-bounds")
    exact = landed(measured(near.where("near"), rows.select("row", "text"), words), "jaccard-star")
    linked = F.col("both") * 100 >= F.col("either") * percent
    star = exact.select("a", "b", (1 - F.col("both") / F.col("either")).alias("away"), linked.alias("inside"))
    star = star.union(near.where("NOT near").select("a", "b", "least", F.lit(False)))
    balls = landed(components(star.where("inside").select("a", "b")), "jaccard-balls")
    rest = rest_of_regions(members, star, balls, percent)

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        pairs = landed(pairs, name + "-pairs")
        return landed(measured(pairs, rows.select("row", "text"), words).where(linked).select("a", "b"), name)

    more = links_of(block_pairs(in_blocks(rest, sketches), percent, forest=True), "jaccard-more")

    # Links between balls join them. Nearly all candidates are links, so the pairs that connect them
    # come first; then all candidates between what is still apart.
    ball = balls.select("vertex", "component")

    def to_ball(links: DataFrame, side: str) -> DataFrame:
        named = ball.select(F.col("vertex").alias(side), F.col("component").alias("_c"))
        return links.join(named, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")

    joined = landed(components(to_ball(to_ball(more, "a"), "b")), "jaccard-joined")
    newer = joined.select(F.col("vertex").alias("grp"), F.col("component").alias("_c"))
    apart = rest.join(newer, "grp", "left").withColumn("grp", F.coalesce("_c", "grp")).drop("_c")
    apart = landed(apart, "jaccard-apart")
    still = apart.groupBy("region").agg(F.min("grp").alias("_g"), F.max("grp").alias("_h"))
    apart = apart.join(still.where("_g <> _h").select("region"), "region", "left_semi")
    last = links_of(block_pairs(in_blocks(apart, sketches), percent, forest=False), "jaccard-last")
    if not last.isEmpty():
        joined = components(to_ball(to_ball(more.union(last), "a"), "b"))
    top = joined.select(F.col("vertex").alias("_ball"), F.col("component").alias("_top"))
    first = points.join(ball.withColumnRenamed("vertex", "row"), "row", "left")
    first = first.withColumn("_ball", F.coalesce("component", "row")).join(top, "_ball", "left")
    placed = landed(
        first.select("point", "doc_id", "_n", F.coalesce("_top", "_ball").alias("_whole")),
        "jaccard-placed",
    )
    least = placed.groupBy("_whole").agg(
        F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n")
    )
    named = lookup(
        placed.select("point", "_whole"), least.drop("_n"), ["_whole"], ["point"], "inner",
        counts=least.select("_whole", "_n"),
    ).drop("_whole")
    whole = lookup(
        table.select("doc_id", "n", "point"), named, ["point"], ["doc_id"], "left",
        counts=placed.select("point", "_n"),
    )
    return whole.select(
        F.col("doc_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("point").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def rest_of_regions(
    members: DataFrame, star: DataFrame, balls: DataFrame, percent: int
) -> DataFrame:
    """Members that may still have a link their pivot does not give: region, point, grp, size.

    Distances of points outside may be lower bounds. With x at distance dx from the pivot, within the radius r, and y at dy beyond it, a link needs
    dy - dx <= r. So of the ball only those with dx >= (smallest dy) - r are kept.
    """
    radius = (100 - percent) / 100 + 1e-9
    away = star.select(F.col("a").alias("pivot"), F.col("b").alias("point"), "away", "inside")
    grp = balls.select(F.col("vertex").alias("point"), F.col("component").alias("grp"))
    rows = (
        members.join(away, ["pivot", "point"]).join(grp, "point", "left")
        .select("region", "point", "away", "inside", F.coalesce("grp", "point").alias("grp"))
    )
    rows = landed(rows, "jaccard-away")
    outside = rows.where("NOT inside").groupBy("region").agg(F.min("away").alias("_from"))
    rows = rows.join(outside, "region").where(
        ~F.col("inside") | (F.col("away") >= F.col("_from") - radius)
    )
    rows = landed(rows.select("region", "point", "grp"), "jaccard-rest")
    sizes = rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("size"), F.min("grp").alias("_g"), F.max("grp").alias("_h")
    ).where("_g <> _h")
    return landed(rows.join(sizes.select("region", "size"), "region"), "jaccard-sized")


def in_blocks(rest: DataFrame, sketches: DataFrame) -> DataFrame:
    """Deal regions into blocks: small ones are one block, others one per pair of their pieces."""
    pieces = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("point"), pieces.cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
    rows = (
        rest.withColumn("_pieces", pieces).withColumn("_own", own)
        .withColumn("_other", other)
        .withColumn("block", F.xxhash64("region", F.least("_own", "_other"), F.greatest("_own", "_other")))
        .withColumn("part", (F.col("_own") > F.col("_other")).cast("int"))
    )
    return rows.join(sketches.select(F.col("row").alias("point"), "n", "sketch"), "point")
