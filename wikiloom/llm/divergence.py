"""How far the sources of a language differ in their words, by Gustavson's row accumulation.

Terms are runs of letters (A-Z lower-cased) and of characters beyond ASCII. A language keeps the terms
of at least ``least`` of its documents. A group (language, source) and a language give each kept term a
smoothed share p in parts of 10^9, and two of them differ in a term by (p - q)^2 / (p + q), rounded
down. All of it is integer arithmetic.

For pairs of sources the matrix of groups and terms is multiplied with its transpose row by row: a group
scatters its terms through the term-major index (for each term the groups that have it) into one dense
accumulator over its peers, so no pair of postings is ever a row. A term that one or both groups lack
still counts with the share of a count of zero. With p0 and q0 for those shares,

    f(p, q) = [f(p, q) - f(p0, q) - f(p, q0) + f(p0, q0)] + f(p0, q) + f(p, q0) - f(p0, q0),

where the bracket is zero unless both groups have the term: it is what the scatter adds. The rest depends
on one group's counts only and is summed over the histogram of its shares, whose length grows with the
root of its words.

Null text, language and source count as ''. A group without kept terms is a group with zero counts; in a
language without kept terms every pair has value 0. Repeated ids are no matter, as ids are not read;
extra columns are not read. A language's sources must fit a row as a list of numbers: the result has
the square of their number.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema, slices
from wikiloom.llm.pieces import pieces
from wikiloom.scale import landed, lookup, with_group_position

PARTS = 1_000_000_000
HELD_TERMS = 500_000  # distinct terms of all groups that a task holds before it hands them on
HELD_SUMS = 1 << 22  # sums of pairs that a task holds
CHUNK = 1 << 18  # postings scattered at once
HISTOGRAM = 4096  # shares in one row

_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def group_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences and documents of each term per lang and source, added up in each task first.

    The term '' stands for the group itself, so that groups without terms are kept.
    """
    ddl = "lang string, source string, term string, n long, docs long"
    schema = arrow_schema(ddl)
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def handed_on(words: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in words.items():
            held = docs[lang, source]
            n = len(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array(list(held), pa.binary()).view(pa.string()),
                    pa.array([counts[t] for t in held], pa.int64()),
                    pa.array(list(held.values()), pa.int64()),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, docs = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for piece in slices(batch, "text"):
                columns = (piece.column(c).to_pylist() for c in ("lang", "source", "text"))
                for lang, source, data in zip(*columns):
                    seen = {b""}
                    count = words[lang, source]
                    for part in pieces(data):
                        found = part.translate(_TERM_BYTES).split()
                        count.update(found)
                        seen.update(found)
                    docs[lang, source].update(seen)
                if sum(map(len, docs.values())) > HELD_TERMS:
                    yield from handed_on(words, docs)
                    words, docs = defaultdict(Counter), defaultdict(Counter)
        yield from handed_on(words, docs)

    partial = rows.mapInArrow(run, ddl)
    return partial.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def share(n: Column, words: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (words + 2 terms)), by decimals as counts may be large."""
    whole = (n + 2).cast("decimal(19,0)") * F.lit(PARTS).cast("decimal(10,0)")
    all_ = (words + 2 * terms).cast("decimal(20,0)")
    return F.call_function("div", whole, all_).cast("long") + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def baselines(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """The part of each pair that depends on one side's counts: lang, a, b, value.

    A row of shares is compared with the zero-count share of every peer; terms that the group lacks are
    one more share of it.
    """
    shares = postings.groupBy("lang", "sid", "p").agg(F.count(F.lit(1)).alias("n"))
    sizes = shares.groupBy("lang", "sid").agg(F.count(F.lit(1)).alias("_n"))
    rows = lookup(shares, sizes, ["lang", "sid"], ["p"], "inner", counts=sizes.select("lang", "sid", "_n"))
    block = F.pmod(F.xxhash64("p"), F.ceil(F.col("_n") / HISTOGRAM))
    rows = rows.groupBy("lang", "sid", block.alias("_block")).agg(
        F.collect_list("p").alias("ps"), F.collect_list("n").alias("ns")
    ).select("lang", "sid", "ps", "ns", F.lit(0).cast("long").alias("less"))
    lacking = groups.select(
        "lang", "sid", F.array("p0").alias("ps"), F.array(F.col("terms") - F.col("nnz")).alias("ns"),
        F.col("terms").alias("less"),
    )
    peers = groups.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("sid", "p0"))).alias("_peers"), F.count(F.lit(1)).alias("_n")
    )
    rows = lookup(
        rows.unionByName(lacking), peers.select("lang", F.col("_peers.p0").alias("peers")),
        ["lang"], ["sid"], "inner",
    )
    ddl = "lang string, a int, b int, value long"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ps, ns = np.array(row["ps"], np.int64), np.array(row["ns"], np.int64)
                zero = np.array(row["peers"], np.int64)
                value = np.zeros(len(zero), np.int64)
                for p, n in zip(ps, ns):
                    value += n * _apart(zero, p)
                other = np.flatnonzero(np.arange(len(zero)) != row["sid"]).astype(np.int32)
                own = np.full(len(other), row["sid"], np.int32)
                less = value - row["less"] * _apart(zero, ps[0])
                sums = [(own, other, less[other]), (other, own, value[other])]
                for a, b, v in sums:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["lang"]] * len(v), pa.string()), pa.array(a), pa.array(b), pa.array(v)],
                        schema=schema,
                    )

    return rows.select("lang", "sid", "ps", "ns", "less", "peers").mapInArrow(run, ddl)


def scatter(row: int, ends: np.ndarray, sid: np.ndarray, p: np.ndarray, zero: np.ndarray,
            own: np.ndarray, sums: np.ndarray) -> None:
    """Add a group's terms to its accumulator over peers.

    The index holds for each term, up to its place in ``ends``, the groups ``sid`` with their shares;
    ``own`` are the group's places in it.
    """
    term = np.searchsorted(ends, own, side="right")
    first = np.where(term > 0, ends[term - 1], 0)
    length = ends[term] - first
    back = np.cumsum(length) - length
    at = np.arange(length.sum()) + np.repeat(first - back, length)
    mine, none = np.repeat(p[own], length), zero[own[0]]
    more = _apart(mine, p[at]) - _apart(none, p[at]) - _apart(mine, zero[at]) + _apart(none, zero[at])
    np.add.at(sums, sid[at], more)


def corrections(postings: DataFrame) -> DataFrame:
    """What terms that both groups have add to the baselines: lang, a, b, value."""
    index = (
        postings.groupBy("lang", "term")
        .agg(
            F.collect_list("sid").alias("sid"), F.collect_list("p").alias("p"),
            F.collect_list("p0").alias("p0"), F.first("peers").alias("peers"),
        )
        .where(F.size("sid") > 1)
        .select("lang", "peers", "sid", "p", "p0")
    )
    ddl = "lang string, a int, b int, value long"
    schema = arrow_schema(ddl)

    def handed_on(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, a), sums in held.items():
            b = np.flatnonzero(sums).astype(np.int32)
            b = b[b != a]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(b), pa.string()), pa.array(np.full(len(b), a, np.int32)),
                    pa.array(b), pa.array(sums[b]),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            langs = pa.compute.dictionary_encode(batch.column("lang"))
            codes, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
            for code, lang in enumerate(names):
                rows = np.flatnonzero(codes == code)
                lengths = pa.compute.list_value_length(batch.column("sid")).to_numpy()[rows]
                peers = batch.column("peers")[int(rows[0])].as_py()
                chunk = np.cumsum(lengths) // CHUNK
                for part in np.split(rows, np.flatnonzero(np.diff(chunk)) + 1):
                    here = batch.take(pa.array(part))
                    ends = np.cumsum(pa.compute.list_value_length(here.column("sid")).to_numpy())
                    sid, p, zero = (
                        pa.compute.list_flatten(here.column(c)).to_numpy() for c in ("sid", "p", "p0")
                    )
                    order = np.argsort(sid, kind="stable")
                    cuts = np.flatnonzero(np.diff(sid[order])) + 1
                    for own in np.split(order, cuts):
                        a = int(sid[own[0]])
                        if (lang, a) not in held:
                            held[lang, a] = np.zeros(peers, np.int64)
                        scatter(a, ends, sid, p, zero, own, held[lang, a])
                    if sum(map(len, held.values())) > HELD_SUMS:
                        yield from handed_on(held)
                        held = {}
        yield from handed_on(held)

    return index.mapInArrow(run, ddl)


def source_divergence(
    docs: DataFrame, text: str = "text", least: int = 10, top: int = 10
) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language with the sum over all kept terms. Part ``term``: the
    ``top`` terms that the source has more often than its language.
    """
    counted = landed(group_terms(docs, text), "divergence-terms")
    terms = counted.where("term <> ''")
    kept = landed(
        terms.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("docs") >= least).drop("docs"),
        "divergence-kept",
    )
    matched = landed(
        lookup(
            terms.drop("docs"), kept.drop("_n"), ["lang", "term"], ["source"], "inner",
            counts=kept.select("lang", "term", "_n"),
        ),
        "divergence-matched",
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_words"))
    sums = matched.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("nnz"))
    groups = (
        counted.where("term = ''").select("lang", "source")
        .join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["words", "nnz", "terms", "lang_words"])
    )
    zero = F.lit(0).cast("long")
    groups = groups.withColumn(
        "p0", F.when(F.col("terms") > 0, share(zero, F.col("words"), F.col("terms"))).otherwise(F.lit(1))
    )
    groups = with_group_position(groups, ["lang"], ["source"], "sid", "peers")
    groups = landed(
        groups.withColumn("sid", (F.col("sid") - 1).cast("int")).withColumn("peers", F.col("peers").cast("int")),
        "divergence-groups",
    )
    shared = groups.select("lang", "source", "sid", "peers", "words", "terms", "lang_words", "p0")
    postings = lookup(
        matched, shared, ["lang", "source"], ["term"], "inner",
        counts=groups.select("lang", "source", F.col("nnz").alias("_n")),
    )
    postings = landed(
        postings.select(
            "lang", "source", "sid", "peers", "term", "p0",
            share(F.col("n"), F.col("words"), F.col("terms")).alias("p"),
            share(F.col("lang_n"), F.col("lang_words"), F.col("terms")).alias("q"),
        ),
        "divergence-postings",
    )
    pairs = (
        baselines(groups, postings).unionByName(corrections(postings))
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    names = groups.select("lang", "sid", "source")
    pairs = pairs.join(names.withColumnRenamed("sid", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("sid").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    )
    own = postings.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        apart(F.col("p"), F.col("q")).alias("value"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    first = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    every = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    return every.select(columns).unionByName(first.select(columns))
