"""Personal data by fixed patterns and by bootstrapped contexts, in DataFrame operations only.

Base spans are the leftmost matches of four patterns that pass a check. They are the seeds. Tokens
that look like identifiers (they hold a digit or an @) are the instances; the two words before a
token are its lexical pattern. In each round a pattern's score is the share of its distinct
instances that are known, a seed counting 1 and a found instance its own score. It is accepted if that
is MIN_SCORE at least and MIN_SEEDS distinct instances support it: seeds, or found instances that score
as high. Its kind is the one that most of the score belongs to. Its instances are known from then on,
with its score and kind if no better pattern has them, and may support patterns of the next
round. Scores never fall, so the rounds end when one accepts no new pattern, after ROUNDS at most: an
identifier may be that many contexts away from the nearest seed. Instances of accepted patterns are
added; those that overlap a base span are not added again.

Null text counts as empty. Rows with equal ids stay separate rows. Positions are code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.text import bind
from wikiloom.llm.arrays import found, total
from wikiloom.scale import landed, lookup

KINDS = ["email", "ip", "card", "phone"]

# The patterns, with runs that are never given back, so that no text takes quadratic time: a match
# begins where its run begins, or where the match before ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDLES = {"email": "@", "ip": ".", "phone": "+"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_IN_TOKEN = r"A-Za-z0-9_@+./:-"
TOKEN = rf"(?<![{_IN_TOKEN}])[A-Za-z_+./:-]*+[0-9@][{_IN_TOKEN}]*+"
ROUNDS = 20
MIN_SEEDS = 3
MIN_SCORE = 0.6
CONTEXT_WORDS = 2


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the check sum."""

    def passes(digits: Column) -> Column:
        items = F.split(F.reverse(digits), "")
        doubled = F.transform(
            items,
            lambda d, i: F.when(F.pmod(i, F.lit(2)) == 0, d.cast("int")).otherwise(
                F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") * 2 / 10)
            ).cast("long"),
        )
        return F.pmod(total(doubled), F.lit(10)) == 0

    return bind(_digits(value), passes)


def _count_between(value: Column, least: int, most: int) -> Column:
    return F.length(_digits(value)).between(least, most)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.regexp_like(v, F.lit(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")),
    "card": lambda v: F.when(_count_between(v, 16, 19), luhn(v)).otherwise(False),
    "phone": lambda v: _count_between(v, 8, 15),
}


def _checked(matches: Column, kind: str, rank: int) -> Column:
    hits = F.filter(matches, lambda m: CHECKS[kind](m["value"]))
    return F.transform(
        hits, lambda m: F.struct(F.lit(rank).alias("rank"), m["start"], m["end"], m["value"])
    )


def base_spans(text: Column) -> Column:
    """Array of (rank of the kind, start, end, value), in order of kind and start."""
    span = "array<struct<rank:int,start:int,end:int,value:string>>"
    per_kind = []
    for rank, kind in enumerate(KINDS):
        rows = _checked(found(text, PATTERNS[kind]), kind, rank)
        may = F.regexp_like(text, F.lit("[0-9]")) if kind != "email" else F.lit(True)
        if kind in NEEDLES:
            may = F.contains(text, F.lit(NEEDLES[kind])) & may
        per_kind.append(F.when(may, rows.cast(span)).otherwise(F.array().cast(span)))
    return F.concat(*per_kind)


def instances(text: Column) -> Column:
    """Array of identifier-like tokens: start, end, value, left (the two words before)."""

    def row(m: Column) -> Column:
        spaced = F.rtrim(F.regexp_replace(m["gap"], r"[\x20\x09-\x0D]++", " "))
        words = F.substring_index(spaced, " ", -CONTEXT_WORDS)
        left = F.trim(F.regexp_replace(F.lower(words), r"[^\p{L}]+", " "))
        return F.struct(m["start"], m["end"], m["value"], left.alias("left"))

    kind = "array<struct<start:int,end:int,value:string,left:string>>"
    tokens = F.transform(found(text, TOKEN), row).cast(kind)
    return F.when(F.regexp_like(text, F.lit("[0-9@]")), tokens).otherwise(F.array().cast(kind))


def learn_patterns(tokens: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns that score high enough: left, rank.

    ``tokens`` has left, value and rank (of the seed that the token lies in, or null). Only
    distinct edges of the graph take part, aggregated before they are shuffled.
    """
    edges = landed(
        tokens.where("left <> ''").groupBy("left", "value").agg(F.max("rank").alias("rank")),
        "pii-edges",
    )
    degree = edges.groupBy("left").agg(F.count(F.lit(1)).alias("_n"))
    seeds = edges.where("rank is not null").select("value", F.lit(1.0).alias("score"), (-F.col("rank")).alias("kind"))
    known, patterns, accepted = seeds, None, 0
    for _ in range(rounds):
        # One row per value on the right; hot values of the left are split by their patterns.
        best = known.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("b")).select("value", "b.*")
        scored = lookup(edges.select("left", "value"), best, ["value"], ["left"], "left")
        sure = (F.col("score") >= MIN_SCORE).cast("long")
        patterns = landed(
            scored.groupBy("left").agg(
                (F.sum(F.coalesce("score", F.lit(0.0))) / F.count(F.lit(1))).alias("score"),
                F.coalesce(F.sum(sure), F.lit(0)).alias("support"),
                *[F.sum(F.when(F.col("kind") == -r, F.col("score"))).alias(f"k{r}") for r in range(len(KINDS))],
            ).where((F.col("support") >= MIN_SEEDS) & (F.col("score") >= MIN_SCORE)),
            "pii-patterns",
        )
        most = F.greatest(*[
            F.struct(F.coalesce(f"k{r}", F.lit(0.0)).alias("of"), F.lit(-r).alias("kind")) for r in range(len(KINDS))
        ])
        patterns = patterns.select("left", "score", most["kind"].alias("kind"))
        count = patterns.count()
        if count <= accepted:
            break
        accepted = count
        reached = lookup(edges.select("left", "value"), patterns, ["left"], ["value"], "inner", counts=degree)
        known = landed(seeds.unionByName(reached.select("value", "score", "kind")), "pii-known")
    return patterns.select("left", (-F.col("kind")).cast("int").alias("rank"))


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, base and spans, both arrays of (rank of the kind, start, end)."""
    clean = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), clean.alias("text"))
    marked = landed(
        rows.withColumn("base", base_spans(F.col("text"))).withColumn("tokens", instances(F.col("text")))
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", "tokens"),
        "pii-marked",
    )
    overlap = F.filter(
        "base", lambda b: (b["start"] < F.col("t.end")) & (b["end"] > F.col("t.start"))
    )
    # The token in which a seed begins stands for the whole seed; its other tokens drop out.
    tokens = (
        marked.where("size(tokens) > 0").select("row", "base", F.explode("tokens").alias("t"))
        .select("row", "t", F.get(overlap, F.lit(0)).alias("b"))
        .where("b is null or t.start <= b.start")
        .select(
            "row", "t.left", F.coalesce("b.value", "t.value").alias("value"), "t.start", "t.end",
            F.col("b.rank").alias("rank"),
        )
    )
    patterns = learn_patterns(tokens).withColumnRenamed("rank", "_rank")
    unseen = tokens.where(F.col("rank").isNull() & (F.col("left") != ""))
    added = (
        lookup(unseen, patterns, ["left"], ["row", "start"], "inner")
        .groupBy("row")
        .agg(F.collect_list(F.struct(F.col("_rank").alias("rank"), "start", "end")).alias("added"))
    )
    plain = F.transform("base", lambda b: F.struct(b["rank"], b["start"], b["end"]))
    kind = "array<struct<rank:int,start:int,end:int>>"
    return marked.join(added, "row", "left").select(
        F.col("doc_id").alias(key),
        plain.cast(kind).alias("base"),
        F.array_sort(
            F.concat(plain.cast(kind), F.coalesce(F.col("added").cast(kind), F.array().cast(kind)))
        ).alias("spans"),
    )


def count_of(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])
        ),
        ",",
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans, the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["rank"].alias("rank"))
    ))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["rank"])
        )
        end = -s["last"]
        return F.when(
            s["start"] >= acc["at"], F.struct(piece.alias("out"), end.alias("at"))
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], end).alias("at")))

    done = F.aggregate(
        by_start, empty, step,
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
