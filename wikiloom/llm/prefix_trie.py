"""The trie of shared prefixes of conversations that are rebuilt from turns of others.

A plan gives each conversation a base and a number h: rebuilt, it begins with the first h turns of the base
(all if it has fewer, none if it is absent) and goes on with its own turns after its first h. Rebuilt
texts are never made. A sequence of turns has a fingerprint in a monoid of affine maps modulo the
prime 2^61 - 1: a turn with hash t is x -> x B + t, a sequence is the product of its turns, and

    head * suffix = (B^(m+n), head B^n + suffix).

The turns of all conversations are sorted over all tasks and their products taken in one pass per task; a
conversation that goes over several tasks gets the product of its earlier parts from one record per
task. A suffix from h on is the quotient of two such products, so the fingerprint of any prefix of a rebuilt
conversation is P + (head - P_h) B^k, from one number per conversation and one per turn.

Prefixes of equal depth and fingerprint are one node. That they are equal is verified, not assumed: their
parents must be the same node, and the last turns to which their members refer must have the same role and
text, byte by byte. If that fails anywhere, all fingerprints are made anew with another multiplier.

No tree is walked. A node belongs to its smallest member. The nodes that belong to one conversation are
a chain down to its end, and below a node lie the chains of its members, whole, but for the one that
goes on above it. So sums over subtrees are sums over members of chain totals, less what that one chain
has above the node.

Null roles and texts count as empty. Turns are ordered by number, null first, then by role and text; equal
rows all count. Rows without conv_id belong to no conversation and are left out. Without rows there is no
node. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.arrow import arrow_schema
from wikiloom.llm.ordered import running_sum
from wikiloom.scale import landed, listed_in_parts, lookup, with_index

PRIME = (1 << 61) - 1
# Multipliers to try, one after the other: powers of a fixed number
MULTIPLIERS = [pow(1_234_567_890_123_456_789, i, PRIME) for i in range(1, 9)]
ID_PART = 10_000


def _mapped(df: DataFrame, ddl: str, columns: dict, kept: list[str], make) -> DataFrame:
    """Add columns computed by ``make()``, a function of plain values that may keep state in a task."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            values = zip(*(batch.column(c).to_pylist() for c in columns["given"]))
            made = list(zip(*(f(*v) for v in values))) or [[]] * len(columns["made"])
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(v, type=schema.field(c).type) for c, v in zip(columns["made"], made)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, ddl)


def ordered_turns(conversations: DataFrame, multiplier: int) -> DataFrame:
    """Each turn with its place in its conversation (from 1), its hash, and the product up to it.

    Columns conv, role, text, chars, place, hash, product; written to the shared folder.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("_row")]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "role", "text", F.length("text").cast("long").alias("chars"),
        F.pmod(F.xxhash64("role", "text"), F.lit(PRIME)).alias("hash"),
    )
    ddl = (
        "conv long, role string, text string, chars long, hash long,"
        " part int, row long, place long, product long, first boolean"
    )

    def make():
        state = {"conv": None, "row": 0, "place": 0, "product": 0, "runs": 0}
        part = TaskContext.get().partitionId()

        def run(conv: int, hash_: int) -> tuple:
            if conv != state["conv"]:
                state.update(conv=conv, place=0, product=0, runs=state["runs"] + 1)
            state["row"] += 1
            state["place"] += 1
            state["product"] = (state["product"] * multiplier + hash_) % PRIME
            return part, state["row"], state["place"], state["product"], state["runs"] == 1

        return run

    made = ["part", "row", "place", "product", "first"]
    kept = ["conv", "role", "text", "chars", "hash"]
    turns = landed(_mapped(turns, ddl, {"given": ["conv", "hash"], "made": made}, kept, make), "trie-parts")

    # One record per task: what its last conversation has so far is put before the next task's first.
    ends = turns.groupBy("part").agg(
        F.min("conv").alias("first"),
        F.max_by(F.struct("conv", "place", "product"), "row").alias("last"),
    )
    carried, before = [], (None, 0, 0)
    for end in sorted(ends.collect(), key=lambda e: e["part"]):
        if end["first"] == before[0]:
            carried.append((end["part"], before[1], before[2]))
        conv, place, product = end["last"]
        if conv == before[0]:
            product = (before[2] * pow(multiplier, place, PRIME) + product) % PRIME
            place += before[1]
        before = (conv, place, product)
    carried = turns.sparkSession.createDataFrame(
        carried or [(-1, 0, 0)], "part int, before_place long, before_product long"
    )

    def joined():
        def run(first: bool, place: int, product: int, before_place: int | None, before: int | None) -> tuple:
            if not first or before_place is None:
                return place, product
            return before_place + place, (before * pow(multiplier, place, PRIME) + product) % PRIME

        return run

    whole = turns.join(F.broadcast(carried), "part", "left").select(
        *kept, "first", "place", "product", "before_place", "before_product"
    )
    given = ["first", "place", "product", "before_place", "before_product"]
    ddl = "conv long, role string, text string, chars long, hash long, place long, product long"
    return landed(_mapped(whole, ddl, {"given": given, "made": ["place", "product"]}, kept, joined), "trie-turns")


def rebuilt(turns: DataFrame, plan: DataFrame, most: int, multiplier: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, length, end) and their prefixes without texts, both written.

    A prefix has conv, depth, print, parent (the print of the prefix before it), chars of its last turn,
    and that turn's place: ref_conv, ref_place. ``most`` bounds the heads of the plan.
    """
    heads = F.when(F.col("place") <= most, F.struct("place", "product", "chars"))
    convs = turns.groupBy("conv").agg(
        F.max("place").alias("turns"), F.sort_array(F.collect_list(heads)).alias("heads")
    )
    convs = landed(convs, "trie-conversations")
    own = plan.select(F.col("conv_id").alias("conv"), F.col("base_id").alias("base"), "head")
    base = convs.select(F.col("conv").alias("base"), F.col("heads").alias("base_heads"))
    convs = lookup(convs.join(own, "conv"), base, ["base"], ["conv"], "left")
    taken = F.slice(F.coalesce("base_heads", F.array().cast(base.schema["base_heads"].dataType)), F.lit(1), F.col("head"))
    convs = convs.withColumn("taken", taken).withColumn(
        "skipped", F.when(F.col("head") > 0, F.element_at("heads", F.least("head", "turns").cast("int"))["product"])
    )
    convs = convs.withColumn("length", F.size("taken") + F.greatest(F.col("turns") - F.col("head"), F.lit(0)))
    tail = F.when(F.size("taken") > 0, F.element_at("taken", -1)["product"]).otherwise(F.lit(0))
    # What the head's product differs by from that of the turns it stands for; both are below the prime.
    convs = convs.withColumn("delta", F.pmod(tail - F.coalesce("skipped", F.lit(0)), F.lit(PRIME)))
    convs = landed(
        convs.select("conv", "base", "head", "turns", "length", "taken", "delta"), "trie-rebuilt"
    )
    roots = convs.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("print"),
        F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("chars"),
        F.lit(None).cast("long").alias("ref_conv"), F.lit(None).cast("long").alias("ref_place"),
    )
    previous = F.when(F.col("i") > 0, F.get("taken", F.col("i") - 1)["product"]).otherwise(F.lit(0))
    first = convs.select("conv", "base", "taken", F.posexplode("taken").alias("i", "turn")).select(
        "conv", (F.col("i") + 1).cast("long").alias("depth"), F.col("turn.product").alias("print"),
        previous.cast("long").alias("parent"), F.col("turn.chars").alias("chars"),
        F.col("base").alias("ref_conv"), F.col("turn.place").alias("ref_place"),
    )
    inverse = pow(multiplier, -1, PRIME)

    def make():
        def run(place: int, hash_: int, product: int, head: int, delta: int) -> tuple:
            found = (product + delta * pow(multiplier, place - head, PRIME)) % PRIME
            return found, (found - hash_) * inverse % PRIME

        return run

    later = lookup(
        turns.select("conv", "place", "hash", "product", "chars"),
        convs.select("conv", "head", "delta", F.size("taken").cast("long").alias("taken")),
        ["conv"], ["place"], "inner",
        counts=convs.select("conv", F.col("turns").alias("_n")),
    ).where(F.col("place") > F.col("head"))
    later = later.withColumn("depth", F.col("taken") + F.col("place") - F.col("head"))
    ddl = "conv long, depth long, chars long, place long, print long, parent long"
    later = _mapped(
        later, ddl, {"given": ["place", "hash", "product", "head", "delta"], "made": ["print", "parent"]},
        ["conv", "depth", "chars", "place"], make,
    ).select(
        "conv", "depth", "print", "parent", "chars", F.col("conv").alias("ref_conv"), F.col("place").alias("ref_place"),
    )
    prefixes = landed(roots.unionByName(first).unionByName(later), "trie-prefixes")
    return convs.select("conv", F.col("length").cast("long").alias("length")), prefixes


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """One row per depth and print, with its smallest member and what is to be verified."""
    ref = F.struct("ref_conv", "ref_place")
    return landed(
        prefixes.groupBy("depth", "print").agg(
            F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
            F.min("parent").alias("parent"), F.max("parent").alias("_parent"),
            F.min(ref).alias("ref"), F.max(ref).alias("_ref"),
        ),
        "trie-nodes",
    )


def _differ(nodes: DataFrame, prefixes: DataFrame, turns: DataFrame) -> bool:
    """Whether some node joins different prefixes: other parents, or last turns of other bytes."""
    if not nodes.where("parent <> _parent").isEmpty():
        return True
    several = nodes.where("ref <> _ref").select("depth", "print", F.col("n_convs").alias("_n"))
    members = lookup(
        prefixes.select("depth", "print", "ref_conv", "ref_place"), several.drop("_n"), ["depth", "print"],
        ["ref_conv", "ref_place"], "inner", counts=several,
    ).distinct()
    texts = members.join(
        turns.select(F.col("conv").alias("ref_conv"), F.col("place").alias("ref_place"), "role", "text"),
        ["ref_conv", "ref_place"],
    )
    said = F.struct("role", "text")
    return not (
        texts.groupBy("depth", "print").agg(F.min(said).alias("a"), F.max(said).alias("b"))
        .where("a <> b").isEmpty()
    )


def _ends(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """Digest of the ids of conversations that end at each node: depth, print, ends_sha256.

    Ids are sorted over all tasks and joined in parts; a node's parts then go through one hash in order.
    """
    last = prefixes.select("conv", "depth", "print").join(
        convs.select("conv", F.col("length").alias("depth")), ["conv", "depth"]
    )
    parts = listed_in_parts(last, ["depth", "print"], ["conv"], F.col("conv").cast("string"), "ids", ID_PART)
    parts = parts.select("depth", "print", "part", F.array_join("ids", ",").alias("ids"))
    parts = parts.repartition("depth", "print").sortWithinPartitions("depth", "print", "part")
    ddl = "depth long, print long, ends_sha256 string"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def batch_of(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"depth": n[0], "print": n[1], "ends_sha256": d} for n, d in done], schema=schema
            )

        for batch in batches:
            done = []
            for depth, print_, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "print", "ids"))):
                if (depth, print_) == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = (depth, print_), hashlib.sha256(ids.encode())
            yield batch_of(done)
        if node is not None:
            yield batch_of([(node, digest.hexdigest())])

    return parts.select("depth", "print", "ids").mapInArrow(run, ddl)


def prefix_trie(conversations: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and ref_conv, ref_place: where its last turn is stored (place from 1).

    ``plan`` has one row per conversation: conv_id, base_id, head (0 to ``most``).
    """
    for multiplier in MULTIPLIERS:
        turns = ordered_turns(conversations, multiplier)
        convs, prefixes = rebuilt(turns, plan, most, multiplier)
        nodes = nodes_of(prefixes)
        if not _differ(nodes, prefixes, turns):
            break
    else:
        raise ValueError("no multiplier keeps different prefixes apart")

    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent").alias("print")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = landed(
        nodes.join(children, ["depth", "print"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .withColumn("_saves", (F.col("n_convs") - 1) * F.col("chars"))
        .drop("_parent", "_ref"),
        "trie-children",
    )
    # The chain of each conversation: its total, and what lies above each node of it.
    chains = nodes.groupBy("conv_id").agg(
        F.sum("_saves").alias("saves"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf"),
    )
    placed = landed(
        with_index(nodes.select("conv_id", "depth", "print", "_saves"), ["conv_id", "depth"], "_at"), "trie-chains"
    )
    above = running_sum(placed, ["conv_id"], "_at", "_saves", "_above", placed.count())
    members = lookup(
        prefixes.select("conv", "depth", "print"), chains.withColumnRenamed("conv_id", "conv"),
        ["conv"], ["depth"], "inner", counts=convs.select("conv", F.col("length").alias("_n")),
    )
    sums = members.groupBy("depth", "print").agg(
        F.sum("saves").alias("_below"), F.sum("leaf").cast("long").alias("n_leaves")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("print").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("_n"),
    )
    out = lookup(nodes, parents.drop("_n"), ["depth", "parent"], ["print"], "left", counts=parents.select("depth", "parent", "_n"))
    on = ["depth", "print"]
    out = out.join(sums, on).join(above.select(*on, "_above"), on).join(_ends(prefixes, convs), on, "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("_below") - F.col("_above")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        F.col("ref.ref_conv").alias("ref_conv"), F.col("ref.ref_place").alias("ref_place"),
    )
