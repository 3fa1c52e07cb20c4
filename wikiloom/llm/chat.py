"""Conversations as training windows with a token budget, in DataFrame operations only.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is doubled and
``<|`` becomes ``<\\|``, so no text can forge a mark and every text can be read back; a line break in
a role becomes ``<\\>``.

The tokens of turns (words and signs, and four for the marks) are summed up in order. From a turn's
prefix sum its span follows: SPAN windows' room of tokens, so a span is bounded and a long conversation has many.
In a span, a window begins at the first turn whose end would pass the room that the budget leaves beside
system turn and history, counted from the prefix sum at which the window before began. Windows so
begin and end at turns and keep the budget; only one whose single new turn is longer than the room
passes it, and is marked ``over_budget`` (the room is MIN_ROOM at least, if a system turn takes the rest).
Each window begins with the conversation's system turn (its first turn, if a system's), repeats
the turns whose tokens lie within HISTORY before its first new turn, and then has its new turns. The
loss mask holds the texts of new assistant turns only: repeated ones are masked, so each target
counts once.

Null texts and roles count as empty. Turns are ordered by number (null first), then role and text;
rows that repeat stay. A null conversation is one of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.text import bind
from wikiloom.llm.arrays import before
from wikiloom.llm.ordered import running_sum
from wikiloom.scale import landed, lookup, with_index

BUDGET = 2048
HISTORY = 256
MIN_ROOM = 256
SPAN = 16
START, END = "<|im_start|>", "<|im_end|>"
TURN_TOKENS = 4


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\>"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\>"), F.lit("\n")))


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")) + TURN_TOKENS


def placed_turns(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with their place, prefix sum (of turns before it, but the system turn), cost, room and system flag."""
    blank = F.lit("")
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("c"),
        F.col("conv_id").isNull().alias("c_null"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    ).withColumn("cost", tokens(F.col("text")).cast("long"))
    order = ["c", "c_null", F.col("turn").asc_nulls_first(), "role", F.xxhash64("text")]
    rows = with_index(rows, order, "place")
    keys = ["c", "c_null"]
    count = rows.count()
    first = rows.groupBy(*keys).agg(
        F.min_by(F.struct("role", "cost"), "place").alias("_first"),
        F.min("place").alias("_at"), F.count(F.lit(1)).alias("_n"),
    ).withColumn(
        "system_cost", F.when(F.col("_first.role") == "system", F.col("_first.cost")).otherwise(0)
    )
    rows = lookup(
        rows, first.drop("_first", "_n"), keys, ["place"], "inner", counts=first.select(*keys, "_n")
    )
    rows = rows.withColumn("is_system", (F.col("place") == F.col("_at")) & (F.col("role") == "system"))
    rows = rows.withColumn("_cost", F.when(F.col("is_system"), 0).otherwise(F.col("cost")).cast("long"))
    rows = running_sum(rows, keys, "place", "_cost", "sum", count)
    room = F.greatest(F.lit(budget - history) - F.col("system_cost"), F.lit(MIN_ROOM)).cast("long")
    return rows.withColumn("room", room).drop("_cost", "_at", "system_cost")


def windowed_turns(rows: DataFrame) -> DataFrame:
    """Placed turns with their window, named by the prefix sum at which it begins.

    A span's turns are folded in order, keeping the sum at which the present window begins. A span
    has at most SPAN * room tokens and one turn beyond, in one row.
    """
    # The system turn has sum 0 and so is new in window 0, as is the turn after it.
    turn = F.struct("place", "sum", F.when(F.col("is_system"), 0).otherwise(F.col("cost")).alias("new"),
                    "cost", "role", "text", "is_system")
    spans = rows.groupBy("c", "c_null", F.floor(F.col("sum") / (F.col("room") * SPAN)).alias("_span")).agg(
        F.array_sort(F.collect_list(turn)).alias("_turns"), F.first("room").alias("_room")
    )
    none = F.array().cast("array<bigint>")

    def begun(starts: Column, t: Column) -> Column:
        over = t["sum"] + t["new"] - F.element_at(starts, -1) > F.col("_room")
        fresh = (F.size(starts) == 0) | (over & (t["sum"] > F.element_at(starts, -1)))
        return F.when(fresh, F.array_append(starts, t["sum"])).otherwise(starts)

    spans = spans.withColumn("_starts", F.aggregate("_turns", none, begun))
    each = spans.select("c", "c_null", "_starts", F.inline("_turns"))
    window = F.array_max(F.filter("_starts", lambda s: s <= F.col("sum")))
    return each.withColumn("window", window).drop("_starts", "new")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Per window: conv_id, window (the tokens of new turns before it), text, n_context (leading turns
    that are repeated), n_turns, targets (array of start, end in code points: the loss mask), n_tokens
    and over_budget."""
    rows = landed(windowed_turns(placed_turns(turns, budget, history)), "chat-turns")
    keys = ["c", "c_null"]
    starts = rows.select(*keys, "window").distinct()
    columns = [*keys, "window", "place", "role", "text", "cost"]
    # History: turns whose tokens lie within reach before the first new turn. Sums are dealt into
    # cells of that length, of which a window's reach touches two.
    cell = max(history, 1)
    probes = starts.where("window > 0").withColumn("_cell", F.explode(F.sequence(
        F.floor((F.col("window") - history) / cell), F.floor((F.col("window") - 1) / cell)
    )))
    earlier = rows.where("not is_system").select(
        *keys, "place", "role", "text", "cost", "sum", F.floor(F.col("sum") / cell).alias("_cell")
    )
    repeated = earlier.join(probes, [*keys, "_cell"]).where(
        (F.col("sum") < F.col("window")) & (F.col("sum") >= F.col("window") - history)
    )
    # The system turn goes into every window but its own.
    system = rows.where("is_system").select(*keys, "place", "role", "text", "cost")
    sized = starts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    headed = lookup(starts.where("window > 0"), system, keys, ["window"], "inner", counts=sized)
    again = F.lit(True).alias("again")
    everything = rows.select(*columns, F.lit(False).alias("again")).unionByName(
        repeated.select(*columns, again)
    ).unionByName(headed.select(*columns, again))
    grouped = everything.groupBy(*keys, "window").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text", "again"))).alias("turns"),
        F.sum("cost").alias("n_tokens"),
    )

    def pieces(turn: Column) -> Column:
        head = F.concat(F.lit(START), escaped_role(turn["role"]), F.lit("\n"))
        body = escaped(turn["text"])
        return F.struct(
            F.concat(head, body, F.lit(END + "\n")).alias("all"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
            (~turn["again"] & (turn["role"] == "assistant")).alias("target"),
        )

    def targets(parts: Column) -> Column:
        at = before(F.transform(parts, lambda p: F.length(p["all"]).cast("long")))
        spans = bind(at, lambda at: F.transform(parts, lambda p, i: F.struct(
            (F.get(at, i) + p["head"]).cast("int").alias("start"),
            (F.get(at, i) + p["head"] + p["body"]).cast("int").alias("end"),
            p["target"].alias("target"),
        )))
        return F.transform(
            F.filter(spans, lambda s: s["target"]), lambda s: F.struct(s["start"], s["end"])
        )

    parts = grouped.withColumn("parts", F.transform("turns", pieces))
    return parts.select(
        F.when(~F.col("c_null"), F.col("c")).alias("conv_id"),
        "window",
        F.array_join(F.transform("parts", lambda p: p["all"]), "").alias("text"),
        F.size(F.filter("turns", lambda t: t["again"])).alias("n_context"),
        F.size("turns").alias("n_turns"),
        targets(F.col("parts")).alias("targets"),
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_back(output: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: conv_id, n_turns, turns (role, text), losses (array
    of target texts), formatted_chars. Gathers a conversation's texts in a row."""
    mark = START.replace("|", r"\|")
    tail = len(END) + 1

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        return F.struct(
            unescaped_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"),
            unescaped(F.substring(piece, cut + 1, F.length(piece) - cut - tail)).alias("text"),
        )

    found = F.transform(F.slice(F.split("text", mark), 2, 1 << 30), turn)
    new = F.slice(found, F.col("n_context") + 1, F.lit(1 << 30))
    losses = F.transform(
        "targets", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
    )
    rows = output.select(
        "conv_id", "window", new.alias("new"), losses.alias("losses"),
        F.length("text").cast("long").alias("chars"),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "new", "losses"))).alias("_w"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        F.flatten(F.transform("_w", lambda w: w["new"])).alias("turns"),
        F.flatten(F.transform("_w", lambda w: w["losses"])).alias("losses"),
        "formatted_chars",
    ).withColumn("n_turns", F.size("turns").cast("long"))
