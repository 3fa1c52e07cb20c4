"""Server health from pings: classes, pauses and outages, over tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.operators.requests import PING_CRITICAL, PING_WARN
from wikiloom.scale import lookup, with_index

# Fixed values
NO_ANSWER_SECONDS = 20.0
BAD_STATUS_LIMIT, NO_ANSWER_LIMIT = 3, 2
LONGEST_WAIT = 300.0


def ping_class(elapsed: Column, http_status: Column) -> Column:
    """ok, warn, critical, bad status or no answer (null status)."""
    return (
        F.when(http_status.isNull(), F.lit("no answer"))
        .when(http_status != 200, F.lit("bad status"))
        .when(elapsed > PING_CRITICAL, F.lit("critical"))
        .when(elapsed > PING_WARN, F.lit("warn"))
        .otherwise(F.lit("ok"))
    )


def classified_pings(pings: DataFrame) -> DataFrame:
    """Works on tables and on streams."""
    status = F.col("http_status")
    return pings.withColumns(
        {
            "class": ping_class(F.col("elapsed"), status),
            "response": F.when(status.isNull(), F.lit(NO_ANSWER_SECONDS)).otherwise(
                F.col("elapsed")
            ),
        }
    )


def pause_changes(pings: DataFrame) -> DataFrame:
    """Moments at which work against a server pauses or resumes.

    A 200 decides by its time, and a failure decides once the run of failures since the last 200
    is long enough; other pings change nothing. The position in a run and the decision before come
    from global indexes, so a server with most of the pings is no single task.
    """
    rows = classified_pings(pings).select("server", "ts", "class")
    failed = F.col("class").isin("bad status", "no answer")
    every = with_index(rows, ["server", "ts", "class"], "_all")
    failures = with_index(every.where(failed).select("server", "ts", "class", "_all"), ["_all"], "_bad")
    failures = failures.withColumn("_run", F.col("_all") - F.col("_bad"))
    runs = failures.groupBy("server", "_run").agg(
        F.min("_all").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    placed = lookup(
        failures, runs.drop("_n"), ["server", "_run"], ["_all"], "inner", counts=runs
    ).withColumn("_place", F.col("_all") - F.col("_first") + 1)
    limit = F.when(F.col("class") == "no answer", NO_ANSWER_LIMIT).otherwise(BAD_STATUS_LIMIT)
    by_failure = placed.where(F.col("_place") >= limit).select(
        "server", "ts", "_all", F.lit(True).alias("paused")
    )
    by_answer = every.where(~failed).select(
        "server", "ts", "_all", (F.col("class") == "critical").alias("paused")
    )
    decisions = with_index(by_answer.unionByName(by_failure), ["_all"], "_at").drop("_all")
    before = decisions.select(
        "server", (F.col("_at") + 1).alias("_at"), F.col("paused").alias("_before")
    )
    return (
        decisions.join(before, ["server", "_at"], "left")
        .where(F.col("paused") != F.coalesce("_before", F.lit(False)))
        .select("server", "ts", "paused")
    )


def outages(changes: DataFrame, pings: DataFrame) -> DataFrame:
    """Pauses with their length in seconds, cut at the longest wait.

    A pause that has not ended counts once the clock is past that wait. The clock is the last ping of any
    server, so a server that is never pinged again has its outage too.
    """
    placed = with_index(changes, ["server", "ts"], "_at")
    ends = placed.select(
        "server", (F.col("_at") - 1).alias("_at"), F.col("ts").alias("resumed")
    )
    clock = pings.agg(F.max("ts").alias("_clock"))
    rows = (
        placed.where("paused").join(ends, ["server", "_at"], "left")
        .join(F.broadcast(clock))  # one row
        .withColumn(
            "_seconds",
            (F.unix_micros(F.coalesce("resumed", "_clock")) - F.unix_micros("ts")) / 1_000_000,
        )
        .where(F.col("resumed").isNotNull() | (F.col("_seconds") >= LONGEST_WAIT))
    )
    return rows.select(
        "server",
        F.col("ts").alias("paused_at"),
        F.least("_seconds", F.lit(LONGEST_WAIT)).alias("seconds"),
        (F.col("_seconds") < LONGEST_WAIT).alias("recovered"),
    )
