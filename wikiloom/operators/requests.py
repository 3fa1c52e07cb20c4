"""Analysis of a request log: classes, delays, summary, verdict, slow streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.scale import with_index

# Fixed values, in seconds
SLOW, CRITICAL = 5.0, 15.0
PING_WARN, PING_CRITICAL = 3.0, 8.0


def request_class(elapsed: Column, http_status: Column) -> Column:
    """OK, WARN, CRITICAL by time; ERROR where there was no answer (null status)."""
    return (
        F.when(http_status.isNull(), F.lit("ERROR"))
        .when(elapsed > CRITICAL, F.lit("CRITICAL"))
        .when(elapsed > SLOW, F.lit("WARN"))
        .otherwise(F.lit("OK"))
    )


def parsed_label(label: Column) -> tuple[Column, Column]:
    """Kind and subject of a request label such as ``v3/9 [Title]``."""
    bare = F.regexp_replace(label, "^ERROR:", "")
    kind = (
        F.when(F.regexp_like(bare, F.lit(r"^v\d+/\d+ ")), F.lit("version"))
        .when(F.startswith(bare, F.lit("version_count ")), F.lit("version_count"))
        .when(F.startswith(bare, F.lit("page_list ")), F.lit("page_list"))
        .when(F.regexp_like(bare, F.lit("health")), F.lit("health"))
        .otherwise(F.lit("other"))
    )
    return kind, F.regexp_extract(bare, r"(?s)\[(.*)\]", 1)


def classified(log: DataFrame) -> DataFrame:
    kind, subject = parsed_label(F.col("label"))
    return log.withColumns(
        {
            "class": request_class(F.col("elapsed"), F.col("http_status")),
            "kind": kind,
            "subject": subject,
        }
    )


def throttle_delay(elapsed: Column) -> Column:
    """Extra wait between requests after a ping of this length."""
    return F.when(elapsed > PING_CRITICAL, 10.0).when(elapsed > PING_WARN, 5.0).otherwise(0.0)


def probe_delay(elapsed: Column) -> Column:
    """Wait between batches after a probe of this length; null is no answer."""
    return (
        F.when(elapsed.isNull(), 60.0)
        .when(elapsed > PING_CRITICAL, 30.0)
        .when(elapsed > PING_WARN, 10.0)
        .otherwise(5.0)
    )


def log_summary(log: DataFrame) -> DataFrame:
    """One row of totals. ``log(ts, seq, elapsed, label, http_status)``; ``seq`` breaks ties.

    Requests without an answer count as requests and errors; their time is not counted.
    """
    answered = F.col("http_status").isNotNull()
    time = F.when(answered, F.col("elapsed"))
    place, moment = F.struct("ts", "seq"), F.col("ts").cast("timestamp")
    kind, subject = parsed_label(F.col("label"))
    rows = log.withColumns({"_kind": kind, "_subject": subject, "_time": time, "_place": place})
    first = F.min_by("elapsed", "_place")
    last = F.max_by("elapsed", "_place")
    return rows.agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("_time").alias("total_time"),
        ((F.unix_micros(F.max(moment)) - F.unix_micros(F.min(moment))) / 1_000_000).alias("wall_time"),
        (F.sum("_time") / F.count(F.lit(1))).alias("mean_response"),
        F.max("_time").alias("max_response"),
        first.alias("baseline"),
        last.alias("final"),
        F.when(first != 0, last / first).alias("degradation"),
        F.count_if(answered & (F.col("elapsed") > SLOW) & (F.col("elapsed") <= CRITICAL)).alias(
            "warnings"
        ),
        F.count_if(answered & (F.col("elapsed") > CRITICAL)).alias("criticals"),
        F.count_if(~answered | (F.col("http_status") != 200)).alias("errors"),
        F.count_if(F.col("_kind") == "version_count").alias("pages"),
        F.count_if(F.col("_kind") == "version").alias("versions"),
    )


def load_verdict(
    summary: DataFrame, batch_size: int = 25, delay: float = 0.3, page_cooldown: int = 0
) -> DataFrame:
    """Verdict on the load and, where it was too high, gentler settings."""
    over = F.col("criticals") > 0
    near = F.col("warnings") > 0
    return summary.select(
        F.when(over, F.lit("overload")).when(near, F.lit("borderline")).otherwise(F.lit("safe"))
        .alias("verdict"),
        F.when(over, F.lit(max(batch_size // 2, 5))).alias("batch_size"),
        F.when(over, F.lit(delay * 2)).alias("delay"),
        F.when(over, F.lit(max(page_cooldown, 60)))
        .when(near, F.lit(max(page_cooldown, 30)))
        .alias("page_cooldown"),
    )


def slow_streaks(log: DataFrame, limit: float = SLOW) -> DataFrame:
    """Runs of consecutive slow requests: length, where each began and ended.

    Within a run, the index among all requests and the index among slow ones grow together. Both
    come from range-partitioned sorts, so a single log of any length is split over tasks.
    """
    every = with_index(log.select("ts", "seq", "elapsed", "label"), ["ts", "seq"], "_all")
    slow = with_index(every.where(F.col("elapsed") > limit), ["_all"], "_slow")
    return slow.groupBy((F.col("_all") - F.col("_slow")).alias("_run")).agg(
        F.count(F.lit(1)).alias("length"),
        F.min("_all").alias("start"),
        F.min_by("label", "_all").alias("start_label"),
        F.max_by("label", "_all").alias("end_label"),
    ).drop("_run")


def longest_streak(streaks: DataFrame) -> DataFrame:
    """The longest run, the first among equals, with the requests that began and ended it."""
    best = F.min(F.struct((-F.col("length")).alias("_len"), "start", "start_label", "end_label"))
    return streaks.agg(best.alias("b")).where("b IS NOT NULL").select(
        (-F.col("b._len")).alias("length"),
        F.col("b.start_label").alias("start_label"),
        F.col("b.end_label").alias("end_label"),
    )


def space_summary(results: DataFrame) -> DataFrame:
    """Pages, versions, errors and rate per space.

    ``results(space, kind, ok, seconds)`` with kind page or version.
    """
    seconds = F.sum("seconds")
    pages = F.count_if((F.col("kind") == "page") & F.col("ok"))
    return results.groupBy("space").agg(
        pages.alias("pages"),
        F.count_if((F.col("kind") == "version") & F.col("ok")).alias("versions"),
        F.count_if((F.col("kind") == "page") & ~F.col("ok")).alias("errors"),
        F.when(seconds > 0, F.round(pages / seconds, 4)).alias("pages_per_second"),
    )
