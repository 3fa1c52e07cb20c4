"""The request log, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikiloom.catalog import standins
from wikiloom.catalog.registry import query
from wikiloom.operators import health, requests
from wikiloom.scale import scratch_path
from wikiloom.streaming.health import health_changes

L = standins.SQL_LOG


@query(
    "p17_classified_log",
    f"""SELECT seq, CASE WHEN http_status IS NULL THEN 'ERROR' WHEN elapsed > 15 THEN 'CRITICAL'
               WHEN elapsed > 5 THEN 'WARN' ELSE 'OK' END AS class,
               CASE left(label, 2) WHEN 've' THEN 'version_count' WHEN 'pa' THEN 'page_list'
                 WHEN 'he' THEN 'health' ELSE 'version' END AS kind,
               CASE WHEN left(label, 2) = 'he' THEN '' ELSE 'u' || server END AS subject
        FROM ({L})""",
)
def p17(spark: SparkSession, sf: str) -> DataFrame:
    log = requests.classified(standins.request_log(spark, sf))
    return log.select("seq", "class", "kind", "subject")


_SUMMARY = f"""
  SELECT count(*) AS requests, sum(elapsed) FILTER (http_status IS NOT NULL) AS total,
         (epoch_us(max(ts::TIMESTAMP)) - epoch_us(min(ts::TIMESTAMP))) / 1000000.0::DOUBLE AS wall_time,
         max(elapsed) FILTER (http_status IS NOT NULL) AS max_response,
         arg_min(elapsed, seq) AS baseline, arg_max(elapsed, seq) AS final,
         count(*) FILTER (http_status IS NOT NULL AND elapsed > 5 AND elapsed <= 15) AS warnings,
         count(*) FILTER (http_status IS NOT NULL AND elapsed > 15) AS criticals,
         count(*) FILTER (http_status IS NULL OR http_status <> 200) AS errors,
         count(*) FILTER (label LIKE 'version_count%') AS pages,
         count(*) FILTER (label LIKE 'v%/9 %') AS versions FROM ({L})"""


@query(
    "a6_log_summary",
    f"""SELECT requests, round(total, 3) AS total_time, round(total / requests, 6) AS mean_response,
               wall_time, max_response, baseline, final, round(final / baseline, 6) AS degradation,
               warnings, criticals, errors, pages, versions FROM ({_SUMMARY})""",
)
def a6(spark: SparkSession, sf: str) -> DataFrame:
    summary = requests.log_summary(standins.request_log(spark, sf))
    return summary.withColumns(
        {
            "total_time": F.round("total_time", 3),
            "mean_response": F.round("mean_response", 6),
            "degradation": F.round("degradation", 6),
        }
    )


@query(
    "a7_load_verdict",
    f"""SELECT CASE WHEN criticals > 0 THEN 'overload' WHEN warnings > 0 THEN 'borderline' ELSE 'safe'
               END AS verdict, CASE WHEN criticals > 0 THEN 12 END AS batch_size,
               CASE WHEN criticals > 0 THEN 0.6::DOUBLE END AS delay,
               CASE WHEN criticals > 0 THEN 60 WHEN warnings > 0 THEN 30 END AS page_cooldown
        FROM ({_SUMMARY})""",
)
def a7(spark: SparkSession, sf: str) -> DataFrame:
    return requests.load_verdict(requests.log_summary(standins.request_log(spark, sf)))


_STREAKS = f"""
  SELECT count(*) AS length, min(place) - 1 AS start, arg_min(label, place) AS start_label,
         arg_max(label, place) AS end_label
  FROM (SELECT place, label, place - row_number() OVER (ORDER BY place) AS run
        FROM (SELECT label, elapsed, row_number() OVER (ORDER BY ts, seq) AS place FROM ({L}))
        WHERE elapsed > 5) GROUP BY run"""


@query("w4_slow_streaks", _STREAKS)
def w4(spark: SparkSession, sf: str) -> DataFrame:
    return requests.slow_streaks(standins.request_log(spark, sf))


@query(
    "w4_longest_streak",
    f"""SELECT length, start_label, end_label FROM ({_STREAKS}) ORDER BY length DESC, start LIMIT 1""",
)
def w4_longest(spark: SparkSession, sf: str) -> DataFrame:
    return requests.longest_streak(requests.slow_streaks(standins.request_log(spark, sf)))


def pings(spark: SparkSession, sf: str) -> DataFrame:
    log = standins.request_log(spark, sf)
    return log.select("server", F.col("ts").cast("timestamp").alias("ts"), "elapsed", "http_status")


_CLASS = """CASE WHEN http_status IS NULL THEN 'no answer' WHEN http_status <> 200 THEN 'bad status'
  WHEN elapsed > 8 THEN 'critical' WHEN elapsed > 3 THEN 'warn' ELSE 'ok' END"""


@query(
    "t1_ping_classes",
    f"""SELECT server, ts, {_CLASS} AS class, CASE WHEN http_status IS NULL THEN 20.0::DOUBLE
          ELSE elapsed END AS response FROM ({L})""",
)
def t1(spark: SparkSession, sf: str) -> DataFrame:
    return health.classified_pings(pings(spark, sf)).select("server", "ts", "class", "response")


def _changes(source: str) -> str:
    return f"""
  WITH p AS (SELECT server, ts::TIMESTAMP AS ts, {_CLASS} AS class FROM ({source})),
  r AS (SELECT *, class IN ('bad status', 'no answer') AS bad,
               count(*) FILTER (class NOT IN ('bad status', 'no answer'))
                 OVER (PARTITION BY server ORDER BY ts, class) AS run FROM p),
  q AS (SELECT *, sum(bad::INT) OVER (PARTITION BY server, run ORDER BY ts, class) AS place FROM r),
  d AS (SELECT server, ts, CASE WHEN bad THEN TRUE ELSE class = 'critical' END AS paused, class FROM q
        WHERE NOT bad OR (class = 'no answer' AND place >= 2) OR place >= 3)
  SELECT server, ts, paused FROM (
    SELECT *, coalesce(lag(paused) OVER (PARTITION BY server ORDER BY ts, class), FALSE) AS before FROM d)
  WHERE paused <> before"""


def _outages(source: str, clock: str) -> str:
    return f"""
  SELECT server, ts AS paused_at, least(length, 300)::DOUBLE AS seconds, length < 300 AS recovered
  FROM (SELECT c.*, (epoch_us(coalesce(resumed, clock)) - epoch_us(ts)) / 1000000.0::DOUBLE AS length
        FROM (SELECT *, lead(ts) OVER (PARTITION BY server ORDER BY ts) AS resumed
              FROM ({_changes(source)})) c, ({clock}) k)
  WHERE paused AND (resumed IS NOT NULL OR length >= 300)"""


_CHANGES = _changes(L)
_OUTAGES = _outages(L, f"SELECT max(ts)::TIMESTAMP AS clock FROM ({L})")


@query("t2_pause_changes", _CHANGES)
def t2(spark: SparkSession, sf: str) -> DataFrame:
    return health.pause_changes(pings(spark, sf))


@query("t3_outages", _OUTAGES)
def t3(spark: SparkSession, sf: str) -> DataFrame:
    rows = pings(spark, sf)
    return health.outages(health.pause_changes(rows), rows)


# On the stream, pings come in four batches and up to five hours late; the watermark waits six hours.
BATCHES, LATE_HOURS, WAIT_HOURS = 4, 5, 6
_CLOCK = f"""SELECT make_timestamp(epoch_ms(max(ts)::TIMESTAMP) * 1000) - INTERVAL {WAIT_HOURS} HOUR AS clock
  FROM ({L})"""
_RELEASED = f"SELECT l.* FROM ({L}) l, ({_CLOCK}) k WHERE l.ts::TIMESTAMP < clock"


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    """Run the stream over the pings, batch by batch as they come, and read what it wrote.

    What the watermark has not passed at the end is still waiting.
    """
    landed = scratch_path(spark, "pings")
    rows = pings(spark, sf)
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    late = F.pmod(F.xxhash64("server", "ts"), F.lit(LATE_HOURS * 3600)) * 1_000_000
    batch = F.floor((F.unix_micros("ts") + late - first) * BATCHES / (last - first + 1))
    for number in range(BATCHES):
        part = rows.where(F.least(batch, F.lit(BATCHES - 1)) == number)
        part.repartition(2).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(landed)
    out = scratch_path(spark, "health")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(
        provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        job = (
            health_changes(stream, f"{WAIT_HOURS} hours")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", scratch_path(spark, "health-state"))
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        job.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
    return spark.read.parquet(out)


@query("t1_ping_class_stream", f"SELECT class, count(*) AS pings FROM (SELECT {_CLASS} AS class FROM ({L})) GROUP BY class")
def t1_stream(spark: SparkSession, sf: str) -> DataFrame:
    landed, out = scratch_path(spark, "pings"), scratch_path(spark, "classes")
    rows = pings(spark, sf)
    rows.write.parquet(landed)
    job = (
        health.classified_pings(spark.readStream.schema(rows.schema).parquet(landed))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "classes-state"))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return spark.read.parquet(out).groupBy("class").agg(F.count(F.lit(1)).alias("pings"))


@query("t2_pause_stream", _changes(_RELEASED))
def t2_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf).where("event = 'change'").select("server", "ts", "paused")


@query("t3_outage_stream", _outages(_RELEASED, _CLOCK))
def t3_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf).where("event = 'outage'").select(
        "server", F.col("ts").alias("paused_at"), "seconds", "recovered"
    )
