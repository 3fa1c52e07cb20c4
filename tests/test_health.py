from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wikiloom.operators import health, requests
from wikiloom.scale import scratch_path
from wikiloom.streaming.health import health_changes

SCHEMA = "server long, ts timestamp, elapsed double, http_status int"
START = dt.datetime(2024, 1, 1)


def pings(seed, servers=4, count=120):
    rng = random.Random(seed)
    return [
        (s, START + dt.timedelta(seconds=40 * i + s), round(rng.random() * 12, 2), rng.choice([200, 200, 200, 500, None]))
        for s in range(servers)
        for i in range(count)
    ]


def kind(row):
    if row[3] is None:
        return "no answer"
    return "bad status" if row[3] != 200 else "critical" if row[2] > 8 else "warn" if row[2] > 3 else "ok"


def replay(rows):
    """The monitor ping by ping."""
    changes, state = [], {}
    for server, ts, elapsed, status in sorted(rows, key=lambda r: (r[0], r[1], kind(r))):
        failures, paused = state.get(server, (0, False))
        now = paused
        if status == 200:
            failures, now = 0, elapsed > 8
        else:
            failures += 1
            if failures >= (2 if status is None else 3):
                now = True
        if now != paused:
            changes.append((server, ts, now))
        state[server] = (failures, now)
    return changes


def waits(rows):
    """Pauses with their length, cut at five minutes; the clock is the last ping of any server."""
    last = max(r[1] for r in rows)
    out, begun = [], {}
    for server, ts, paused in replay(rows):
        if paused:
            begun[server] = ts
        else:
            out.append((server, begun.pop(server), ts))
    full = [(s, at, (end - at).total_seconds()) for s, at, end in out]
    full += [
        (s, at, (last - at).total_seconds())
        for s, at in begun.items()
        if (last - at).total_seconds() >= 300
    ]
    return {(s, at, min(n, 300.0), n < 300) for s, at, n in full}


def test_batch(spark):
    rows = pings(1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    changes = health.pause_changes(frame)
    got = sorted((r.server, r.ts, r.paused) for r in changes.collect())
    assert got == sorted(replay(rows)) and got
    found = {(r.server, r.paused_at, r.seconds, r.recovered) for r in health.outages(changes, frame).collect()}
    assert found == waits(rows)


@pytest.mark.parametrize("few", [64, 3])
def test_stream_over_several_batches(spark, few):
    """Pings land in five files, up to nine minutes late, some at equal times; one server falls silent."""
    rows = pings(2) + [(s, t, 9.0, 503) for s, t, _, _ in pings(2)[::5]]
    rows += [(9, START + dt.timedelta(seconds=60 * i), 12.0, 200) for i in range(3)]
    rng = random.Random(7)
    arrivals = sorted((t + dt.timedelta(seconds=rng.randint(0, 540)), n) for n, (_, t, _, _) in enumerate(rows))
    end = max(r[1] for r in rows) + dt.timedelta(hours=1)
    batches = [[rows[n] for _, n in arrivals[i : i + 130]] for i in range(0, len(arrivals), 130)]
    batches.append([(77, end, 1.0, 200)])
    batches.append([(0, START, 9.0, 200), (9, START + dt.timedelta(seconds=30), 1.0, 200)])  # beyond the watermark
    landed, out = scratch_path(spark, "pings"), scratch_path(spark, "out")
    per_batch = []
    for part in batches:
        spark.createDataFrame(part, SCHEMA).repartition(1).write.mode("append").parquet(landed)
        job = (
            health_changes(spark.readStream.schema(SCHEMA).parquet(landed), few=few)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", out + "-state")
            .trigger(availableNow=True)
            .start()
        )
        job.awaitTermination()
        per_batch.append(spark.read.parquet(out).count())
    assert len(set(per_batch)) > 3  # results come as the watermark passes, not at the end
    events = spark.read.parquet(out)
    changes = events.where("event = 'change'").collect()
    assert sorted((r.server, r.ts, r.paused) for r in changes) == sorted(replay(rows))
    outages = events.where("event = 'outage'").collect()
    got = sorted((r.server, r.ts, r.seconds, r.recovered) for r in outages)
    assert got == sorted(waits(rows + [(77, end, 1.0, 200)]))
    assert (9, START, 300.0, False) in got

    frame = spark.createDataFrame(rows + [(77, end, 1.0, 200)], SCHEMA).repartition(4)
    batch = health.outages(health.pause_changes(frame), frame).collect()
    assert sorted((r.server, r.paused_at, r.seconds, r.recovered) for r in batch) == got


def test_thresholds(spark):
    rows = [(0, START, e, s) for e, s in ((3.0, 200), (3.1, 200), (8.0, 200), (8.1, 200), (1.0, 503), (1.0, None))]
    got = [r["class"] for r in health.classified_pings(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == ["ok", "warn", "warn", "critical", "bad status", "no answer"]
    frame = spark.createDataFrame([(e,) for e in (1.0, 3.0, 3.1, 8.1, None)], "e double")
    delays = frame.select(requests.throttle_delay(F.col("e")).alias("t"), requests.probe_delay(F.col("e")).alias("p"))
    assert [tuple(r) for r in delays.collect()] == [(0.0, 5.0), (0.0, 5.0), (5.0, 10.0), (10.0, 30.0), (0.0, 60.0)]


def test_streaks(spark):
    rng = random.Random(4)
    rows = [(START + dt.timedelta(seconds=i), i, rng.choice([1.0, 6.0, 16.0]), f"r{i}", 200) for i in range(400)]
    frame = spark.createDataFrame(rows, "ts timestamp, seq long, elapsed double, label string, http_status int")
    best, run, first = (0, None, None), 0, None
    for row in rows:
        if row[2] > 5:
            run += 1
            first = first if run > 1 else row[3]
            if run > best[0]:
                best = (run, first, row[3])
        else:
            run = 0
    got = requests.longest_streak(requests.slow_streaks(frame)).first()
    assert (got.length, got.start_label, got.end_label) == best
    calm = requests.slow_streaks(frame.where("elapsed = 1.0"))
    assert calm.count() == 0 and requests.longest_streak(calm).count() == 0


def test_summary_and_verdict(spark):
    schema = "ts timestamp, seq long, elapsed double, label string, http_status int"
    rows = [
        (START, 0, 0.5, "baseline health", 200),
        (START, 1, 6.0, "version_count [A]", 200),
        (START, 2, 16.0, "v1/9 [A]", 500),
        (START, 3, 20.0, "ERROR:v2/9 [A]", None),
        (START, 4, 1.0, "final health", 200),
    ]
    summary = requests.log_summary(spark.createDataFrame(rows, schema))
    r = summary.first()
    assert r.wall_time == 0.0
    assert (r.requests, r.total_time, r.mean_response, r.max_response) == (5, 23.5, 4.7, 16.0)
    assert (r.baseline, r.final, r.degradation) == (0.5, 1.0, 2.0)
    assert (r.warnings, r.criticals, r.errors, r.pages, r.versions) == (1, 1, 2, 1, 2)
    v = requests.load_verdict(summary).first()
    assert (v.verdict, v.batch_size, v.delay, v.page_cooldown) == ("overload", 12, 0.6, 60)
