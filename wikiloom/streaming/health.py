"""Server health on a stream of pings, with the same results as the batch operators.

Pings may come late and in any order, up to the watermark. They wait in keyed state until the watermark has
passed them, and are then taken in order of time and class; so results do not depend on how the stream is
cut into micro-batches. A few waiting pings of a server are one value; more of them are a map with a minute in
an entry, so that no long list is read at once. A pause gets an event-time timer for the longest
wait, which is deleted if the server resumes: a server that is never pinged again still yields its outage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wikiloom.operators.health import (
    BAD_STATUS_LIMIT,
    LONGEST_WAIT,
    NO_ANSWER_LIMIT,
    classified_pings,
)

_OUT = "server long, us long, event string, paused boolean, seconds double, recovered boolean"
_STATE = "failures int, paused boolean, paused_at long, reported boolean, alarm long"
_WAIT = int(LONGEST_WAIT * 1_000_000)
_MINUTE = 60_000_000
FEW = 64  # waiting pings of a server that are kept as one value


class HealthProcessor(StatefulProcessor):
    """Emits a ``change`` when a server pauses or resumes, and an ``outage`` when a pause ends or has
    lasted for the longest wait.

    A ping is taken once the watermark is past its time; times are in microseconds, those of the watermark
    and of timers in milliseconds. The timer of a ping is the millisecond it lies in.
    """

    def __init__(self, few: int) -> None:
        self._most = few

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._health = handle.getValueState("health", _STATE)
        self._few = handle.getValueState("few", "us array<long>, kinds array<string>, more boolean")
        self._waiting = handle.getMapState("waiting", "minute long", "us array<long>, kinds array<string>")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object
    ) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        first, changed = None, False
        us, kinds, more = self._few.get() if self._few.exists() else ([], [], False)
        us, kinds = list(us), list(kinds)
        for frame in rows:
            frame = frame[frame["us"] >= now]
            if frame.empty:
                continue
            changed = True
            us, kinds = us + frame["us"].tolist(), kinds + frame["kind"].tolist()
            first = min(us) if first is None else min(first, *us)
            if more or len(us) > self._most:
                self._put(us, kinds)
                us, kinds, more = [], [], True
        if changed:
            self._few.update((us, kinds, more))
            self._handle.registerTimer(first // 1000)
        return iter([])

    def _put(self, us: list[int], kinds: list[str]) -> None:
        minutes: dict[int, list] = {}
        for ping in zip(us, kinds):
            minutes.setdefault(ping[0] // _MINUTE, []).append(ping)
        for minute, pings in minutes.items():
            held = self._waiting.getValue((minute,)) if self._waiting.containsKey((minute,)) else ([], [])
            times, names = zip(*pings)
            self._waiting.updateValue((minute,), ([*held[0], *times], [*held[1], *names]))

    def handleExpiredTimer(
        self, key: tuple, timerValues: object, expiredTimerInfo: object
    ) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        failures, paused, paused_at, reported, alarm = (0, False, None, False, None)
        if self._health.exists():
            failures, paused, paused_at, reported, alarm = self._health.get()
        out = []
        for us, kind in self._due(now):
            then = paused
            if kind in ("bad status", "no answer"):
                failures += 1
                if failures >= (NO_ANSWER_LIMIT if kind == "no answer" else BAD_STATUS_LIMIT):
                    then = True
            else:
                failures = 0
                then = kind == "critical"
            waited = us - paused_at if paused else 0
            if paused and not reported and (not then or waited >= _WAIT):
                seconds = min(waited, _WAIT) / 1_000_000
                out.append((key[0], paused_at, "outage", True, seconds, waited < _WAIT))
                reported = True
            if then != paused:
                out.append((key[0], us, "change", then, None, None))
                paused, paused_at, reported = then, us if then else None, False
        if paused and not reported and paused_at + _WAIT < now:
            out.append((key[0], paused_at, "outage", True, LONGEST_WAIT, False))
            reported = True
        wanted = (paused_at + _WAIT) // 1000 if paused and not reported else None
        if wanted != alarm:
            if alarm is not None and alarm * 1000 >= now:
                self._handle.deleteTimer(alarm)
            if wanted is not None:
                self._handle.registerTimer(wanted)
        self._health.update((failures, paused, paused_at, reported, wanted))
        if out:
            yield pd.DataFrame(out, columns=["server", "us", "event", "paused", "seconds", "recovered"])

    def _due(self, now: int) -> Iterator[tuple[int, str]]:
        """Waiting pings before the watermark, in order; the next one to wait for gets a timer."""
        if not self._few.exists():
            return
        us, kinds, more = self._few.get()
        if not more:
            pings = sorted(zip(us, kinds))
            later = [p for p in pings if p[0] >= now]
            yield from pings[: len(pings) - len(later)]
            if not later:
                self._few.clear()
                return
            self._few.update(([p[0] for p in later], [p[1] for p in later], False))
            self._handle.registerTimer(later[0][0] // 1000)
            return
        self._put(us, kinds)
        for minute in sorted(k[0] for k in self._waiting.keys()):
            us, kinds = self._waiting.getValue((minute,))
            pings = sorted(zip(us, kinds))
            later = [p for p in pings if p[0] >= now]
            yield from pings[: len(pings) - len(later)]
            if later:
                self._waiting.updateValue((minute,), ([p[0] for p in later], [p[1] for p in later]))
                self._few.update(([], [], True))
                self._handle.registerTimer(later[0][0] // 1000)
                return
            self._waiting.removeKey((minute,))
        self._few.clear()

    def close(self) -> None:
        pass


def health_changes(pings: DataFrame, lateness: str = "10 minutes", few: int = FEW) -> DataFrame:
    """Stream of pauses, resumptions and outages per server: server, ts, event, paused, seconds, recovered.

    ``lateness`` is how far a ping may lie behind the latest one of any server; later ones are dropped.
    ``few`` waiting pings of a server are kept as one value.
    """
    return (
        classified_pings(pings)
        .withWatermark("ts", lateness)
        .select("server", "ts", F.unix_micros("ts").alias("us"), F.col("class").alias("kind"))
        .groupBy("server")
        .transformWithStateInPandas(
            statefulProcessor=HealthProcessor(few),
            outputStructType=_OUT,
            outputMode="Append",
            timeMode="EventTime",
        )
        .select("server", F.timestamp_micros("us").alias("ts"), "event", "paused", "seconds", "recovered")
    )
