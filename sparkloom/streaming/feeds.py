"""Back-off by feed: after failures a feed is left alone for a time that doubles. State by key, with timers that let it go."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

HOUR = 3_600_000_000
#: Microseconds: the first wait, and how long a feed may be silent before its failures are forgotten. Doublings at most.
WAIT, FORGET, DOUBLINGS = 6 * HOUR, 72 * HOUR, 4
OK, FAILED, HELD, LATE = "ok", "failed", "held", "late"
SCHEMA = "feed bigint, attempt bigint, action string, failures int, wait_until bigint"
STATE = "failures int, wait_until bigint, last bigint"


def step(state: tuple[int, int, int], at: int, failed: bool, wait: int = WAIT, forget: int = FORGET, doublings: int = DOUBLINGS) -> tuple[tuple[int, int, int], str]:
    """The state (failures in a row, end of the wait or 0, last seen) after an attempt, and what became of it."""
    failures, until, last = state
    if at < last:
        return state, LATE
    if last and at - last > forget:
        failures, until = 0, 0
    if at < until:
        return (failures, until, at), HELD
    if failed:
        return (failures + 1, at + wait * 2 ** min(failures, doublings), at), FAILED
    return (0, 0, at), OK


class BackOff(StatefulProcessor):
    """One state for each feed. A batch's attempts of a feed are taken in the order of time; one that is older than the state is late and changes nothing."""

    def __init__(self, wait: int, forget: int, doublings: int):
        self.limits = wait, forget, doublings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("feed", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        known = self.state.get() if self.state.exists() else (0, 0, 0)
        now, told = tuple(known), []
        for r in sorted(rows, key=lambda r: (r.at, r.attempt)):
            now, action = step(now, r.at, r.failed, *self.limits)
            told.append(Row(feed=key[0], attempt=r.attempt, action=action, failures=now[0], wait_until=now[1]))
        self.state.update(now)
        self.handle.registerTimer((now[2] + self.limits[1]) // 1000 + 1)
        yield from told

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        # Of a feed's timers the last one alone finds it silent for long enough.
        if self.state.exists() and self.state.get()[2] + self.limits[1] < expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def back_off(attempts: DataFrame, *, feed: Column, attempt: Column, at: Column, failed: Column, delay: str = "0 seconds", wait: int = WAIT, forget: int = FORGET, doublings: int = DOUBLINGS) -> DataFrame:
    """feed, attempt, action, failures and wait_until (microseconds, or 0) for each row of the stream attempts; at is a timestamp.

    The stream's session must keep state in RocksDB, see runs.state_session. Rows of later batches that are older
    than what a feed has seen are told as late; those that the watermark, `delay` behind the latest row, had
    passed before their batch are left out by Spark. Batches bound what a task holds of one feed. A feed that was
    silent for longer than `forget` starts anew; a timer frees its state when the watermark has passed that
    time, which changes no result. Rows without a feed are one feed, null; rows without a time are left out.
    """
    rows = attempts.select(feed.cast("long").alias("feed"), attempt.cast("long").alias("attempt"), at.cast("timestamp").alias("time"), F.coalesce(failed, F.lit(False)).alias("failed")).where("time IS NOT NULL")
    marked = rows.withWatermark("time", delay).select("*", F.unix_micros("time").alias("at"))
    return marked.groupBy("feed").transformWithState(BackOff(wait, forget, doublings), SCHEMA, "Append", "EventTime")
