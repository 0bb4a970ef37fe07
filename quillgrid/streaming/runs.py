"""The states of runs, from a stream of reported ones: only allowed moves are made, and a run that doesn't end in time ends as an error.

Reports are kept until the watermark has passed them and then applied in the order of their time, so the result doesn't depend on how they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Not ready, first in line, waiting, in progress, complete, error, disabled, nothing to do. Fixed values.
STATES = "UHWPCEDN"
#: Where a run can go from each state; a new run is not ready or in progress.
MOVES = {"": "UP", "U": "WHD", "W": "HPD", "H": "WPD", "P": "CEN", "C": "U", "E": "UW", "D": "U", "N": "U"}
BUSY, FAILED = "P", "E"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MOVED = "run_id bigint, at bigint, event_id bigint, from_status string, to_status string, kind string"
#: A report that only moves the watermark.
MARK = -1


def settle_reports(now: str, since: int, reports: list[tuple[int, int, str]], upto: int | None, limit: int) -> tuple[str, int, list[tuple]]:
    """(state, since when, rows) after reports (time, event, status) in order; times in microseconds. Rows: time, event, from, to, kind.

    kind `move`; `illegal`: a report that the state doesn't allow, it changes nothing; `timeout`: a run that was busy for longer than `limit` failed at that time.
    upto: until when it is known that nothing more comes.
    """
    rows = []

    def late(until: int) -> None:
        nonlocal now, since
        if now == BUSY and until > since + limit:
            rows.append((since + limit, None, now, FAILED, "timeout"))
            now, since = FAILED, since + limit

    for at, event, status in sorted(reports):
        late(at)
        if status and status in MOVES[now]:
            rows.append((at, event, now, status, "move"))
            now, since = status, at
        else:
            rows.append((at, event, now, status, "illegal"))
    if upto is not None:
        late(upto)
    return now, since, rows


class RunStates(StatefulProcessor):
    """One timer per run: for its earliest report that is still kept, or for the time when it is busy for too long."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", StructType([StructField("at", LongType()), StructField("event_id", LongType()), StructField("status", StringType())]))
        self.now = handle.getValueState("now", StructType([StructField("status", StringType()), StructField("since", LongType())]))

    def _wake(self, times: list[int]) -> None:
        if times:
            self.handle.registerTimer(min(times) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(a), int(e), s) for b in rows for a, e, s in zip(b["at"], b["event_id"], b["status"]) if int(e) != MARK]
        if new:
            self.kept.appendList(new)
            self._wake([a for a, _, _ in new])
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        kept = [tuple(r) for r in self.kept.get()]
        ready = [r for r in kept if r[0] < upto]
        wait = [r for r in kept if r[0] >= upto]
        status, since = self.now.get() if self.now.exists() else ("", 0)
        status, since, rows = settle_reports(status, since, ready, upto, self.limit)
        self.now.update((status, since))
        if wait:
            self.kept.put(wait)
        else:
            self.kept.clear()
        self._wake([r[0] for r in wait] + ([since + self.limit] if status == BUSY else []))
        if rows:
            out = pd.DataFrame(rows, columns=["at", "event_id", "from_status", "to_status", "kind"])
            out.insert(0, "run_id", int(key[0]))
            out["event_id"] = out["event_id"].astype("Int64")
            yield out

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession):
    """The state store that timers need, for queries that are started meanwhile (a query keeps the one that it was begun with); the session's own setting comes back."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def run_states(reports: DataFrame, limit: int, late: str) -> DataFrame:
    """The moves (MOVED) of a stream of run_id, ts, at (ts in microseconds), event_id and status. `limit`: microseconds that a run may be busy. To be started within state_store()."""
    timed = reports.withWatermark("ts", late)
    return timed.groupBy("run_id").transformWithStateInPandas(RunStates(limit), MOVED, "Append", "EventTime")


def marks(spark: SparkSession, folder: str, times: list[str]) -> Iterator[None]:
    """Writes one file after the other with a report that belongs to no run, each later than the one before."""
    for n, time in enumerate(times):
        mark = spark.sql(f"SELECT {MARK}L AS run_id, TIMESTAMP '{time}' AS ts, unix_micros(TIMESTAMP '{time}') AS at, {MARK}L AS event_id, '' AS status")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{folder}/mark={n}")
        yield
