"""Reading events as a stream: sessions and throttled progress.

The batch operators are lectern.operators.reading; these give the same rows. Events may come up to `late` after their
time and in any order within that: they wait in the state until the watermark has passed them, a timer then takes a
reader's waiting events in order of time. Besides them a reader's state is one row, dropped once nothing has come for
IDLE of the stream's time. State is kept in RocksDB, outside the workers' and executors' heaps.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lectern.operators.reading import SAVE_MS

SESSION = "user_id long, start_ts timestamp, end_ts timestamp, words long, ms long"
PROGRESS = "user_id long, ts timestamp, index long, tie long"
#: How late an event may come, and how long a reader's state outlives the last event.
LATE, IDLE_MS = "1 hour", 30 * 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which stateful processors ask for; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class _InOrder(StatefulProcessor):
    """Keeps events until the watermark has passed them, then hands them on in order of (us, tie)."""

    #: Of what step() carries along, beside the time of the last event.
    carried = ""
    columns: list[str] = []

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, tie long, playing boolean, index long")
        self.last = handle.getValueState("last", f"us long, {self.carried}")

    def step(self, carried: tuple, us: int, tie: int, playing: bool, index: int) -> tuple[tuple, tuple | None]:
        """What is carried on after an event, and the row that it gives, if any."""
        raise NotImplementedError

    def start(self) -> tuple:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest = 0
        for some in rows:
            us = some["ts"].astype("datetime64[us]").astype("int64")
            latest = max(latest, int(us.max()))
            self.waiting.appendList(list(zip(us.tolist(), some["tie"].tolist(), some["playing"].tolist(), some["index_"].tolist())))
        self.handle.registerTimer(latest // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready = [e for e in waiting if e[0] <= passed]
        at, *carried = self.last.get() if self.last.exists() else (0, *self.start())
        found = []
        for us, tie, playing, index in ready:
            carried, row = self.step(tuple(carried), us, tie, playing, index)
            if row is not None:
                found.append((key[0], *row))
            at = us
        if len(ready) == len(waiting):
            self.waiting.clear()
        elif ready:
            self.waiting.put(waiting[len(ready) :])
        if ready:
            self.last.update((at, *carried))
            self.handle.registerTimer(at // 1000 + IDLE_MS)
        elif at // 1000 + IDLE_MS <= passed // 1000 and not waiting:
            self.last.clear()
        if found:
            yield pd.DataFrame(found, columns=["user_id", *self.columns])

    def close(self) -> None:
        pass


class _Sessions(_InOrder):
    carried, columns = "start long, index long", ["start_ts", "end_ts", "words", "ms"]

    def start(self) -> tuple:
        return None, None

    def step(self, carried, us, tie, playing, index):
        start, from_ = carried
        if playing:
            return ((us, index), None) if start is None else (carried, None)
        if start is None:
            return carried, None
        ms, words = (us - start) // 1000, max(0, index - from_)
        return (None, None), ((pd.Timestamp(start, unit="us"), pd.Timestamp(us, unit="us"), words, ms) if ms > 0 and words > 0 else None)


class _Progress(_InOrder):
    carried, columns = "wrote long, index long", ["ts", "index", "tie"]

    def __init__(self, save_ms: int):
        self.save_us = 1000 * save_ms

    def start(self) -> tuple:
        return None, -1

    def step(self, carried, us, tie, playing, index):
        wrote, last = carried
        if index == last or (playing and wrote is not None and us - wrote < self.save_us):
            return carried, None
        return (us, index), (pd.Timestamp(us, unit="us"), index, tie)


def _by_reader(events: DataFrame, late: str):
    rows = events.withColumnRenamed("index", "index_").withColumn("ts", F.col("ts").cast("timestamp")).filter("ts is not null")
    return rows.withWatermark("ts", late).groupBy("user_id")


def session_stream(events: DataFrame, late: str = LATE) -> DataFrame:
    """Sessions of a stream of (user_id, ts, playing, index, tie), once the watermark has passed their pause (STR-01)."""
    return _by_reader(events, late).transformWithStateInPandas(_Sessions(), SESSION, "Append", "EventTime")


def progress_stream(events: DataFrame, save_ms: int = SAVE_MS, late: str = LATE) -> DataFrame:
    """Progress writes of a stream of (user_id, ts, playing, index, tie), once the watermark has passed them (STR-02)."""
    return _by_reader(events, late).transformWithStateInPandas(_Progress(save_ms), PROGRESS, "Append", "EventTime")
