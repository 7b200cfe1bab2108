"""Alerts over log streams: windows that the watermark has closed, and a state for each series that waits in event time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: The run of firing windows that a series is in: starts of its first and last window in microseconds, and how many there are.
RUN = "since long, until long, n long"


#: Timers need this state store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state where timers can be set; others of the session are left as they are."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        spark.conf.set(STORE[0], before) if before else spark.conf.unset(STORE[0])


def closed_windows(rows: DataFrame, ts: str, minutes: int, by: list[str], figures: dict[str, Column], late: str = "10 minutes") -> DataFrame:
    """``figures`` of each tumbling window of a stream, once the watermark has passed its end.

    window_start, window_time (what later operators go by), ``by``, ``figures``. In append mode each window comes once and stays as it is: a row more than
    ``late`` behind the newest whose window is closed is dropped (``late_groups``). Rows without a time are in no window.
    """
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    windows = timed.groupBy(F.window(ts, f"{minutes} minutes").alias("_w"), *by).agg(*[f.alias(n) for n, f in figures.items()])
    return windows.select(F.col("_w.start").alias("window_start"), F.window_time("_w").alias("window_time"), *by, *figures)


class _Hold(StatefulProcessor):
    """Follows the run of a series; its timer is the end of the window after the run's last one."""

    def __init__(self, width: int, hold: int, columns: list[str]):
        self.width, self.hold, self.columns = width, hold, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.run = handle, handle.getValueState("run", RUN)

    def _due(self, until: int) -> int:
        return (until + 2 * self.width) // 1000

    def _rows(self, key: tuple, runs: list[tuple]) -> Iterator[pd.DataFrame]:
        runs = [(*key, *r) for r in runs if r[-1] >= self.hold]
        if runs:
            yield pd.DataFrame(runs, columns=self.columns)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out, before = [], self.run.get()
        since, until, n = before or (0, 0, 0)
        for t, on in sorted((t, on) for f in rows for t, on in zip(f["at"].tolist(), f["firing"].tolist())):
            if n and not (on and t == until + self.width):
                out.append(("resolved", since, until, n))
                n = 0
            if on:
                since, until, n = since if n else t, t, n + 1
                if n == self.hold:
                    out.append(("firing", since, until, n))
        if before:
            self.handle.deleteTimer(self._due(before[1]))
        # The watermark has closed all windows before it: if it has passed the one after the run, that one had no rows.
        if n and timerValues.getCurrentWatermarkInMs() >= self._due(until):
            out.append(("resolved", since, until, n))
            n = 0
        if n:
            self.run.update((since, until, n))
            self.handle.registerTimer(self._due(until))
        elif before:
            self.run.clear()
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.run.get()
        self.run.clear()
        yield from self._rows(key, [("resolved", *last)] if last else [])

    def close(self) -> None:
        pass


def hold_stream(windows: DataFrame, by: list[str], firing: Column, hold: int, minutes: int) -> DataFrame:
    """Alerts of a stream of ``closed_windows``: ``by``, state, since, until, windows.

    A series whose windows fire (null: do not) ``hold`` times in a row gives a row ``firing`` when the last of these closes, and a row ``resolved``
    with the whole run once the next window has closed without firing or the watermark has passed it without rows; so the ``resolved`` rows are what
    ``metrics.alert_hold`` finds in the same windows. ``since`` and ``until`` are starts of windows. Kept for a series are three numbers, while it fires;
    a batch brings one task the windows of a series that closed meanwhile, however many rows they had. A checkpoint holds windows and
    runs, so a query that starts again goes on where it was, and with a file sink repeats and loses no alert. Start the query inside ``timers``.
    """
    rows = windows.select(*by, "window_time", F.unix_micros("window_start").alias("at"), F.coalesce(firing, F.lit(False)).alias("firing"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*by).schema)
    columns = [*by, "state", "since", "until", "windows"]
    found = rows.groupBy(*by).transformWithStateInPandas(
        _Hold(minutes * 60_000_000, hold, columns), f"{kinds}, state string, since long, until long, windows long", "append", "EventTime")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("since", "until")})


def late_groups(query: StreamingQuery) -> int:
    """How many groups of late rows the last batches of a query dropped. Rows of one task, window and series were put together before and count once."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
