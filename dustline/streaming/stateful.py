"""Stuck-sensor detection over a stream whose hours arrive late and out of order.

State of a site: the hours held back, and the last value with the length of its run. An hour is
released when the watermark has passed it, so no earlier hour can still come; hours of one site are
then judged in order, whatever batch delivered them, and the flags equal those of a batch job.
Timers run on event time: one at the earliest hour held, and one that clears a site that has been
silent for ``idle_hours``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from dustline import params as P

OUTPUT = "site_id string, hour timestamp, pm25 double, stuck boolean"
HOUR = 3_600_000
#: A site silent for this long starts anew, as after the lateness a gap can no longer be filled.
IDLE_HOURS = 30 * 24
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_positions(values: np.ndarray, last: float | None, run: int) -> np.ndarray:
    """Place of each value in its run of equal values (0 for the first), continuing from ``last`` at place ``run``. A missing
    value equals nothing."""
    n = len(values)
    same = np.zeros(n, dtype=bool)
    same[1:] = values[1:] == values[:-1]
    same[:1] = last is not None and values[:1] == last
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(same, -1, at))
    # a run that began before the first value counts on from there
    return np.where(start < 0, at + run + 1, at - start)


class StuckDetector(StatefulProcessor):
    def __init__(self, idle_hours: int = IDLE_HOURS):
        self.idle = idle_hours * HOUR

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "hour_ms long, pm25 double")
        self.run = handle.getValueState("run", "hour_ms long, last double, run int")

    def _silent_from(self) -> int | None:
        return self.run.get()[0] + self.idle if self.run.exists() else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            hours = pdf["hour"].to_numpy().astype("datetime64[ms]").astype(np.int64)
            self.held.appendList(list(zip(hours.tolist(), pdf["pm25"].astype(float).tolist())))
            self.handle.registerTimer(int(hours.min()))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        rows = sorted(((r[0], r[1]) for r in self.held.get()), key=lambda r: r[0])
        ready = [r for r in rows if r[0] <= passed]
        wait = rows[len(ready):]
        if ready:
            values = np.array([np.nan if r[1] is None else r[1] for r in ready])
            hours = np.array([r[0] for r in ready])
            hour_before, last, run = self.run.get() if self.run.exists() else (None, None, 0)
            if hour_before is not None and hours[0] - hour_before > self.idle:
                last, run = None, 0
            places = run_positions(values, last, run)
            if wait:
                self.held.put(wait)
            else:
                self.held.clear()
            self.run.update((int(hours[-1]), float(values[-1]), int(places[-1])))
            self.handle.registerTimer(int(hours[-1]) + self.idle)
            yield pd.DataFrame({"site_id": key[0], "hour": hours.astype("datetime64[ms]"), "pm25": values, "stuck": places >= P.STUCK_RUN})
        elif not wait and (end := self._silent_from()) is not None and end <= passed:
            self.run.clear()
            self.held.clear()
        if wait:
            self.handle.registerTimer(int(wait[0][0]))

    def close(self) -> None:
        pass


def stuck_stream(hours: DataFrame, lateness: str = "7 days", idle_hours: int = IDLE_HOURS) -> DataFrame:
    """Adds ``stuck`` to a stream of site-hours (site_id, hour, pm25): the sixth equal value onward, in order of hour. An hour that is
    later than ``lateness`` is dropped, as its place in the order has been judged already. Rows without a site_id only move the clock."""
    hours.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # the condition names the event time, so the optimiser leaves it behind the watermark, which clock rows must reach
    return (hours.withWatermark("hour", lateness).where("CASE WHEN hour IS NOT NULL THEN site_id IS NOT NULL ELSE false END").groupBy("site_id")
            .transformWithStateInPandas(StuckDetector(idle_hours), OUTPUT, "append", "eventTime"))
