"""Which errors of a source are passed over, as a stream with state by source.

The same rules as ``metrics.suppressed``: errors of a class are counted within a window of
time since the last data of their source. The state holds the errors of the last
window by class and millisecond, so it is bounded by the window, and the time of the
last data; each batch drops what no later row can count.

Rows of one source come in order of time from batch to batch; within a batch they may come in any order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "event_id long, source string, kind string, ts_ms long, in_window long, suppressed boolean"


class ErrorWindows(StatefulProcessor):
    def __init__(self, window_ms: int, most: int):
        self.window_ms, self.most = window_ms, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "kind string, ts_ms long", "n long")
        self.since = handle.getValueState("since", "ts_ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["ts_ms", "is_data"], ascending=[True, False], kind="stable")
        is_data = new["is_data"].to_numpy(bool)
        held = {k: v[0] for k, v in self.counts.iterator()} if self.counts.exists() else {}
        since = self.since.get()[0] if self.since.exists() else None
        errors = pd.DataFrame([(c, t, n) for (c, t), n in held.items()], columns=["kind", "ts_ms", "n"])
        data = np.sort(np.concatenate([[since] if since is not None else [], new["ts_ms"].to_numpy(np.int64)[is_data]]).astype(np.int64))
        out = []
        for cls, mine in new[~is_data].groupby("kind", sort=False):
            times = mine["ts_ms"].to_numpy(np.int64)
            old = errors[errors["kind"] == cls].sort_values("ts_ms")
            every = np.sort(np.concatenate([np.repeat(old["ts_ms"].to_numpy(np.int64), old["n"].to_numpy(np.int64)), times]))
            # From the later of the window's start and the last data up to the error itself, with all of its millisecond.
            place = np.searchsorted(data, times, "right") - 1
            begin = times - self.window_ms
            if len(data):
                begin = np.maximum(begin, np.where(place >= 0, data[place], begin))
            n = np.searchsorted(every, times, "right") - np.searchsorted(every, begin, "left")
            few = (n <= self.most) & (cls != "SerializationException")
            out.append(mine.assign(in_window=n, suppressed=few | mine["retriable"].to_numpy(bool)))
            for t, k in zip(*np.unique(times, return_counts=True), strict=True):
                held[(cls, int(t))] = held.get((cls, int(t)), 0) + int(k)
        now = int(new["ts_ms"].max())
        if len(data):
            since = int(data[-1])
            self.since.update((since,))
        self._keep(held, max(now - self.window_ms, since if since is not None else now - self.window_ms))
        if out:
            yield pd.concat(out).assign(source=str(key[0]))[["event_id", "source", "kind", "ts_ms", "in_window", "suppressed"]]

    def _keep(self, held: dict, least: int) -> None:
        """Store the errors that a later row can still count."""
        self.counts.clear()
        for k, n in held.items():
            if k[1] >= least:
                self.counts.updateValue(k, (n,))


def suppressed(rows: DataFrame, window_ms: int = 15_000, most: int = 2) -> DataFrame:
    """rows (source, class, ts_ms, event_id, retriable, is_data) as a stream of its errors with ``in_window`` and ``suppressed``. Needs the RocksDB state store."""
    # Rows travel as named tuples, whose fields can't be called "class".
    wanted = rows.select("source", F.col("class").alias("kind"), "ts_ms", "event_id", "retriable", "is_data")
    return wanted.groupBy("source").transformWithStateInPandas(ErrorWindows(window_ms, most), OUTPUT, "update", "None").withColumnRenamed("kind", "class")
