"""Metrics: names and values as a reader's monitoring shows them, error windows, and counters of a running plan."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def metric_name(name: Column, topic: Column) -> Column:
    """``topic:name`` for metrics of a topic, else the name with its last point as a colon."""
    return F.when(topic.isNotNull(), F.concat(topic, F.lit(":"), name)).otherwise(F.regexp_replace(name, r"\.([^.]*)$", ":$1"))


def metric_value(value: Column, factor: int = 1) -> Column:
    """Rounded half up towards plus infinity; null, NaN and minus infinity are 0."""
    scaled = value.cast("double") * factor
    return F.when(scaled.isNull() | F.isnan(scaled) | (scaled == float("-inf")), F.lit(0)).otherwise(F.floor(scaled + 0.5)).cast("long")


def suppressed(errors: DataFrame, window_ms: int = 15_000, most: int = 2, data: DataFrame | None = None) -> DataFrame:
    """errors (source, class, ts_ms) with ``in_window`` and ``suppressed``: at most ``most`` of a class within the window are passed over.

    data: (source, ts_ms) of records that came in; they begin the count of their source anew. With a column
    ``retriable`` such errors are always passed over. Errors of serialisation never are.
    """
    keys = ["source", "class"]
    if data is not None:
        both = errors.withColumn("__data", F.lit(None).cast("long")).unionByName(data.select("source", "ts_ms", F.col("ts_ms").alias("__data")), allowMissingColumns=True)
        so_far = Window.partitionBy("source").orderBy("ts_ms", F.col("__data").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        errors = both.withColumn("__since", F.last("__data", ignorenulls=True).over(so_far)).where("__data is null").drop("__data")
        keys.append("__since")
    w = Window.partitionBy(*keys).orderBy("ts_ms").rangeBetween(-window_ms, 0)
    few = F.when(F.col("class") == "SerializationException", False).otherwise(F.col("in_window") <= most)
    if "retriable" in errors.columns:
        few = F.when(F.col("retriable"), True).otherwise(few)
    return errors.withColumn("in_window", F.count("*").over(w)).withColumn("suppressed", few).drop("__since")


def observed(df: DataFrame, name: str = "reader") -> tuple[DataFrame, Observation]:
    """``df`` with counters that are there after any action: rows, and rows without a message."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("nSubmitted"), F.count_if(F.col("message").isNull()).alias("nDroppedMalformedMessages")), seen


def reader_counters(positions: DataFrame, group_managed: bool) -> DataFrame:
    """(name, value) of what a reader with these (topic, partition, ...) reads. What pauses a client's queue has no counterpart: Spark pulls."""
    c = positions.select("topic", "partition").distinct().agg(F.count("*").alias("n"), F.countDistinct("topic").alias("t"))
    values = {"nAssignedPartitions": F.col("n"), "nConsumedTopics": F.col("t"), "isGroupManagementActive": F.lit(int(group_managed)).cast("long")}
    return c.select(F.explode(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])).alias("name", "value"))


def sent(topics: list[str], records: str = "records") -> list[Column]:
    """Sums over the rows of ``sink.routed``, by topic: records and bytes to send, and records with a failure. They can be observed in a running plan or aggregated."""
    of = lambda topic: F.filter(F.col(records), lambda r: r["topic"] == topic)
    out = []
    for t in topics:
        mine = of(t)
        good = F.filter(mine, lambda r: r["failure"].isNull())
        length = lambda r: F.coalesce(F.octet_length(r["key"]), F.lit(0)) + F.coalesce(F.octet_length(r["value"]), F.lit(0))
        size = F.aggregate(good, F.lit(0).cast("long"), lambda acc, r: acc + length(r).cast("long"))
        values = {"record-send-total": F.size(good), "byte-total": size, "record-error-total": F.size(mine) - F.size(good)}
        out += [F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(f"{t}:{name}") for name, v in values.items()]
    return out


def received(topics: list[str]) -> list[Column]:
    """Sums over the records of a log by topic: records and bytes consumed, and the highest offset."""
    out = []
    for t in topics:
        mine = F.col("topic") == t
        length = F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))
        out += [F.count_if(mine).alias(f"{t}:records-consumed-total"), F.coalesce(F.sum(F.when(mine, length)), F.lit(0)).cast("long").alias(f"{t}:bytes-consumed-total")]
    return out


class Measures(StreamingQueryListener):
    """Totals and rates of what running queries observe, and how long their batches and commits take.

    A rate is the sum of what came, each part fading with the time constant ``fade_s``, by that constant: the mean of a
    window without an edge. Sizes and latencies have their mean and maximum over all batches.
    """

    def __init__(self, fade_s: float = 30.0):
        self.fade_s = fade_s
        self.totals: dict[str, int] = {}
        self.rates: dict[str, float] = {}
        self.sizes: dict[str, list[float]] = {}
        self.seen_at: float | None = None

    def _note(self, name: str, value: float) -> None:
        self.sizes.setdefault(name, []).append(value)

    def add(self, at_s: float, values: dict[str, int]) -> None:
        """What came by a time."""
        fade = 1.0 if self.seen_at is None else math.exp(-max(at_s - self.seen_at, 0) / self.fade_s)
        self.seen_at = at_s
        self.rates = {k: v * fade for k, v in self.rates.items()}
        for name, n in values.items():
            if name.endswith("-total"):
                self.totals[name] = self.totals.get(name, 0) + int(n or 0)
                rate = name.removesuffix("-total") + "-rate"
                self.rates[rate] = self.rates.get(rate, 0.0) + (n or 0) / self.fade_s

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp()
        values = {k: v for row in p.observedMetrics.values() for k, v in row.asDict().items()}
        self.add(at, values)
        self._note("batch-size", p.numInputRows)
        for name, part in (("commit-latency", "commitOffsets"), ("batch-latency", "triggerExecution")):
            if p.durationMs and part in p.durationMs:
                self._note(name, p.durationMs[part])

    def onQueryTerminated(self, event):
        pass

    def values(self) -> dict[str, float]:
        """All of them by name; totals are whole numbers."""
        sizes = {f"{k}-{what}": f(v) for k, v in self.sizes.items() for what, f in (("avg", lambda x: sum(x) / len(x)), ("max", max))}
        return {**self.totals, **self.rates, **sizes}


class ProgressLog(StreamingQueryListener):
    """Keeps the duration and rows of each batch of running queries, with the longest so far."""

    def __init__(self):
        self.rows: list[dict] = []
        self.longest_ms = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        took = p.durationMs.get("triggerExecution", 0) if p.durationMs else 0
        self.longest_ms = max(self.longest_ms, took)
        self.rows.append({"batch": p.batchId, "rows": p.numInputRows, "ms": took, "longest_ms": self.longest_ms})

    def onQueryTerminated(self, event):
        pass
