"""Control messages as a stream: each reader's subscription as state by (consumer, topic, partition).

A message sets or removes single topics and partitions, so the state of each is its
last action: a streaming aggregate with partial sums before its shuffle, which spreads a
reader with very many messages over all tasks and needs no Python. Which family of
messages a reader takes is a second such aggregate, by its first valid ADD. What a reader has
in its mode is the join of the two: what the other family set doesn't count, and a REMOVE
before the first ADD removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import control


def _family(kind: str = "kind"):
    return F.when(F.col(kind).endswith("ASSIGNMENT"), "ASSIGNED").when(F.col(kind).endswith("SUBSCRIPTION"), "SUBSCRIBED")


def elements(messages: DataFrame) -> DataFrame:
    """messages (consumer, seq, json) as (consumer, family, topic, partition, last): for each topic or partition its last action (seq, i, add, offset). Works on tables and streams; a stream is in update mode."""
    parsed = control.parse(messages)  # without a filter, which would parse each text once more for every condition; errors and NONE have no elements
    # A topic is like a partition without a number and an offset.
    topics = F.transform("topics", lambda t: F.struct(t.alias("topic"), F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset")))
    each = parsed.select("consumer", "seq", _family().alias("family"), F.col("kind").startswith("ADD_").alias("add"), F.posexplode(F.coalesce("partitions", topics)).alias("i", "p"))
    last = F.max_by(F.struct("seq", "i", "add", F.col("p.offset").alias("offset")), F.struct("seq", "i"))
    return each.groupBy("consumer", "family", F.col("p.topic").alias("topic"), F.col("p.partition").alias("partition")).agg(last.alias("last"))


def modes(messages: DataFrame, region: bool = False) -> DataFrame:
    """(consumer, mode, since): the family of each reader's first ADD that it may take."""
    opens = F.col("kind").like("ADD_ASSIGNMENT" if region else "ADD%")
    adds = control.parse(messages).select("consumer", F.when(opens, F.struct("seq", _family().alias("family"))).alias("add"))
    return adds.groupBy("consumer").agg(F.min_by("add.family", "add.seq").alias("mode"), F.min("add.seq").alias("since")).where("since is not null")


def current(elements: DataFrame, modes: DataFrame) -> DataFrame:
    """(consumer, mode, topic, partition, offset) that readers have; from tables of ``elements`` and ``modes`` with any number of updates of a row."""
    keys = ["consumer", "family", "topic", "partition"]
    last = elements.groupBy(*keys).agg(F.max_by("last", F.struct("last.seq", "last.i")).alias("last")).where("last.add")
    mode = modes.groupBy("consumer").agg(F.min_by("mode", "since").alias("mode"))
    return last.join(mode, "consumer").where("family = mode").select("consumer", "mode", "topic", "partition", "last.offset")


def follow(messages: DataFrame, home: str, region: bool = False) -> list:
    """Start to keep ``elements`` and ``modes`` of a stream as tables under ``home``; a batch that runs again replaces its updates."""
    started = []
    for name, df in (("elements", elements(messages)), ("modes", modes(messages, region))):
        write = lambda b, i, name=name: b.write.mode("overwrite").parquet(f"{home}/{name}/batch={i}")
        started.append(df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{home}/checkpoint-{name}").start())
    return started


def followed(spark, home: str) -> DataFrame:
    """``current`` of what ``follow`` has kept so far."""
    return current(*[spark.read.parquet(f"{home}/{name}").drop("batch") for name in ("elements", "modes")])
