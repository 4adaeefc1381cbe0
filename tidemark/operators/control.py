"""Dynamic subscription: control messages parsed, checked against the reader's mode, and folded into its state.

A reader (column ``consumer``) is in no mode until its first valid ADD, which
makes it either subscribed (topics) or assigned (topic partitions); messages
of the other family and REMOVEs before that are rejected. As every accepted message
sets or removes single topics or partitions, the state is the last action for
each: an aggregate by key, not a fold over all messages of a reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import offsets
from tidemark.plans.spec import NO_SEEK

MESSAGE = "action string, topics array<struct<topic:string>>, topicPartitionOffsets array<struct<topic:string,`partition`:string,`offset`:string>>"


def parse(messages: DataFrame) -> DataFrame:
    """messages (consumer, seq, json) with ``kind`` (ADD_ASSIGNMENT, REMOVE_ASSIGNMENT, ADD_SUBSCRIPTION, REMOVE_SUBSCRIPTION, NONE), ``error``, ``topics`` and ``partitions``.

    Malformed text, an unknown action, both families at once, or an element without topic or partition is an error.
    A missing offset means the default position; of repeated partitions the last counts.
    """
    j = F.from_json("json", MESSAGE)
    m = messages.withColumn("m", j).withColumn("whole", F.try_parse_json("json").isNotNull())
    action = F.upper(F.col("m.action"))
    tps, topics = F.col("m.topicPartitionOffsets"), F.col("m.topics")
    number = lambda x, kind: x.try_cast(kind)
    bad_tp = F.exists(tps, lambda e: e["topic"].isNull() | number(e["partition"], "int").isNull() | (e["offset"].isNotNull() & number(e["offset"], "bigint").isNull()))
    bad_topic = F.exists(topics, lambda e: e["topic"].isNull())
    error = (
        F.when(~F.col("whole") | F.col("m").isNull(), "malformed")
        .when(action.isNull(), "missing action")
        .when(~action.isin("ADD", "REMOVE"), "unknown action")
        .when(tps.isNotNull() & topics.isNotNull(), "both families")
        .when(F.coalesce(bad_tp, F.lit(False)) | F.coalesce(bad_topic, F.lit(False)), "bad element")
    )
    parsed = F.transform(tps, lambda e: F.struct(e["topic"].alias("topic"), number(e["partition"], "int").alias("partition"), F.coalesce(number(e["offset"], "bigint"), F.lit(NO_SEEK).cast("long")).alias("offset")))
    kind = F.when(tps.isNotNull(), F.concat(action, F.lit("_ASSIGNMENT"))).when(topics.isNotNull(), F.concat(action, F.lit("_SUBSCRIPTION"))).otherwise("NONE")
    return m.withColumn("error", error).select(
        "consumer", "seq", F.when(F.col("error").isNull(), kind).alias("kind"), "error",
        F.when(F.col("error").isNull(), F.array_distinct(F.transform(topics, lambda e: e["topic"]))).alias("topics"),
        F.when(F.col("error").isNull(), parsed).alias("partitions"),
    )


def accept(parsed: DataFrame, region: bool = False) -> DataFrame:
    """parsed messages with ``mode`` (the reader's, after its first ADD) and ``accepted``. Topics can't be subscribed in a consistent region."""
    family = F.when(F.col("kind").endswith("ASSIGNMENT"), "ASSIGNED").when(F.col("kind").endswith("SUBSCRIPTION"), "SUBSCRIBED")
    opens = F.when(F.col("kind").startswith("ADD_") & ~(F.lit(region) & F.col("kind").endswith("SUBSCRIPTION")), family)
    so_far = Window.partitionBy("consumer").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return parsed.withColumn("mode", F.first(opens, ignorenulls=True).over(so_far)).withColumn("accepted", F.coalesce(family == F.col("mode"), F.lit(False)))


def assignments(accepted: DataFrame) -> DataFrame:
    """(consumer, topic, partition, offset): the partitions that are assigned after all messages, with the last requested offset."""
    each = accepted.where("accepted and mode = 'ASSIGNED'").select("consumer", "seq", F.col("kind").startswith("ADD_").alias("add"), F.posexplode("partitions").alias("i", "p"))
    last = each.groupBy("consumer", F.col("p.topic").alias("topic"), F.col("p.partition").alias("partition")).agg(F.max_by(F.struct("add", F.col("p.offset").alias("offset")), F.struct("seq", "i")).alias("last"))
    return last.where("last.add").select("consumer", "topic", "partition", "last.offset")


def subscriptions(accepted: DataFrame) -> DataFrame:
    """(consumer, topic): the topics that are subscribed after all messages."""
    each = accepted.where("accepted and mode = 'SUBSCRIBED'").select("consumer", "seq", F.col("kind").startswith("ADD_").alias("add"), F.explode("topics").alias("topic"))
    return each.groupBy("consumer", "topic").agg(F.max_by("add", "seq").alias("add")).where("add").drop("add")


def failed(accepted: DataFrame) -> DataFrame:
    """(consumer, n_failed): messages that were errors, of no kind, or not allowed in the reader's mode."""
    return accepted.groupBy("consumer").agg(F.count_if(~F.col("accepted")).alias("n_failed"))


def commits(accepted: DataFrame, delivered: DataFrame, positions: DataFrame) -> DataFrame:
    """(consumer, seq, topic, partition, action, offset): what a reader commits when a message adds or removes partitions.

    An added partition is committed at once, at the position that its offset or sentinel stands for; a removed one with
    what was delivered of it since it was added, if it was assigned and anything came.
    delivered: (consumer, at, topic, partition, offset), the next offset after what was delivered up to ``at``, in the
    order of ``seq`` and before a message of the same number; a row for each batch and partition.
    positions: (topic, partition, log_begin, log_end, position), the position without a seek.
    """
    key = ["consumer", "topic", "partition"]
    each = accepted.where("accepted and mode = 'ASSIGNED'").select("consumer", "seq", F.col("kind").startswith("ADD_").alias("add"), F.posexplode("partitions").alias("i", "p"))
    # Of a partition that a message names twice the last counts.
    actions = each.groupBy("consumer", "seq", F.col("p.topic").alias("topic"), F.col("p.partition").alias("partition"), "add").agg(F.max_by("p.offset", "i").alias("requested"))
    none = lambda kind: F.lit(None).cast(kind)
    events = actions.select(*key, "seq", F.lit(1).alias("turn"), "add", "requested", none("long").alias("next")).unionByName(
        delivered.select(*key, F.col("at").alias("seq"), F.lit(0).alias("turn"), none("boolean").alias("add"), none("long").alias("requested"), F.col("offset").alias("next"))
    )
    # A removal ends a span of messages about a partition; what comes before the first addition of a span isn't the reader's.
    before = Window.partitionBy(*key).orderBy("seq", "turn").rowsBetween(Window.unboundedPreceding, -1)
    spans = events.withColumn("span", F.coalesce(F.count_if(~F.col("add")).over(before), F.lit(0)))
    so_far = Window.partitionBy(*key, "span").orderBy("seq", "turn").rowsBetween(Window.unboundedPreceding, -1)
    known = spans.withColumn("assigned", F.coalesce(F.max(F.coalesce("add", F.lit(False))).over(so_far), F.lit(False)))
    known = known.withColumn("reached", F.last(F.when(F.col("assigned"), F.col("next")), ignorenulls=True).over(so_far))
    added = known.where("add").join(positions, ["topic", "partition"], "left").select(*key, "seq", F.lit("ADD").alias("action"), offsets.seek(F.col("requested"), F.col("position")).alias("offset"))
    removed = known.where("not add and assigned and reached is not null").select(*key, "seq", F.lit("REMOVE").alias("action"), F.col("reached").alias("offset"))
    return added.unionByName(removed).select("consumer", "seq", "topic", "partition", "action", "offset")
