"""Builders of JSON control messages, as columns and as plain text.

Every builder takes columns (or literals) and gives one JSON string column;
values are escaped. ``text`` gives the same message for plain Python values.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def _topics(action: str, topics: Column) -> Column:
    return F.to_json(F.struct(F.lit(action).alias("action"), F.transform(topics, lambda t: F.struct(t.alias("topic"))).alias("topics")))


def _partitions(action: str, parts: Column) -> Column:
    return F.to_json(F.struct(F.lit(action).alias("action"), parts.alias("topicPartitionOffsets")))


def _one(topic: Column, partition: Column, offset: Column | None = None) -> Column:
    fields = [topic.alias("topic"), partition.cast("int").alias("partition")]
    return F.array(F.struct(*fields, *([offset.cast("long").alias("offset")] if offset is not None else [])))


def add_topics(topics: Column) -> Column:
    """topics: an array of names."""
    return _topics("ADD", topics)


def add_topic(topic: Column) -> Column:
    return _topics("ADD", F.array(topic))


def remove_topics(topics: Column) -> Column:
    return _topics("REMOVE", topics)


def remove_topic(topic: Column) -> Column:
    return _topics("REMOVE", F.array(topic))


def add_partitions(parts: Column) -> Column:
    """parts: an array of structs (topic, partition) or (topic, partition, offset); without offset the position is the default."""
    return _partitions("ADD", parts)


def remove_partitions(parts: Column) -> Column:
    return _partitions("REMOVE", F.transform(parts, lambda p: F.struct(p["topic"].alias("topic"), p["partition"].alias("partition"))))


def add_partition(topic: Column, partition: Column, offset: Column | None = None) -> Column:
    return _partitions("ADD", _one(topic, partition, offset))


def remove_partition(topic: Column, partition: Column) -> Column:
    return _partitions("REMOVE", _one(topic, partition))


def text(action: str, topics: list[str] | None = None, partitions: list[tuple] | None = None) -> str:
    """partitions: (topic, partition) or (topic, partition, offset)."""
    if (topics is None) == (partitions is None):
        raise ValueError("give topics or partitions")
    if topics is not None:
        return json.dumps({"action": action, "topics": [{"topic": t} for t in topics]})
    return json.dumps({"action": action, "topicPartitionOffsets": [dict(zip(("topic", "partition", "offset"), p, strict=False)) for p in partitions]})
