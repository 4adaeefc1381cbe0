"""Reading a log by a description: positions, visibility, decoding and column binding in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import serde
from tidemark.operators import offsets
from tidemark.plans.spec import ConsumerSpec
from tidemark.sources import log as logs


def decoded(records: DataFrame, spec: ConsumerSpec) -> DataFrame:
    """The log's columns with typed ``message`` and ``decoded_key``; null messages are kept."""
    key = serde.decode(F.col("key"), spec.key_type)
    return records.withColumn("message", serde.decode(F.col("value"), spec.message_type)).withColumn("decoded_key", serde.or_default(key, spec.key_type) if spec.null_key_as_default else key)


def project(records: DataFrame, spec: ConsumerSpec, columns: list[str] | None = None, named: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """The output columns of a description; ``columns`` is the wanted output, all of them without it. keep: further columns of the records."""
    roles = {"message": "message", "key": "decoded_key", "topic": "topic", "timestamp_ms": "timestamp_ms", "offset": "offset", "partition": "partition"}
    wanted = columns if columns is not None else [spec.message_column, spec.key_column, spec.topic_column, spec.timestamp_column, spec.offset_column, spec.partition_column]
    bound = spec.bind(wanted, named)
    return records.where(F.col("message").isNotNull()).select(*[F.col(roles[role]).alias(name) for role, name in bound.items()], *(keep or []))


def read(log: DataFrame, spec: ConsumerSpec, committed: DataFrame | None = None, committed_once: DataFrame | None = None, columns: list[str] | None = None, named: dict[str, str] | None = None) -> DataFrame:
    """The rows that a reader delivers. Records with a null or malformed message are dropped; they count as read."""
    positions = offsets.start_positions(log, spec, committed, committed_once)
    records = offsets.from_positions(logs.visible(logs.subscribed(log, spec), spec.isolation), positions)
    return project(decoded(records, spec), spec, columns, named)


def drop_counts(records: DataFrame, spec: ConsumerSpec) -> DataFrame:
    """(topic, n_read, n_delivered, n_dropped, n_tombstones, next_offset): dropped records still advance the offset."""
    message = F.col("message")
    return decoded(records, spec).groupBy("topic").agg(
        F.count("*").alias("n_read"), F.count(message).alias("n_delivered"),
        F.count_if(message.isNull() & F.col("value").isNotNull()).alias("n_dropped"), F.count_if(F.col("value").isNull()).alias("n_tombstones"),
        (F.max("offset") + 1).alias("next_offset"),
    )
