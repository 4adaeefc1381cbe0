"""The log relation: a table of records with topic, partition and offset.

Offsets are physical columns. ``from_table`` numbers the rows of any table
once; ``write`` stores them as Parquet partitioned by topic and partition, so
that subscriptions prune files and offset and time limits reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.spec import ConsumerSpec, listed

SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("timestamp_ms", T.LongType()),
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("txn_id", T.StringType()), T.StructField("txn_state", T.StringType()),
])


class UnknownTopic(LookupError):
    """A topic that is read by partition isn't in the log."""


def from_table(df: DataFrame, *, topic: Column, partition: Column, order_by: Column, timestamp_ms: Column, key: Column, value: Column, bucket: Column | None = None, txn_id: Column | None = None, txn_state: Column | None = None) -> DataFrame:
    """The rows of ``df`` as a log: offsets count from 0 in the order of ``order_by`` within a topic and partition.

    bucket: a column that never falls as ``order_by`` rises. Rows are then numbered within buckets and the buckets'
    counts added up, so a hot partition is numbered by many tasks instead of one.
    """
    null = F.lit(None).cast("string")
    rows = df.select(
        topic.alias("topic"), partition.cast("int").alias("partition"), timestamp_ms.cast("long").alias("timestamp_ms"), key.alias("key"), value.alias("value"),
        (null if txn_id is None else txn_id).alias("txn_id"), (null if txn_state is None else txn_state).alias("txn_state"),
        order_by.alias("__order"), (F.lit(0) if bucket is None else bucket).alias("__bucket"),
    )
    place = F.row_number().over(Window.partitionBy("topic", "partition", "__bucket").orderBy("__order")) - 1
    if bucket is None:
        numbered = rows.withColumn("offset", place.cast("long"))
    else:
        counts = rows.groupBy("topic", "partition", "__bucket").agg(F.count("*").alias("n"))
        before = Window.partitionBy("topic", "partition").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        first = counts.select("topic", "partition", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
        numbered = rows.withColumn("place", place).join(first, ["topic", "partition", "__bucket"]).withColumn("offset", (F.col("first") + F.col("place")).cast("long"))
    return numbered.select(*SCHEMA.names)


def write(log: DataFrame, path: str, mode: str = "append") -> None:
    log.write.mode(mode).partitionBy("topic", "partition").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).select(*SCHEMA.names)


def extents(log: DataFrame) -> DataFrame:
    """(topic, partition, log_begin, log_end): the first offset and the one after the last."""
    return log.groupBy("topic", "partition").agg(F.min("offset").alias("log_begin"), (F.max("offset") + 1).alias("log_end"))


def subscribed(log: DataFrame, spec: ConsumerSpec) -> DataFrame:
    """The records of the topics, the pattern or the partitions of a description; the filter reaches the scan."""
    if spec.pattern is not None:
        return log.where(F.col("topic").rlike(f"^(?:{spec.pattern})$"))
    out = log.where(F.col("topic").isin(listed(spec.topics)))
    return out.where(F.col("partition").isin(spec.partitions)) if spec.partitions else out


def assigned(log: DataFrame, spec: ConsumerSpec) -> DataFrame:
    """(topic, partition) of a static reader: topics x given partitions, else all partitions that the topics have."""
    spark = log.sparkSession
    if spec.partitions:
        return spark.createDataFrame([(t, p) for t in spec.topics for p in spec.partitions], "topic string, partition int")
    found = subscribed(log, spec).select("topic", "partition").distinct()
    missing = set(spec.topics) - {r.topic for r in found.select("topic").distinct().collect()}  # at most the given topics
    if missing:
        raise UnknownTopic(", ".join(sorted(missing)))
    return found


def visible(log: DataFrame, isolation: str = "read_committed") -> DataFrame:
    """Records that a reader may see: with read_committed none of open or aborted transactions."""
    if isolation == "read_uncommitted":
        return log
    return log.where(F.col("txn_state").isNull() | (F.col("txn_state") == "committed"))
