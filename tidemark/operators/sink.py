"""Writing to a log: routing, fan-out, encoding, transactions and per-row status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import serde
from tidemark.plans.spec import SinkSpec

Partitioner = Callable[[Column, Column, Column], Column]

_KIND = {T.StringType: "string", T.IntegerType: "int32", T.LongType: "int64", T.FloatType: "float32", T.DoubleType: "float64", T.BinaryType: "blob", T.DecimalType: "uint64"}


def by_integer_key(key: Column, value: Column, n: Column) -> Column:
    """The key is the partition."""
    return key.cast("int")


def by_hash(key: Column, value: Column, n: Column) -> Column:
    """Keyed rows by the hash of the key; rows without a key are spread by their value. It is one that other engines have, too, so they find a key's partition."""
    return hashed(F.coalesce(key.cast("string"), value.cast("string")), n)


def hashed(text: Column, n: Column) -> Column:
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % n.cast("long")).cast("int")


def partitions_of(topic: Column, n_partitions: int | DataFrame) -> Column:
    """How many partitions a topic has; null of an unknown one. A table (topic, n_partitions), a row for each topic, becomes part of the plan."""
    if isinstance(n_partitions, int):
        return F.lit(n_partitions)
    known = [x for r in n_partitions.select("topic", "n_partitions").collect() for x in (F.lit(r.topic), F.lit(r.n_partitions).cast("int"))]
    return F.try_element_at(F.create_map(*known), topic) if known else F.lit(None).cast("int")


def _routes(df: DataFrame, spec: SinkSpec, n_partitions: int | DataFrame, partitioner: Partitioner) -> Column:
    """The records of a row, one for each of its topics, with ``failure`` and ``reason`` where one can't be written."""
    bound = spec.bind(df.schema)
    kind = lambda role: _KIND[type(df.schema[bound[role]].dataType)]
    role = lambda name, default: F.col(bound[name]) if name in bound else F.lit(None).cast(default)
    time, k, v = role("timestamp_ms", "long"), role("key", "string"), F.col(bound["message"])
    key = serde.encode(k, kind("key")) if "key" in bound else F.lit(None).cast("binary")

    def record(topic: Column) -> Column:
        n = partitions_of(topic, n_partitions)
        # A row without key and value is spread by its time: a replay finds the same partition, which taking turns wouldn't.
        place = F.coalesce(role("partition", "int"), partitioner(k, v, n), hashed(F.coalesce(time.cast("string"), F.lit("")), n))
        failure = (
            F.when(topic.isNull() | (topic == ""), F.struct(F.lit("InvalidTopicException").alias("f"), F.lit("the row names no topic").alias("r")))
            .when(n.isNull(), F.struct(F.lit("UnknownTopicOrPartitionException").alias("f"), F.lit("the topic isn't known").alias("r")))
            .when(place.isNull() | (place < 0), F.struct(F.lit("IllegalArgumentException").alias("f"), F.concat(F.lit("there is no partition "), F.coalesce(place.cast("string"), F.lit("null"))).alias("r")))
            .when(place >= n, F.struct(F.lit("UnknownTopicOrPartitionException").alias("f"), F.concat(F.lit("there is no partition "), place.cast("string")).alias("r")))
        )
        return F.struct(topic.alias("topic"), place.alias("partition"), time.alias("timestamp_ms"), key.alias("key"), serde.encode(v, kind("message")).alias("value"), failure["f"].alias("failure"), failure["r"].alias("reason"))

    return F.array(*[record(F.lit(t)) for t in spec.topics]) if spec.topics else F.array(record(F.col(bound["topic"])))


def verdicts(df: DataFrame, spec: SinkSpec, n_partitions: int | DataFrame = 1, partitioner: Partitioner = by_hash, keep: list[str] | None = None) -> DataFrame:
    """(topic, partition, timestamp_ms, key, value, failure, reason) of every row and topic: ``failure`` is null where the record is written, so none gets lost.

    keep: columns of the rows that stay, in front.
    """
    return df.select(*(keep or []), F.explode(_routes(df, spec, n_partitions, partitioner)).alias("__record")).select(*(keep or []), "__record.*")


def routed(df: DataFrame, spec: SinkSpec, n_partitions: int | DataFrame = 1, partitioner: Partitioner = by_hash) -> DataFrame:
    """(row, records): each row as a struct, with its records as an array, as the data source writes them."""
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), _routes(df, spec, n_partitions, partitioner).alias("records"))


def produce(df: DataFrame, spec: SinkSpec, n_partitions: int | DataFrame = 1, partitioner: Partitioner = by_hash) -> DataFrame:
    """(topic, partition, timestamp_ms, key, value) of the records to write; each row gives one for each of its topics.

    Topics of the description come before a column of topics. A row's own partition comes before the partitioner.
    n_partitions: the same for all topics, or a table (topic, n_partitions). What can't be written is in ``verdicts``.
    """
    return verdicts(df, spec, n_partitions, partitioner).where("failure is null").drop("failure", "reason")


def classify(errors: DataFrame) -> DataFrame:
    """errors (in_region, has_status, retriable) with ``category`` RECOVER or FINAL: in a region without a status stream everything is recovered, else only what can be retried."""
    return errors.withColumn("category", F.when(F.col("in_region") & ~F.col("has_status"), "RECOVER").when(F.col("retriable"), "RECOVER").otherwise("FINAL"))


def attempts(failures: DataFrame, max_generations: int = 3) -> DataFrame:
    """failures (row, n_failed, category) with ``outcome``: written again until ``max_generations`` attempts have failed."""
    return failures.withColumn("outcome", F.when((F.col("category") == "FINAL") | (F.col("n_failed") >= max_generations), "failed").otherwise("retried"))


def failure_json(failed_topics: Column, exception: Column, message: Column) -> Column:
    """The description of a failed row."""
    return F.to_json(F.struct(
        F.coalesce(failed_topics, F.array().cast("array<string>")).alias("failedTopics"), F.coalesce(exception, F.lit("")).alias("lastExceptionType"), F.coalesce(message, F.lit("")).alias("lastFailure"),
    ))


def status(rows: DataFrame, failures: DataFrame, on: list[str], errors_only: bool = True, optional_text: bool = True, row_name: str = "inTuple", text_name: str = "failureDescription") -> DataFrame:
    """One status row for each input row, or only for failed ones: the input as a struct and the description of its failure.

    failures: (on..., topic, exception, message, seq), a row for each failed record; a row's topics are gathered and its last failure told.
    Without a failure the text is null, or empty where the stream's column isn't optional.
    """
    told = failures.groupBy(*on).agg(F.sort_array(F.collect_set("topic")).alias("topics"), F.max_by(F.struct("exception", "message"), "seq").alias("last"))
    told = told.select(*on, failure_json(F.col("topics"), F.col("last.exception"), F.col("last.message")).alias("__text"))
    joined = rows.join(told, on, "inner" if errors_only else "left")
    text = F.col("__text") if optional_text else F.coalesce("__text", F.lit(""))
    return joined.select(F.struct(*[F.col(c) for c in rows.columns]).alias(row_name), text.alias(text_name))
