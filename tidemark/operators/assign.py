"""What a group's readers would each read: the log grouped by a rule that gives a topic partition its reader.

The rules are expressions, so they cost one aggregate over the log, whatever the numbers of partitions and readers.
Rules by a partition's place among the others are windows over that aggregate, which has a row for each topic partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sink import hashed


def by_hash(members: int, topic: str = "topic", partition: str = "partition") -> Column:
    """The reader of a partition by its name's hash: topics spread over all readers."""
    return hashed(F.concat(F.col(topic), F.lit("-"), F.col(partition).cast("string")), F.lit(members))


def by_range(members: int, n_partitions: int, partition: str = "partition") -> Column:
    """The reader of a partition by its number: each topic is cut into as many runs as there are readers."""
    return F.floor(F.col(partition) * members / n_partitions).cast("int")


def load(log: DataFrame, member: Column) -> DataFrame:
    """(member, n_partitions, n_records, first_ms, last_ms) of every reader that has anything to read."""
    each = log.groupBy("topic", "partition").agg(F.count("*").alias("n"), F.min("timestamp_ms").alias("a"), F.max("timestamp_ms").alias("z"))
    return each.groupBy(member.alias("member")).agg(F.count("*").alias("n_partitions"), F.sum("n").alias("n_records"), F.min("a").alias("first_ms"), F.max("z").alias("last_ms"))


def moved(log: DataFrame, before: Column, after: Column) -> DataFrame:
    """(before, after, n_partitions, n_records): what goes from reader to reader when the rule changes."""
    each = log.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    return each.groupBy(before.alias("before"), after.alias("after")).agg(F.count("*").alias("n_partitions"), F.sum("n").alias("n_records"))


def placed(log: DataFrame) -> DataFrame:
    """(topic, partition, n_records, first_ms, last_ms, k, i, total): each partition with its place among all, among its topic's, and their number."""
    each = log.groupBy("topic", "partition").agg(F.count("*").alias("n_records"), F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms"))
    every, topic = Window.orderBy("topic", "partition"), Window.partitionBy("topic")
    return each.select("*", (F.row_number().over(every) - 1).alias("k"), (F.row_number().over(topic.orderBy("partition")) - 1).alias("i"), F.count("*").over(topic).alias("total"))


def in_turn(members: int) -> Column:
    """The reader of a placed partition: all partitions in order, dealt in turn."""
    return _named(F.col("k") % members)


def in_runs(members: int) -> Column:
    """The reader of a placed partition: each topic in runs; the first readers get one more where partitions don't divide."""
    i, each, more = F.col("i"), F.floor(F.col("total") / members), F.col("total") % members
    cut = more * (each + 1)
    return _named(F.when(i < cut, F.floor(i / (each + 1))).otherwise(more + F.floor((i - cut) / F.greatest(each, F.lit(1)))))


def _named(number: Column) -> Column:
    return F.concat(F.lit("m"), number.cast("string"))


def assignment(log: DataFrame, member: Column) -> DataFrame:
    """(member, topic, partition, n_records, first_ms, last_ms): who reads each partition, and what that is."""
    return placed(log).select(member.alias("member"), "topic", "partition", "n_records", "first_ms", "last_ms")


def with_loads(dealt: DataFrame) -> DataFrame:
    """An assignment with what its reader has to read in all: n_partitions, reader_records, reader_first_ms, reader_last_ms, the same in each of the reader's rows."""
    reader = Window.partitionBy("member")
    return dealt.select(
        "*", F.count("*").over(reader).alias("n_partitions"), F.sum("n_records").over(reader).alias("reader_records"),
        F.min("first_ms").over(reader).alias("reader_first_ms"), F.max("last_ms").over(reader).alias("reader_last_ms"),
    )


def changes(log: DataFrame, before: Column, after: Column) -> DataFrame:
    """(member, topic, partition, change, n_records): what each reader keeps, gives up (revoked) and gets (assigned)."""
    row = lambda member, change: F.struct(member.alias("member"), F.lit(change).alias("change"))
    both = F.when(before == after, F.array(row(before, "kept"))).otherwise(F.array(row(before, "revoked"), row(after, "assigned")))
    return placed(log).select("topic", "partition", "n_records", F.explode(both).alias("c")).select("c.member", "topic", "partition", "c.change", "n_records")
