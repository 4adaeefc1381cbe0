"""Offset algebra: where reading starts, what is committed, what is read again.

Relations of offsets have a row for each topic partition; they are small beside the log,
and Spark chooses the join by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.spec import BEGINNING, END, NO_SEEK, ConsumerSpec, StartPosition
from tidemark.sources import log as logs

TP = ["topic", "partition"]


def reset_position(reset: str) -> Column:
    return F.col("log_begin") if reset in ("earliest", "smallest") else F.col("log_end")


def default_positions(extents: DataFrame, committed: DataFrame | None, reset: str = "latest") -> DataFrame:
    """(topic, partition, log_begin, log_end, position): the committed offset, else the reset position."""
    if committed is None:
        return extents.withColumn("position", reset_position(reset))
    known = committed.groupBy(*TP).agg(F.max("offset").alias("committed"))
    return extents.join(known, TP, "left").select(*TP, "log_begin", "log_end", F.coalesce("committed", reset_position(reset)).alias("position"))


def seek(requested: Column, default: Column) -> Column:
    """An offset or one of the sentinels -1 (end), -2 (beginning), -3 (no seek) as a position."""
    return F.when(requested == END, F.col("log_end")).when(requested == BEGINNING, F.col("log_begin")).when(requested == NO_SEEK, default).otherwise(F.coalesce(requested, default))


def seek_all(extents: DataFrame, requests: DataFrame, committed: DataFrame | None = None, reset: str = "latest") -> DataFrame:
    """Positions of the requested (topic, partition, offset); the offset may be a sentinel."""
    return requests.withColumnRenamed("offset", "requested").join(default_positions(extents, committed, reset), TP).select(*TP, seek(F.col("requested"), F.col("position")).alias("position"))


def start_positions(log: DataFrame, spec: ConsumerSpec, committed: DataFrame | None = None, committed_once: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """(topic, partition, position) for every partition that a description reads.

    ends: (topic, partition, log_end) at the time of starting, for logs that have grown since.
    committed_once: partitions for which this job has committed before; they go on from there whatever the start position.
    """
    mine = logs.subscribed(log, spec)
    extents = logs.extents(mine)
    if ends is not None:
        extents = extents.drop("log_end").join(ends, TP)
    base = default_positions(extents, committed, spec.auto_offset_reset)
    kind = spec.position
    if kind is StartPosition.DEFAULT:
        return base.select(*TP, "position")
    if kind is StartPosition.BEGINNING:
        start = base.withColumn("start", F.col("log_begin"))
    elif kind is StartPosition.END:
        start = base.withColumn("start", F.col("log_end"))
    elif kind is StartPosition.TIME:
        # The earliest record at or after the time; a partition without one isn't moved.
        first = mine.where(F.col("timestamp_ms") >= spec.start_time).groupBy(*TP).agg(F.min("offset").alias("found"))
        start = base.join(first, TP, "left").withColumn("start", F.coalesce("found", "position"))
    else:
        at = log.sparkSession.createDataFrame([(spec.topics[0], p, o) for p, o in zip(spec.partitions, spec.start_offsets, strict=True)], "topic string, partition int, requested long")
        start = base.join(at, TP).withColumn("start", seek(F.col("requested"), F.col("position")))
    if committed_once is None:
        return start.select(*TP, F.col("start").alias("position"))
    seen = committed_once.select(*TP).distinct().withColumn("seen", F.lit(True))
    return start.join(seen, TP, "left").select(*TP, F.when(F.col("seen"), F.col("position")).otherwise(F.col("start")).alias("position"))


def from_positions(log: DataFrame, positions: DataFrame) -> DataFrame:
    """The records at and after each partition's position; others are not read."""
    return log.join(positions, TP).where("offset >= position").drop("position")


def next_offsets(records: DataFrame) -> DataFrame:
    """(topic, partition, offset): what is committed after these records."""
    return records.groupBy(*TP).agg((F.max("offset") + 1).alias("offset"))


ARRIVAL = ["timestamp_ms", *TP, "offset"]


def _buckets(records: DataFrame, bucket_ms: int) -> tuple[DataFrame, DataFrame]:
    """Records with ``bucket``, their span of time, and (bucket, n, before, total).

    The window over the buckets has one group; it holds one row for each span that occurs, however many records there are.
    """
    rows = records.withColumn("bucket", F.floor(F.coalesce("timestamp_ms", F.lit(0)) / bucket_ms))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    every = Window.orderBy("bucket")
    before = F.coalesce(F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows, counts.select("bucket", "n", before.alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))


def arrival_numbers(records: DataFrame, bucket_ms: int = 60_000) -> DataFrame:
    """The records of one reader with ``arrival``: 0, 1, 2, ... by time, topic, partition and offset, numbered within spans of time."""
    rows, buckets = _buckets(records, bucket_ms)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*ARRIVAL)) - 1
    return rows.withColumn("place", place).join(buckets.select("bucket", "before"), "bucket").withColumn("arrival", F.col("before") + F.col("place")).drop("bucket", "place", "before")


def commits_by_count(records: DataFrame, n: int, bucket_ms: int = 60_000) -> DataFrame:
    """(topic, partition, offset) that one reader has committed when every n of its records, over all its partitions and in order of arrival, make a commit.

    Only the span of time that the last commit falls in is put in order; spans before it count whole.
    """
    rows, buckets = _buckets(records.select(*ARRIVAL), bucket_ms)
    take = F.greatest(F.lit(0), F.least("n", F.col("total") - F.col("total") % int(n) - F.col("before")))
    taken = rows.join(buckets.select("bucket", "n", take.alias("take")), "bucket").where("take > 0")
    last = taken.where("take < n").withColumn("k", F.row_number().over(Window.partitionBy("bucket").orderBy(*ARRIVAL))).where("k <= take")
    return next_offsets(taken.where("take = n").select(*TP, "offset").union(last.select(*TP, "offset")))


def commits_by_time(records: DataFrame, period_ms: int, at: Column | None = None) -> DataFrame:
    """(topic, partition, commit_ms, offset): for every period with records, what is committed at its end. at: the time of processing, in ms."""
    end = (F.floor((F.col("timestamp_ms") if at is None else at) / period_ms) + 1) * period_ms
    per = records.groupBy(*TP, end.cast("long").alias("commit_ms")).agg((F.max("offset") + 1).alias("o"))
    so_far = Window.partitionBy(*TP).orderBy("commit_ms").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(*TP, "commit_ms", F.max("o").over(so_far).alias("offset"))


def accept_commits(commits: DataFrame, assignment: DataFrame) -> DataFrame:
    """Only partitions that are assigned just now are committed."""
    return commits.join(assignment.select(*TP).distinct(), TP, "left_semi")


def merge_commits(store: DataFrame, commits: DataFrame) -> DataFrame:
    """The store (group_id, topic, partition, offset) after newer commits; a later commit replaces an earlier one, also by a smaller offset."""
    keys = ["group_id", *TP]
    return store.join(commits, keys, "left_anti").unionByName(commits.select(*store.columns))


def lag(extents: DataFrame, committed: DataFrame) -> DataFrame:
    """(topic, partition, log_end, committed, lag); without a commit the whole partition is behind."""
    known = committed.groupBy(*TP).agg(F.max("offset").alias("committed"))
    return extents.join(known, TP, "left").select(*TP, "log_end", "committed", (F.col("log_end") - F.coalesce("committed", "log_begin")).alias("lag"))


def mark_committed_once(store: DataFrame, commits: DataFrame) -> DataFrame:
    """The store (topic, partition) of partitions that have ever been committed."""
    return store.select(*TP).union(commits.select(*TP)).distinct()


def merge_checkpoints(parts: DataFrame) -> DataFrame:
    """(seq_id, topic, partition, offset, complete) of partial checkpoints (seq_id, contributor, expected, put_seq, topic, partition, offset).

    The last put of a topic partition wins. A merge is complete when as many different contributors
    have put as any of them expects; a sole contributor needs no merge.
    """
    ready = parts.groupBy("seq_id").agg((F.countDistinct("contributor") >= F.max("expected")).alias("complete"))
    last = parts.groupBy("seq_id", *TP).agg(F.max_by("offset", F.struct("put_seq", "contributor")).alias("offset"))
    return last.join(ready, "seq_id")


def first_wins(puts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A write-once store (group_id, topic, partition, offset): the first put by ``seq`` stays, stored keys are never replaced."""
    keys = ["group_id", *TP]
    first = puts.groupBy(*keys).agg(F.min_by("offset", "seq").alias("offset"))
    if known is None:
        return first
    return known.select(*first.columns).unionByName(first.join(known, keys, "left_anti"))


def seek_after_reset(partitions: DataFrame, checkpoint: DataFrame, initial: DataFrame, start: DataFrame) -> DataFrame:
    """(topic, partition, position, origin): the checkpoint's offset, else the stored initial one, else the start position."""
    c, i, s = (df.select(*TP, F.col(name).alias(x)) for df, name, x in ((checkpoint, "offset", "c"), (initial, "offset", "i"), (start, "position", "s")))
    joined = partitions.join(c, TP, "left").join(i, TP, "left").join(s, TP, "left")
    return joined.select(*TP, F.coalesce("c", "i", "s").alias("position"), F.when(F.col("c").isNotNull(), "checkpoint").when(F.col("i").isNotNull(), "initial").otherwise("start").alias("origin"))


def reject_unregistered(offsets: DataFrame, registered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) offsets: strict saves only take registered topic partitions."""
    return offsets.join(registered.select(*TP).distinct(), TP, "left_semi"), offsets.join(registered, TP, "left_anti")
