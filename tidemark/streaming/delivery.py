"""Delivery of a log table as a stream: each micro-batch is read, written as one transaction, and then committed.

The stream's own checkpoint replays a batch that did not end; its transaction is
then replaced, so every record is delivered once. Where a partition starts is
stored before anything of it is delivered and never written again, so a replay
finds the same positions whatever was written before it broke off.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import offsets
from tidemark.plans.spec import Commit, ConsumerSpec, Region, StartPosition
from tidemark.sources import log as logs
from tidemark.sources import reader
from tidemark.streaming import transactions

TP = offsets.TP
OFFSETS = "topic string, partition int, offset long"
COMMITS = f"{OFFSETS}, group_id string, job string, run int, batch string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended."""
    return _exists(spark, f"{path}/_SUCCESS")


@dataclass
class Delivery:
    """A reader of the log under ``log_path`` whose output and positions are under ``home``.

    store: where the group's commits are, for readers that share them; else beside the output.
    job: the reader's name in that store.
    """

    spark: SparkSession
    log_path: str
    spec: ConsumerSpec
    home: str
    max_files: int = 1000
    store: str | None = None
    job: str = "job"

    @property
    def run(self) -> int:
        """How often the reader was set back to its initial state."""
        return 0 if not _exists(self.spark, f"{self.home}/resets") else self.spark.read.schema("at long, run int").parquet(f"{self.home}/resets").agg(F.max("run")).first()[0]

    def _path(self, name: str) -> str:
        """Output, progress and the stream's checkpoint belong to a run; initial positions and commits outlive it."""
        return f"{self.home}/run={self.run}/{name}"

    def _commits(self) -> str:
        return self.store or f"{self.home}/offsets"

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", path).parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def initial(self) -> DataFrame:
        """(topic, partition, offset, batch): where partitions started; written once."""
        return self._read(f"{self.home}/initial", f"{OFFSETS}, batch string")

    def group_commits(self) -> DataFrame:
        """(topic, partition, offset) committed by any reader of the group."""
        mine = self._read(self._commits(), COMMITS).where(F.col("group_id") == (self.spec.group_id or "default"))
        return mine.groupBy(*TP).agg(F.max_by("offset", F.struct("run", "offset")).alias("offset"))

    def committed(self) -> DataFrame:
        """(topic, partition, offset) committed by this reader since it was last set back."""
        return self._read(self._commits(), COMMITS).where((F.col("job") == self.job) & (F.col("run") == self.run)).groupBy(*TP).agg(F.max("offset").alias("offset"))

    def committed_once(self) -> DataFrame:
        """(topic, partition) that this reader has ever committed; with another start position than Default they go on from their commits."""
        return self._read(self._commits(), COMMITS).where(F.col("job") == self.job).select(*TP).distinct()

    def _start(self, log: DataFrame, ends: DataFrame | None = None) -> DataFrame:
        once = None if self.spec.position is StartPosition.DEFAULT else self.committed_once()
        return offsets.start_positions(log, self.spec, self.group_commits(), once, ends).select(*TP, F.col("position").alias("offset"))

    def _store_once(self, rows: DataFrame, batch: str) -> None:
        path = f"{self.home}/initial/batch={batch}"
        if not _complete(self.spark, path):
            rows.coalesce(1).write.mode("overwrite").parquet(path)

    def prepare(self) -> None:
        """Store, once, where the partitions start that the log has by now. This reads the log's offsets once in a reader's life."""
        if not _complete(self.spark, f"{self.home}/initial/batch=start"):
            self._store_once(self._start(logs.read(self.spark, self.log_path)), "start")

    def _place_new(self, mine: DataFrame, batch_id: int) -> None:
        """Store where partitions start that came up after the reader: in a log that held nothing of them before."""
        if _complete(self.spark, f"{self.home}/initial/batch={batch_id}"):
            return
        known = self.initial().where(F.col("batch") != str(batch_id))
        new = mine.select(*TP).distinct().join(known, TP, "left_anti")
        keys = new.collect()  # partitions that nobody has seen before: a few, and mostly none
        if keys:
            new = self.spark.createDataFrame(keys, "topic string, partition int")
            log = logs.read(self.spark, self.log_path).join(F.broadcast(new), TP, "left_semi")
            before = logs.extents(log).select(*TP, F.col("log_begin").alias("log_end"))
            self._store_once(self._start(log, before), str(batch_id))

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; running it again, whatever was written before, gives the same output and offsets."""
        self.prepare()
        mine = logs.visible(logs.subscribed(batch, self.spec), self.spec.isolation).persist()
        try:
            self._place_new(mine, batch_id)
            records = offsets.from_positions(mine, self.initial().select(*TP, F.col("offset").alias("position")))
            if self.spec.region is Region.OPERATOR_DRIVEN:
                # Each trigger_count records of the batch, in order of arrival, are a transaction.
                numbered = offsets.arrival_numbers(records)
                txn = F.concat(F.lit(f"{batch_id}r"), F.floor(F.col("arrival") / self.spec.trigger_count).cast("string"))
                decoded = reader.decoded(numbered.withColumn("txn", txn), self.spec)
                transactions.write_each(reader.project(decoded, self.spec, keep=["txn"]), self._path("out"), "txn")
            else:
                transactions.write(reader.project(reader.decoded(records, self.spec), self.spec), self._path("out"), str(batch_id))
            self._commit(records, batch_id)
        finally:
            mine.unpersist()

    def _commit(self, records: DataFrame, batch_id: int) -> None:
        """Commit what was delivered; by count only once that many records of the reader, delivered or dropped, have come since the last commit."""
        done = offsets.next_offsets(records)
        if self.spec.commit is Commit.COUNT:
            records.groupBy(*TP).agg((F.max("offset") + 1).alias("offset"), F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{self._path('progress')}/batch={batch_id}")
            mine = self._read(self._commits(), COMMITS).where((F.col("job") == self.job) & (F.col("run") == self.run))
            last = mine.where(F.col("batch").cast("int") < batch_id).agg(F.max(F.col("batch").cast("int"))).first()[0]
            since = self._read(self._path("progress"), f"{OFFSETS}, n long, batch int").where((F.col("batch") > (-1 if last is None else last)) & (F.col("batch") <= batch_id))
            if (since.agg(F.sum("n")).first()[0] or 0) < self.spec.commit_count:
                return
            done = since.groupBy(*TP).agg(F.max("offset").alias("offset"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{self._commits()}/group_id={self.spec.group_id or 'default'}/job={self.job}/run={self.run}/batch={batch_id}")

    def start(self, trigger: dict | None = None) -> StreamingQuery:
        """Start delivering. Commits follow batches: by time every commit period, by count when enough records have come, otherwise as soon as there is data."""
        self.prepare()
        stream = self.spark.readStream.schema(logs.SCHEMA).option("maxFilesPerTrigger", self.max_files).parquet(self.log_path)
        if trigger is None:
            trigger = {"processingTime": f"{self.spec.commit_period} seconds"} if self.spec.commit is Commit.TIME else {"availableNow": True}
        return stream.select(*logs.SCHEMA.names).writeStream.foreachBatch(self.deliver).option("checkpointLocation", self._path("checkpoint")).trigger(**trigger).start()

    def reset_to_initial(self) -> None:
        """Set the reader back: the next start delivers again from the stored initial positions, into a new output."""
        self.spark.range(1).select(F.col("id").alias("at"), F.lit(self.run + 1).alias("run")).coalesce(1).write.mode("append").parquet(f"{self.home}/resets")

    def delivered(self) -> DataFrame:
        return transactions.read(self.spark, self._path("out")).drop("txn_id", "txn_state")
