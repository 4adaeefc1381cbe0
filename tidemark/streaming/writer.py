"""A log as a stream's sink: rows are routed in the plan and written by the data source in two phases.

Every row and topic has a verdict in the plan already; the data source writes what can be
written, tries again what can be recovered, tells the rest, and gives offsets when a batch is
committed. With ``transactional`` an aborted batch leaves nothing; without, what its
finished tasks have written stays and comes again with the replay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import metrics, sink
from tidemark.plans.spec import SinkSpec
from tidemark.sources import datasource, segments
from tidemark.streaming import errors


@dataclass
class LogWriter:
    """Writes rows by a description to the log under ``home``. name: tells the writers of a log apart.

    measured: topics whose records, bytes and failures a running query observes; without, those of the description.
    """

    spark: SparkSession
    spec: SinkSpec
    home: str
    n_partitions: int | DataFrame = 1
    partitioner: sink.Partitioner = sink.by_hash
    name: str = "writer"
    backoff: float = errors.BACKOFF
    source: type = datasource.TidemarkLog
    measured: list[str] | None = None

    def __post_init__(self):
        self.spark.dataSource.register(self.source)

    def _options(self) -> dict[str, str]:
        s = self.spec
        return {"path": self.home, "writer": self.name, "transactional": str(s.transactional), "errorsOnly": str(s.errors_only), "flush": str(s.flush), "generations": str(s.max_generations), "backoff": str(self.backoff)}

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """One batch; a batch number that is there already adds nothing."""
        self._routed(rows).write.format(self.source.name()).mode("append").options(**self._options(), batch=str(batch_id)).save()

    def _routed(self, rows: DataFrame) -> DataFrame:
        return sink.routed(rows, self.spec, self.n_partitions, self.partitioner)

    def start(self, rows: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        routed = self._routed(rows)
        if self.spec.topics or self.measured:
            routed = routed.observe(f"sent-{self.name}", *metrics.sent(self.spec.topics or self.measured))
        out = routed.writeStream.format(self.source.name()).options(**self._options())
        return out.option("checkpointLocation", f"{self.home}/checkpoint-{self.name}").trigger(**(trigger or {"availableNow": True})).start()

    def log(self) -> DataFrame:
        """The log as its readers see it."""
        return segments.read(self.spark, self.home)

    def status(self) -> DataFrame:
        """The status rows of all batches that are seen."""
        store = segments.Store(self.home)
        files = store.manifest("status")["file"].to_pylist()
        root = self.home.rstrip("/")
        return self.spark.read.parquet(*[f"{root}/{f}" for f in files]) if files else self.spark.createDataFrame([], "inTuple struct<>, failureDescription string")

    def counters(self) -> DataFrame:
        """(topic, name, value): records and bytes of time that were written, tries, and rows that failed, each counted once however often it was tried."""
        m = self.spark.read.schema(segments.MANIFEST_DDL).parquet(f"{self.home}/segments")
        of_topic = m.where("kind in ('data', 'lost')").groupBy("topic").agg(
            F.sum(F.when(F.col("kind") == "data", F.col("rows")).otherwise(0)).alias("nSent"), F.sum(F.when(F.col("kind") == "lost", F.col("rows")).otherwise(0)).alias("nLost"),
            F.sum(F.col("tries") - F.when(F.col("kind") == "data", 1).otherwise(0)).alias("nRetries"), F.max("tries").alias("producerGeneration"),
        )
        failed = m.where("kind = 'status'").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("value")).select(F.lit(None).cast("string").alias("topic"), F.lit("nFailedTuples").alias("name"), "value")
        return of_topic.unpivot("topic", ["nSent", "nLost", "nRetries", "producerGeneration"], "name", "value").unionByName(failed)
