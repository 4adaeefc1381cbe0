"""A log in segments with a manifest: where each segment's records are, from which offset to which, and in what time.

    path/data/...            Parquet files of records; an offset is the segment's base plus the record's place
    path/segments/*.parquet  the manifest: one file for each write, moved into place when all of its data is there

A write is seen by its manifest file or not at all. The extents of a log and the
positions of a start come from the manifest, which has a row for each segment; only
a start by time looks into records, and there into one segment of each partition.

``Store`` is the side without Spark, for planning and for tasks; the functions below are
the side of DataFrames. One writer at a time may append to a topic partition.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.spec import BEGINNING, END, NO_SEEK, ConsumerSpec, SpecError, StartPosition
from tidemark.sources import log as logs

MANIFEST = pa.schema([
    ("kind", pa.string()), ("batch", pa.string()), ("topic", pa.string()), ("partition", pa.int32()), ("file", pa.string()), ("base", pa.int64()),
    ("first_offset", pa.int64()), ("last_offset", pa.int64()), ("min_ms", pa.int64()), ("max_ms", pa.int64()), ("rows", pa.int64()), ("tries", pa.int64()),
])
MANIFEST_DDL = "kind string, batch string, topic string, partition int, file string, base long, first_offset long, last_offset long, min_ms long, max_ms long, rows long, tries long"
RECORD = pa.schema([("place", pa.int64()), ("timestamp_ms", pa.int64()), ("key", pa.binary()), ("value", pa.binary()), ("txn_id", pa.string()), ("txn_state", pa.string())])
LOG = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp_ms", pa.int64()), ("key", pa.binary()), ("value", pa.binary()), ("txn_id", pa.string()), ("txn_state", pa.string())])

#: Offsets of a partition in one file at most.
RUN = 1 << 18

#: (topic, partition) to offset.
Offsets = dict[tuple[str, int], int]


class Store:
    """The files of one log, on any file system that pyarrow knows."""

    def __init__(self, path: str):
        self.path = path
        self.fs, self.root = pafs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", path))

    def files(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{folder}", recursive=True, allow_not_found=True))
        hidden = re.compile(r"/[._][^/]*(/|$)")
        return sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet") and not hidden.search(f.path[len(self.root) :]))

    def manifest(self, kind: str = "data") -> pa.Table:
        tables = [pq.read_table(f, filesystem=self.fs, partitioning=None).select(MANIFEST.names).cast(MANIFEST) for f in self.files("segments")]
        every = pa.concat_tables([MANIFEST.empty_table(), *tables])
        return every.filter(ds.field("kind") == kind).sort_by([("topic", "ascending"), ("partition", "ascending"), ("first_offset", "ascending")])

    def put(self, table: pa.Table, name: str) -> str:
        """Write a file and then move it into place, so that it is there whole or not at all."""
        folder, _, _ = f"{self.root}/{name}".rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        hidden = f"{folder}/_{uuid.uuid4().hex}.tmp"
        pq.write_table(table, hidden, filesystem=self.fs)
        self.fs.move(hidden, f"{self.root}/{name}")
        return name

    def delete(self, names: list[str]) -> None:
        for name in names:
            if self.has(name):
                self.fs.delete_file(f"{self.root}/{name}")

    def has(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.root}/{name}").is_file

    def extents(self, segments: pa.Table | None = None) -> dict[tuple[str, int], tuple[int, int]]:
        """The first offset of each partition and the one after its last."""
        out: dict[tuple[str, int], tuple[int, int]] = {}
        for s in (self.manifest() if segments is None else segments).to_pylist():
            lo, hi = out.get(key := (s["topic"], s["partition"]), (s["first_offset"], 0))
            out[key] = min(lo, s["first_offset"]), max(hi, s["last_offset"] + 1)
        return out

    def batches(self, segment: dict, lo: int, hi: int, isolation: str = "read_committed"):
        """The records of a segment from one offset to before another, as Arrow batches in the log's columns."""
        base = segment["base"]
        wanted = (ds.field("place") >= lo - base) & (ds.field("place") < hi - base)
        if isolation == "read_committed":
            wanted = wanted & (ds.field("txn_state").is_null() | (ds.field("txn_state") == "committed"))
        data = ds.dataset(f"{self.root}/data/{unquote(segment['file'])}", filesystem=self.fs, format="parquet", schema=RECORD)
        for b in data.to_batches(columns=RECORD.names, filter=wanted, batch_size=10_000):
            n = b.num_rows
            if n:
                offset = pa.compute.add(b.column("place"), base)
                yield pa.RecordBatch.from_arrays([pa.array([segment["topic"]] * n, pa.string()), pa.array([segment["partition"]] * n, pa.int32()), offset, *b.columns[1:]], schema=LOG)

    def at_time(self, segments: pa.Table, time_ms: int) -> Offsets:
        """The first offset at or after a time of each partition that has one; one segment of each is read."""
        first: dict[tuple[str, int], dict] = {}
        for s in segments.to_pylist():
            if s["max_ms"] is not None and s["max_ms"] >= time_ms:
                first.setdefault((s["topic"], s["partition"]), s)
        out = {}
        for key, s in first.items():
            data = ds.dataset(f"{self.root}/data/{unquote(s['file'])}", filesystem=self.fs, format="parquet", schema=RECORD)
            places = data.to_table(columns=["place"], filter=(ds.field("timestamp_ms") >= time_ms) & (ds.field("place") >= s["first_offset"] - s["base"]))
            out[key] = s["base"] + pa.compute.min(places["place"]).as_py()
        return out


def subscribed(spec: ConsumerSpec, topic: str, partition: int) -> bool:
    if spec.pattern is not None:
        return re.fullmatch(spec.pattern, topic) is not None
    return topic in spec.topics and (not spec.partitions or partition in spec.partitions)


def starts(store: Store, spec: ConsumerSpec, committed: Offsets | None = None, once: set | None = None, keys: set | None = None) -> Offsets:
    """Where reading starts in each partition that a description reads, from the manifest. The same rules as ``offsets.start_positions``.

    keys: only these partitions. once: partitions that this reader has committed before.
    """
    segments = store.manifest()
    extents = {k: v for k, v in store.extents(segments).items() if subscribed(spec, *k) and (keys is None or k in keys)}
    reset = {k: lo if spec.auto_offset_reset in ("earliest", "smallest") else hi for k, (lo, hi) in extents.items()}
    default = {k: (committed or {}).get(k, v) for k, v in reset.items()}
    kind = spec.position
    if kind is StartPosition.DEFAULT:
        return default
    if kind is StartPosition.BEGINNING:
        start = {k: lo for k, (lo, _) in extents.items()}
    elif kind is StartPosition.END:
        start = {k: hi for k, (_, hi) in extents.items()}
    elif kind is StartPosition.TIME:
        mine = pa.Table.from_pylist([s for s in segments.to_pylist() if (s["topic"], s["partition"]) in extents], MANIFEST)
        start = default | store.at_time(mine, spec.start_time)
    else:
        asked = {(spec.topics[0], p): o for p, o in zip(spec.partitions, spec.start_offsets, strict=True)}
        special = {END: lambda k: extents[k][1], BEGINNING: lambda k: extents[k][0], NO_SEEK: lambda k: default[k]}
        start = {k: special.get(o, lambda k, o=o: o)(k) for k, o in asked.items() if k in extents}
    return {k: default[k] if once and k in once else v for k, v in start.items()}


# --- DataFrames -------------------------------------------------------------------


def append(log: DataFrame, path: str, batch: str | None = None) -> None:
    """Add records with their offsets to the log under ``path``: the data, then the manifest of its segments, a file for each run of a partition's offsets.

    Runs don't overlap within a write, so a reader of some offsets opens the files that hold them only. Repeating a ``batch`` that is there already changes nothing.
    """
    spark = log.sparkSession
    name = batch or uuid.uuid4().hex
    if Store(path).has(f"segments/{name}.parquet"):
        return
    at = f"{path}/data/{name}"
    keys = ["topic", "partition", "run"]
    rows = log.select(*keys[:2], F.floor(F.col("offset") / RUN).alias("run"), F.col("offset").alias("place"), *RECORD.names[1:])
    rows.repartition(*keys).sortWithinPartitions(*keys, "place").write.mode("overwrite").partitionBy(*keys).parquet(at)
    written = spark.read.schema("place long, timestamp_ms long, topic string, partition int").parquet(at)
    file = F.concat(F.lit(f"{name}/"), F.element_at(F.split(F.col("_metadata.file_path"), f"/data/{name}/"), -1))
    found = written.groupBy("topic", "partition", file.alias("file")).agg(F.min("place").alias("lo"), F.max("place").alias("hi"), F.min("timestamp_ms").alias("a"), F.max("timestamp_ms").alias("z"), F.count("*").alias("n"))
    rows = [{"kind": "data", "batch": name, "topic": r.topic, "partition": r.partition, "file": r.file, "base": 0, "first_offset": r.lo, "last_offset": r.hi, "min_ms": r.a, "max_ms": r.z, "rows": r.n, "tries": 1} for r in found.toLocalIterator()]
    Store(path).put(pa.Table.from_pylist(rows, MANIFEST), f"segments/{name}.parquet")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).parquet(f"{path}/segments").where("kind = 'data'")


def extents(spark: SparkSession, path: str) -> DataFrame:
    """(topic, partition, log_begin, log_end) from the manifest alone."""
    return manifest(spark, path).groupBy("topic", "partition").agg(F.min("first_offset").alias("log_begin"), (F.max("last_offset") + 1).alias("log_end"))


def time_positions(spark: SparkSession, path: str, time_ms: int, only: DataFrame | None = None) -> DataFrame:
    """(topic, partition, found): the first offset at or after a time, by a join of records with one segment of each partition.

    only: (topic, partition) to look at. Files of other segments aren't opened.
    """
    late = manifest(spark, path).where(F.col("max_ms") >= time_ms)
    if only is not None:
        late = late.join(only.select("topic", "partition").distinct(), ["topic", "partition"], "left_semi")
    one = late.groupBy("topic", "partition").agg(F.min_by(F.struct("file", "base"), "first_offset").alias("s")).select("topic", "partition", "s.file", "s.base").collect()  # a row for each partition
    if not one:
        return spark.createDataFrame([], "topic string, partition int, found long")
    root = str(path).rstrip("/")
    data = spark.read.schema("place long, timestamp_ms long").parquet(*[f"{root}/data/{_escaped(r.file)}" for r in one])
    known = spark.createDataFrame(one, "topic string, partition int, file string, base long")
    hits = data.where(F.col("timestamp_ms") >= time_ms).groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/data/"), -1).alias("file")).agg(F.min("place").alias("place"))
    return known.join(hits, "file").select("topic", "partition", (F.col("base") + F.col("place")).alias("found"))


def _escaped(file: str) -> str:
    """A name of the manifest as a path pattern of Spark, which reads some characters as wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def read(spark: SparkSession, path: str, positions: DataFrame | None = None) -> DataFrame:
    """The log as its readers see it; files without an entry in the manifest aren't part of it.

    positions: (topic, partition, position) from where to read; segments that end before are left out by the manifest.
    """
    segments = manifest(spark, path)
    if positions is not None:
        segments = segments.join(positions, ["topic", "partition"]).where("last_offset >= position")
    else:
        segments = segments.withColumn("position", F.col("first_offset"))
    record = "place long, timestamp_ms long, key binary, value binary, txn_id string, txn_state string"
    data = spark.read.schema(record).option("recursiveFileLookup", True).parquet(f"{path}/data")
    data = data.withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/data/"), -1))
    joined = data.join(segments.select("topic", "partition", "file", "base", "position"), "file").withColumn("offset", F.col("base") + F.col("place"))
    return joined.where("offset >= position").select(*logs.SCHEMA.names)


def start_positions(spark: SparkSession, path: str, spec: ConsumerSpec, committed: DataFrame | None = None) -> DataFrame:
    """(topic, partition, position), from the manifest and, by time, one segment of each partition."""
    from tidemark.operators import offsets

    mine = logs.subscribed(extents(spark, path), spec)
    base = offsets.default_positions(mine, committed, spec.auto_offset_reset)
    kind = spec.position
    if kind is StartPosition.TIME:
        found = time_positions(spark, path, spec.start_time, mine)
        return base.join(found, ["topic", "partition"], "left").select("topic", "partition", F.coalesce("found", "position").alias("position"))
    if kind is StartPosition.OFFSET:
        raise SpecError("start offsets are positions already; use offsets.seek_all with the extents")
    column = {StartPosition.BEGINNING: "log_begin", StartPosition.END: "log_end", StartPosition.DEFAULT: "position"}[kind]
    return base.select("topic", "partition", F.col(column).alias("position"))
