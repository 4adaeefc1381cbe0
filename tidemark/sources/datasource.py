"""The log as a data source of Spark, ``tidemark``: batch and stream reads by offset, and writes in two phases.

Reading. A stream's checkpoint holds an offset for each topic partition. The manifest
says what there is, so a micro-batch is planned without opening files: each of its tasks
reads a span of one segment. ``maxRecords`` admits at most so many records to a batch;
``region`` admits exactly so many or none, so each batch is one region of that many
records whatever the sizes of the writes. With ``together`` a micro-batch brings up to so
many of these batches side by side, as each micro-batch has a fixed price; every record
then has ``before``, the number of records that the reader had before its batch, which
tells batches apart and is the same in a replay. Options: path, topics, pattern, partitions,
start, startTime, startOffsets, groupId, isolation, reset; home: a folder of the reader
for its positions, its commits and where it started, which is written once.

Writing. Input rows are those of ``sink.routed``. Tasks write segments under names of
their own and report them; the driver's commit gives them offsets and makes all of
them visible by one manifest file. A batch that runs again finds its manifest and adds nothing; a
batch that is aborted leaves nothing (without ``transactional``: what finished tasks
have written stays, and comes again with the replay). Every record is in a segment or
its row has a status row: records that can't be routed, and those whose write has
failed for good, are told with their exception, the others are written. Options: path, writer,
transactional, errorsOnly, optionalText, flush (records a task holds before it writes),
generations, backoff.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.plans.spec import ConsumerSpec, SpecError, StartPosition
from tidemark.sources import segments
from tidemark.streaming import errors

SCHEMA = "topic string, partition int, offset long, timestamp_ms long, key binary, value binary, txn_id string, txn_state string"
#: Records in a task that reads, and bytes that a task holds before it writes.
SPAN, HELD_BYTES = 2_000_000, 64 << 20


def numbers(text: str | None) -> list[int]:
    return [int(x) for x in (text or "").split(",") if x.strip()]


def spec_of(options) -> ConsumerSpec:
    """The description that a reader's options give; contradictions raise SpecError."""
    time = options.get("startTime")
    return ConsumerSpec(
        topics=options.get("topics"), pattern=options.get("pattern"), partitions=numbers(options.get("partitions")), start_position_str=options.get("start"), start_time=int(time) if time else None,
        start_offsets=numbers(options.get("startOffsets")), group_id=options.get("groupId"), isolation=options.get("isolation", "read_committed"), auto_offset_reset=options.get("reset", "latest"),
    )


def nested(offsets: segments.Offsets) -> dict:
    out: dict = {}
    for (topic, partition), offset in sorted(offsets.items()):
        out.setdefault(topic, {})[str(partition)] = offset
    return out


def flat(offsets: dict) -> segments.Offsets:
    return {(t, int(p)): o for t, ps in offsets.items() for p, o in ps.items()}


@dataclass
class Span(InputPartition):
    """Offsets from ``lo`` to before ``hi`` of one segment."""

    segment: dict
    lo: int
    hi: int
    cuts: list[int] = field(default_factory=list)  # where the batches side by side end, of those that end in the span
    before: int = 0  # records before the span's first batch


def spans(store: segments.Store, start: segments.Offsets, end: segments.Offsets, most: int = SPAN) -> list[Span]:
    out = []
    for s in store.manifest().to_pylist():
        key = (s["topic"], s["partition"])
        if key in end and key in start:
            lo, hi = max(start[key], s["first_offset"]), min(end[key], s["last_offset"] + 1)
            out += [Span(s, a, min(a + most, hi)) for a in range(lo, hi, most)]
    return out


def admitted(start: segments.Offsets, end: segments.Offsets, most: int, exact: bool = False) -> segments.Offsets:
    """Offsets up to which at most ``most`` records come after ``start``, shared by what each partition has; exact: that many or none."""
    behind = {k: max(end[k] - start[k], 0) for k in end}
    total = sum(behind.values())
    if exact and total < most:
        return dict(start)
    if total <= most:
        return {k: max(end[k], start[k]) for k in end}
    share = {k: n * most // total for k, n in behind.items()}
    left = most - sum(share.values())
    for k in sorted(behind, key=lambda k: (-(behind[k] * most % total), k)):
        if left and share[k] < behind[k]:
            share[k] += 1
            left -= 1
    return {k: start[k] + share[k] for k in end}


def side_by_side(start: segments.Offsets, end: segments.Offsets, most: int) -> list[segments.Offsets]:
    """The ends of batches of ``most`` records from ``start`` to ``end``, one after another; the last has what is left."""
    out = []
    while any(end[k] > start[k] for k in end):
        start = admitted(start, end, most)
        out.append(start)
    return out


class _Reading:
    def __init__(self, options):
        self.options, self.spec = options, spec_of(options)
        self.store = segments.Store(options["path"])
        self.home = segments.Store(options["home"]) if options.get("home") else None

    def kept(self, name: str) -> segments.Offsets:
        """Offsets that the reader has stored under a name."""
        if not self.home or not self.home.has(f"{name}.json"):
            return {}
        with self.home.fs.open_input_stream(f"{self.home.root}/{name}.json") as f:
            return flat(json.loads(f.read()))

    def keep(self, name: str, offsets: segments.Offsets) -> None:
        if self.home:
            self.home.fs.create_dir(self.home.root, recursive=True)
            hidden = f"{self.home.root}/_{uuid.uuid4().hex}.tmp"
            with self.home.fs.open_output_stream(hidden) as f:
                f.write(json.dumps(nested(offsets)).encode())
            self.home.fs.move(hidden, f"{self.home.root}/{name}.json")

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        yield from self.store.batches(partition.segment, partition.lo, partition.hi, self.spec.isolation)


class BatchReader(_Reading, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        if options.get("together"):
            raise SpecError("a batch read has no batches to bring together")

    def partitions(self):
        committed = self.kept("commits")
        start = segments.starts(self.store, self.spec, committed, set(committed))
        return spans(self.store, start, {k: hi for k, (_, hi) in self.store.extents().items()}) or [Span({}, 0, 0)]

    def read(self, partition):
        return super().read(partition) if partition.segment else iter(())


class StreamReader(_Reading, DataSourceStreamReader):
    """Where it stands is known from the last batch that was planned; after a restart, from the reader's home."""

    def __init__(self, options):
        super().__init__(options)
        self.most, self.region = int(options.get("maxRecords", 0)), int(options.get("region", 0))
        if (self.region or self.most) and not self.home:
            raise SpecError("batches of a number of records need a home, or a restart wouldn't know where the last one ended")
        self.together = int(options.get("together", 0))
        if self.together and not (self.region or self.most):
            raise SpecError("only batches of a number of records can come together")
        self.at: segments.Offsets | None = None

    def initialOffset(self) -> dict:
        begun = self.kept("initial")
        if not begun:
            committed = self.kept("commits")
            begun = segments.starts(self.store, self.spec, committed, set(committed))
            self.keep("initial", begun)  # once; a replay or a second start finds it
        self.at = dict(begun)
        return nested(begun)

    def _placed(self, start: segments.Offsets, keys) -> segments.Offsets:
        """``start`` with partitions that came up later: by time where that is the start, else from their beginning."""
        new = {k for k in keys if k not in start}
        if not new:
            return start
        extents = self.store.extents()
        begun = {k: extents[k][0] for k in new}
        if self.spec.position is StartPosition.TIME:
            begun |= segments.starts(self.store, self.spec, keys=new)
        return start | begun

    def latestOffset(self) -> dict:
        end = {k: hi for k, (_, hi) in self.store.extents().items() if segments.subscribed(self.spec, *k)}
        at = self.at if self.at is not None else self.kept("planned")
        if not self.home and self.at is None:
            return nested(end)  # where the query stands is in its checkpoint, which sources don't see
        if not at:
            self.initialOffset()  # Spark asks for the end first
        base = at or self.kept("initial")
        start = self._placed(base, end)
        if self.region or self.most:
            most, n = self.region or self.most, max(self.together, 1)
            if self.region:  # as many whole regions as there are
                n = max(min(n, sum(max(end[k] - start[k], 0) for k in end) // most), 1)
            end = admitted(start, end, most * n, exact=bool(self.region))
        # Without new records the offsets stay as they were, also where partitions came up.
        return nested(start | {k: max(end[k], start[k]) for k in end} if any(end[k] > start[k] for k in end) else base)

    def partitions(self, start: dict, end: dict):
        upto = flat(end)
        self.at = upto
        self.keep("planned", upto)
        begun = self._placed(flat(start), upto)
        found = spans(self.store, begun, upto)
        if not self.together:
            return found
        most = self.region or self.most
        read = sum(begun.values()) - sum(self._placed(self.kept("initial"), begun).values())
        each = side_by_side({k: begun[k] for k in upto}, upto, most)
        cuts = {k: [e[k] for e in each] for k in upto}
        for s in found:
            mine = cuts[s.segment["topic"], s.segment["partition"]]
            a, z = bisect_right(mine, s.lo), bisect_right(mine, s.hi - 1)
            s.cuts, s.before = mine[a:z], read + a * most
        return found

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        for b in super().read(partition):
            if not self.together:
                yield b
                continue
            place = np.searchsorted(np.asarray(partition.cuts, np.int64), b.column("offset").to_numpy(), "right")
            before = pa.array(partition.before + place * (self.region or self.most), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, before], schema=b.schema.append(pa.field("before", pa.int64())))

    def commit(self, end: dict) -> None:
        self.keep("commits", flat(end))


# --- writing ----------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: data and status files, in order."""

    entries: list[dict] = field(default_factory=list)


class _Writing:
    def __init__(self, options):
        self.options = options
        self.store = segments.Store(options["path"])
        flag = lambda name, default: str(options.get(name, default)).lower() == "true"
        self.transactional, self.errors_only, self.optional = flag("transactional", "false"), flag("errorsOnly", "true"), flag("optionalText", "true")
        self.flush = int(options.get("flush", 0))
        self.generations, self.backoff = int(options.get("generations", errors.MAX_GENERATIONS)), float(options.get("backoff", errors.BACKOFF))
        self.writer = options.get("writer", "writer")

    def put(self, table: pa.Table, name: str) -> None:
        """Write one file of records; tests break it."""
        self.store.put(table, name)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One task: records by topic partition into segments; rows with a failure into status files."""
        done, held, size, n = Written(), [], 0, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, step := self.flush or batch.num_rows or 1):
                piece = batch.slice(at, step)
                held.append(piece)
                size, n = size + piece.nbytes, n + piece.num_rows
                if (self.flush and n >= self.flush) or size >= HELD_BYTES:
                    self._flush(held, done)
                    held, size, n = [], 0, 0
        if held:
            self._flush(held, done)
        return done

    def _flush(self, held: list[pa.RecordBatch], done: Written) -> None:
        table = pa.Table.from_batches(held).combine_chunks()
        records = table.column("records").combine_chunks()
        owner = records.value_parent_indices()
        flat_records = pa.Table.from_struct_array(records.flatten()).append_column("owner", owner)
        failures: dict[int, list[tuple[str | None, str, str]]] = {}
        bad = flat_records.filter(flat_records["failure"].is_valid())
        for r in bad.select(["owner", "topic", "failure", "reason"]).to_pylist():
            failures.setdefault(r["owner"], []).append((r["topic"], r["failure"], r["reason"]))
        good = flat_records.filter(flat_records["failure"].is_null())
        keys = good.select(["topic", "partition"]).group_by(["topic", "partition"]).aggregate([]).to_pylist()
        for key in sorted(keys, key=lambda k: (k["topic"], k["partition"])):
            mine = good.filter(pa.compute.and_(pa.compute.equal(good["topic"], key["topic"]), pa.compute.equal(good["partition"], key["partition"])))
            self._segment(key, mine, done, failures)
        self._tell(table, failures, done)

    def _segment(self, key: dict, mine: pa.Table, done: Written, failures: dict) -> None:
        n, name, tries = mine.num_rows, f"data/{self.writer}-{uuid.uuid4().hex}.parquet", []
        state = pa.array(["committed"] * n if self.transactional else [None] * n, pa.string())
        data = pa.Table.from_arrays([pa.array(range(n), pa.int64()), mine["timestamp_ms"], mine["key"], mine["value"], pa.array([name] * n if self.transactional else [None] * n, pa.string()), state], schema=segments.RECORD)
        try:
            errors.recover(lambda: self.put(data, name), self.generations, self.backoff, failed=tries.append)
        except Exception as e:  # for good: its rows are told, the others go on
            for owner in mine["owner"].to_pylist():
                failures.setdefault(owner, []).append((key["topic"], type(e).__name__, str(e)))
            done.entries.append({"kind": "lost", "topic": key["topic"], "partition": key["partition"], "rows": n, "tries": len(tries)})
            return
        times = pa.compute.min_max(mine["timestamp_ms"]).as_py()
        done.entries.append({"kind": "data", **key, "file": name.removeprefix("data/"), "min_ms": times["min"], "max_ms": times["max"], "rows": n, "tries": len(tries) + 1})

    def _tell(self, table: pa.Table, failures: dict, done: Written) -> None:
        """A status row for each row, or for each that has failed."""
        at = sorted(failures) if self.errors_only else range(table.num_rows)
        if not len(at):
            return
        texts = [json.dumps({"failedTopics": sorted({t or "" for t, _, _ in failures[i]}), "lastExceptionType": failures[i][-1][1], "lastFailure": failures[i][-1][2]}, separators=(",", ":"), ensure_ascii=False) if i in failures else None if self.optional else "" for i in at]
        name = f"status/{self.writer}-{uuid.uuid4().hex}.parquet"
        status = pa.table({"inTuple": table.column("row").take(pa.array(at, pa.int64())), "failureDescription": pa.array(texts, pa.string())})
        errors.recover(lambda: self.store.put(status, name), self.generations, self.backoff)
        done.entries.append({"kind": "status", "file": name, "rows": len(failures)})

    def _names(self, messages) -> list[str]:
        return [f"data/{e['file']}" if e["kind"] == "data" else e["file"] for m in messages if m for e in m.entries if e.get("file")]

    def _publish(self, messages, batch: str) -> None:
        """Give segments their offsets, in the order of the tasks, and make all of them visible."""
        entry = f"segments/{batch}.parquet"
        if self.store.has(entry):
            self.store.delete(self._names(messages))  # a replay of a batch that is there
            return
        ends = {k: hi for k, (_, hi) in self.store.extents().items()}
        rows = []
        for e in (e for m in messages if m for e in m.entries):
            row = dict.fromkeys(segments.MANIFEST.names) | e | {"batch": batch}
            if e["kind"] == "data":
                key = (e["topic"], e["partition"])
                base = ends.get(key, 0)
                ends[key] = base + e["rows"]
                row |= {"base": base, "first_offset": base, "last_offset": base + e["rows"] - 1}
            rows.append(row)
        table = pa.Table.from_pylist(rows, segments.MANIFEST)
        errors.recover(lambda: self.store.put(table, entry), self.generations, self.backoff)

    def _undo(self, messages, batch: str) -> None:
        if self.transactional:
            self.store.delete(self._names(messages))
        else:
            self._publish(messages, f"{batch}-broken-{uuid.uuid4().hex}")


class BatchWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages):
        self._publish(messages, f"{self.writer}-{self.options.get('batch') or uuid.uuid4().hex}")

    def abort(self, messages):
        self._undo(messages, self.writer)


class StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId):
        self._publish(messages, f"{self.writer}-{batchId}")

    def abort(self, messages, batchId):
        self._undo(messages, f"{self.writer}-{batchId}")


class TidemarkLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark"

    def schema(self) -> str:
        return f"{SCHEMA}, before long" if self.options.get("together") else SCHEMA

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self.options)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options)


def register(spark) -> None:
    spark.dataSource.register(TidemarkLog)
