import json
import time

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import queries as Q
from tidemark.operators import metrics, offsets, sink
from tidemark.plans.spec import ConsumerSpec, SinkSpec, SpecError, StartPosition
from tidemark.sources import datasource, segments
from tidemark.sources import log as logs
from tidemark.streaming import errors
from tidemark.streaming.writer import LogWriter

KEY = ["topic", "partition", "offset"]


def keys(df):
    return sorted(map(tuple, df.select(*KEY).collect()))


@pytest.fixture(scope="module")
def log(spark, sf, tmp_path_factory):
    """The log in two writes, as segments."""
    path = f"file://{tmp_path_factory.mktemp('segments')}/log"
    df = Q.events_log(spark, sf).persist()
    segments.append(df.where("offset < 20"), path, "a")
    segments.append(df.where("offset >= 20"), path, "b")
    segments.append(df.where("offset >= 20"), path, "b")  # a write that runs again
    datasource.register(spark)
    return df, path


STARTS = {
    "beginning": {"start": "beginning"}, "end": {"start": "end"}, "default": {"reset": "earliest"}, "default at the end": {},
    "time": {"start": "time", "startTime": str(Q.START_TIME)}, "offsets": {"start": "offset", "partitions": "0,2", "startOffsets": "10,25"}, "sentinels": {"start": "offset", "partitions": "0,1,2", "startOffsets": "-1,-2,-3", "reset": "earliest"},
}


@pytest.mark.parametrize("name", STARTS)
def test_start_positions_of_the_source(spark, log, name):
    """The source starts where the positions of the whole log say, without reading it."""
    df, path = log
    options = {"path": path, "topics": "click", "isolation": "read_uncommitted", **STARTS[name]}
    spec = datasource.spec_of(options)
    want = offsets.from_positions(logs.subscribed(df, spec), offsets.start_positions(df, spec))
    assert keys(spark.read.format("tidemark").options(**options).load()) == keys(want)


def test_records_are_those_of_the_log(spark, log):
    df, path = log
    options = {"path": path, "pattern": ".*", "start": "beginning"}
    same = lambda a, b: a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert same(spark.read.format("tidemark").options(**options, isolation="read_uncommitted").load(), df)
    assert same(spark.read.format("tidemark").options(**options).load(), logs.visible(df)) and same(segments.read(spark, path), df)
    assert keys(segments.extents(spark, path).withColumnRenamed("log_end", "offset")) == keys(logs.extents(df).withColumnRenamed("log_end", "offset"))


def test_a_start_by_time_reads_one_segment_of_a_partition(spark, log):
    df, path = log
    spec = ConsumerSpec(topics="click,view", start_position=StartPosition.TIME, start_time=Q.START_TIME, isolation="read_uncommitted")
    got = segments.start_positions(spark, path, spec)
    want = offsets.start_positions(df, spec)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    found = segments.time_positions(spark, path, Q.START_TIME)
    per = segments.manifest(spark, path).groupBy("topic", "partition").count()
    assert per.agg(F.max("count")).first()[0] == 2
    assert found.count() == 15
    files = [f for f in found.inputFiles() if "/data/" in f]
    assert len(files) == len(set(files)) == 15
    with pytest.raises(SpecError):
        datasource.spec_of({"path": path, "start": "time", "topics": "a"})


def follow(spark, path, home, sink_path, **options):
    """Read a stream to its end now; returns the batches' sizes and all rows."""
    spark.createDataFrame([], "topic string, partition int, offset long").write.mode("overwrite").parquet(f"{sink_path}/batch=-1")
    q = spark.readStream.format("tidemark").options(path=path, home=f"{home}/reader", isolation="read_uncommitted", **options).load()
    q = q.withColumn("batch", F.lit(0)).writeStream.foreachBatch(lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{sink_path}/batch={i}")).option("checkpointLocation", f"{home}/checkpoint").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.schema("topic string, partition int, offset long, batch int").parquet(sink_path)
    return dict(sorted((r.batch, r["count"]) for r in rows.groupBy("batch").count().collect())), rows


def test_a_stream_goes_on_by_offsets(spark, sf, tmp_path):
    """At most so many records a batch; a restart goes on; partitions that come up are read from their beginning; the start is kept."""
    df, path = Q.events_log(spark, sf), f"file://{tmp_path}/log"
    old = "topic in ('click', 'view') and offset < 9 and partition < 2"
    segments.append(df.where(old), path)
    args = {"topics": "click,view", "start": "beginning", "maxRecords": "10"}
    sizes, rows = follow(spark, path, f"{tmp_path}/home", f"{tmp_path}/out", **args)
    assert max(sizes.values()) <= 10 and keys(rows) == keys(df.where(old))
    segments.append(df.where(f"topic in ('click', 'view') and offset < 15 and not ({old})"), path)
    sizes, rows = follow(spark, path, f"{tmp_path}/home", f"{tmp_path}/out", **args)
    assert max(sizes.values()) <= 10 and keys(rows) == keys(df.where("topic in ('click', 'view') and offset < 15"))
    initial = json.load(open(f"{tmp_path}/home/reader/initial.json"))
    assert set(initial["click"]) == {"0", "1"} and set(initial["click"].values()) == {0}


def test_a_stream_from_the_end(spark, sf, tmp_path):
    df, path = Q.events_log(spark, sf), f"file://{tmp_path}/log"
    segments.append(df.where("offset < 9"), path)
    args = {"pattern": "(click|view)", "start": "end"}
    sizes, _ = follow(spark, path, f"{tmp_path}/home", f"{tmp_path}/out", **args)
    assert sizes == {}
    segments.append(df.where("offset >= 9"), path)
    _, rows = follow(spark, path, f"{tmp_path}/home", f"{tmp_path}/out", **args)
    assert keys(rows) == keys(df.where("topic in ('click', 'view') and offset >= 9"))


def test_regions_are_whole(spark, sf, tmp_path):
    """Writes of 70 records, regions of 100: every batch has exactly 100, whatever was there when, also after a batch broke off."""
    df, path = Q.events_log(spark, sf).where("topic = 'click'").persist(), f"file://{tmp_path}/log"
    order = offsets.arrival_numbers(df)
    for k in range(3):
        segments.append(order.where(f"arrival >= {70 * k} and arrival < {70 * (k + 1)}"), path)
        sizes = {}
        if k:
            sizes, rows = follow(spark, path, f"{tmp_path}/home", f"{tmp_path}/out", topics="click", start="beginning", region="100")
            assert set(sizes.values()) == {100} and len(sizes) == (70 * (k + 1)) // 100
    assert rows.distinct().count() == 200
    with pytest.raises(SpecError):
        datasource.StreamReader({"path": path, "topics": "click", "region": "5"})


def test_batches_side_by_side(spark, sf, tmp_path):
    """Up to three regions or batches come in one micro-batch; their records tell them apart, also after a restart, a partition that came up and a replay."""
    datasource.register(spark)
    order = offsets.arrival_numbers(Q.events_log(spark, sf).where("topic = 'click'").persist())
    schema = "topic string, partition int, offset long, before long, batch int"
    for name, args in {"region": {"region": "20"}, "most": {"maxRecords": "20"}}.items():
        path, home, out = f"file://{tmp_path}/{name}-log", f"{tmp_path}/{name}-home", f"{tmp_path}/{name}-out"
        for k, where in enumerate(("partition < 2 and arrival < 90", "partition = 2 or arrival >= 90")):
            segments.append(order.where(where), path)
            sizes, _ = follow(spark, path, home, out, topics="click", start="beginning", together="3", **args)
            rows = spark.read.schema(schema).parquet(out)
            n = order.where("partition < 2 and arrival < 90" if not k else "true").count()
            want = n - n % 20 if name == "region" else n
            each = {r.before: r["count"] for r in rows.groupBy("before").count().collect()}
            assert rows.select("partition", "offset").distinct().count() == rows.count() == want
            assert max(sizes.values()) == 60 and len(sizes) < len(each)
            at = 0
            for before in sorted(each):  # without a gap, and none holds more
                assert before == at and each[before] <= 20 and (name == "most" or each[before] == 20)
                at += each[before]
            # Within a partition no batch is ahead of an earlier one.
            ordered = rows.orderBy("partition", "offset").collect()
            assert all(a.partition != b.partition or (a.before <= b.before and a.offset + 1 == b.offset) for a, b in zip(ordered, ordered[1:], strict=False))
        reader = datasource.StreamReader({"path": path, "home": f"{home}/reader", "topics": "click", "start": "beginning", "together": "3", **args})
        start = reader.kept("initial")
        end = datasource.admitted(reader._placed(start, [("click", p) for p in range(3)]), {k: hi for k, (_, hi) in reader.store.extents().items()}, 60)
        plans = [reader.partitions(datasource.nested(start), datasource.nested(end)) for _ in range(2)]
        assert plans[0] == plans[1] and sum(b.num_rows for s in plans[0] for b in reader.read(s)) == 60
    for kind in (datasource.StreamReader, datasource.BatchReader):
        with pytest.raises(SpecError):
            kind({"path": path, "topics": "click", "together": "3"})


def test_files_hold_runs_of_offsets(spark, sf, tmp_path, monkeypatch):
    """Files of a write don't overlap, so a micro-batch opens only those that hold its records."""
    monkeypatch.setattr(segments, "RUN", 16)
    df, path = Q.events_log(spark, sf), f"file://{tmp_path}/log"
    segments.append(df.repartition(5), path)
    found = segments.Store(path).manifest().to_pylist()
    assert all(s["last_offset"] - s["first_offset"] < 16 for s in found)
    assert all((a["topic"], a["partition"]) != (b["topic"], b["partition"]) or a["last_offset"] + 1 == b["first_offset"] for a, b in zip(found, found[1:], strict=False))
    assert keys(segments.read(spark, path)) == keys(df)


@given(st.dictionaries(st.tuples(st.sampled_from("ab"), st.integers(0, 3)), st.tuples(st.integers(0, 50), st.integers(0, 90)), max_size=6), st.integers(1, 80), st.booleans())
@settings(max_examples=300, deadline=None)
def test_admission_by_records(parts, most, exact):
    start, end = {k: a for k, (a, _) in parts.items()}, {k: z for k, (_, z) in parts.items()}
    upto = datasource.admitted(start, end, most, exact)
    total = sum(max(end[k] - start[k], 0) for k in end)
    n = sum(upto[k] - start[k] for k in end)
    assert n == (most if total >= most else 0 if exact else total) and all(start[k] <= upto[k] <= max(end[k], start[k]) for k in end)


# --- writing ----------------------------------------------------------------------

ROWS = "event_id long, topic string, key int, message string, partition int, messageTimestamp long"


def table(spark, *parts):
    return spark.createDataFrame(list(parts), "topic string, n_partitions int")


@pytest.mark.parametrize("topics", [None, ["a", "unknown"]])
def test_every_row_has_a_verdict(spark, tmp_path, topics):
    """Null, unknown and empty topics, null keys and values, partitions out of range: written and failed together are all rows and topics."""
    rows = [(0, "a", 1, "m", None, 5), (1, "b", None, "m", None, 5), (2, "a", None, None, None, 7), (3, "a", None, None, None, None), (4, None, 1, "m", None, 5), (5, "", 1, "m", None, 5), (6, "unknown", 1, "m", 0, 5), (7, "a", 1, "m", 2, 5), (8, "a", 1, "m", -1, 5), (9, "b", 1, "m", 4, 5), (10, "a", None, None, 1, 5)]
    df = spark.createDataFrame(rows, ROWS)
    spec = SinkSpec(topics=topics, errors_only=False)
    v = sink.verdicts(df, spec, table(spark, ("a", 2), ("b", 5)), keep=["event_id"])
    n = len(topics or [1])
    assert v.count() == len(rows) * n == sink.produce(df, spec, table(spark, ("a", 2), ("b", 5))).count() + v.where("failure is not null").count()
    bad = {r.event_id for r in v.where("failure is not null").collect()}
    if topics is None:
        assert bad == {4, 5, 6, 7, 8}
        assert {r.partition for r in v.where("event_id in (2, 3)").collect()} <= {0, 1}
    w = LogWriter(spark, spec, f"file://{tmp_path}/w", table(spark, ("a", 2), ("b", 5)))
    w.write(df, 0)
    told = w.status()
    assert told.count() == len(rows) and {r.inTuple.event_id for r in told.where("failureDescription is not null").collect()} == bad
    assert w.log().count() == v.where("failure is null").count() if not w.log().isEmpty() else v.where("failure is null").isEmpty()
    counters = {(r.topic, r.name): r.value for r in w.counters().collect()}
    assert counters[None, "nFailedTuples"] == len(bad)


def test_a_batch_is_written_once(spark, tmp_path):
    """Offsets go on from batch to batch; a batch that runs again adds nothing; order within tasks is kept."""
    w = LogWriter(spark, SinkSpec(transactional=True, flush=4), f"file://{tmp_path}/w", 2)
    rows = spark.createDataFrame([(i, "ab"[i % 2], i % 5, f"m{i:02}", None, 1000 + i) for i in range(30)], ROWS).coalesce(1)
    for batch in (0, 0, 1):
        w.write(rows, batch)
    log = w.log()
    assert log.count() == 60 == log.select(*KEY).distinct().count() and {r.txn_state for r in log.collect()} == {"committed"}
    ends = {(r.topic, r.partition): r.log_end for r in segments.extents(spark, w.home).collect()}
    assert sum(ends.values()) == 60
    for r in log.groupBy("topic", "partition").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("x")).collect():
        values = [bytes(x.value) for x in r.x]
        assert values == sorted(values[: len(values) // 2]) * 2
    files = [s for s in segments.Store(w.home).manifest().to_pylist()]
    assert max(s["rows"] for s in files) <= 4  # no more than the records that a task holds


def broken_source():
    """A source whose writers break; local, so that workers get it by value."""

    class Broken(datasource._Writing):
        """Puts that fail as files in a folder say, a file for each time; they are counted there too."""

        def put(self, data, name):
            import glob
            import os
            import uuid

            where = self.options["broken"]
            open(f"{where}/try-{uuid.uuid4().hex}", "w").close()
            for f in sorted(glob.glob(f"{where}/fail-*")):
                kind = f.rsplit("-", 1)[1]
                os.remove(f)
                raise {"time": TimeoutError, "value": ValueError}[kind]("injected")
            super().put(data, name)

    class BrokenBatch(Broken, datasource.BatchWriter):
        pass

    class BrokenStream(Broken, datasource.StreamWriter):
        pass

    class BrokenLog(datasource.TidemarkLog):
        @classmethod
        def name(cls):
            return "broken"

        def writer(self, schema, overwrite):
            return BrokenBatch(self.options)

        def streamWriter(self, schema, overwrite):
            return BrokenStream(self.options)

    return BrokenLog


class BrokenWriter(LogWriter):
    def _options(self):
        return super()._options() | {"broken": self.broken}


@pytest.mark.parametrize(("kinds", "tries", "lost"), [(["time"], 2, 0), (["time", "time"], 3, 0), (["time"] * 3, 3, 6), (["value"], 1, 6)])
def test_failures_are_recovered_by_their_class(spark, tmp_path, kinds, tries, lost):
    """What can be retried is, up to three tries; the rest fails at once. Failed rows are told once, finished files aren't written again."""
    (tmp_path / "broken").mkdir()
    w = BrokenWriter(spark, SinkSpec(topics="a"), f"file://{tmp_path}/w", backoff=0.01, source=broken_source())
    w.broken = str(tmp_path / "broken")
    rows = spark.createDataFrame([(i, "a", i, f"m{i}", None, i) for i in range(6)], ROWS).coalesce(1)
    for i, kind in enumerate(kinds):
        (tmp_path / f"broken/fail-{i}-{kind}").touch()
    w.write(rows, 0)
    assert len(list((tmp_path / "broken").glob("try-*"))) == tries
    c = {(r.topic, r.name): r.value for r in w.counters().collect()}
    assert c["a", "nSent"] == 6 - lost and c["a", "nLost"] == lost and c[None, "nFailedTuples"] == lost
    if lost:
        told = [json.loads(r.failureDescription) for r in w.status().collect()]
        assert len(told) == 6 and {t["lastExceptionType"] for t in told} == {"ValueError" if kinds == ["value"] else "TimeoutError"} and told[0]["failedTopics"] == ["a"]
    else:
        assert w.log().count() == 6


def test_back_off(monkeypatch):
    waits, seen = [], []

    def action():
        raise TimeoutError

    with pytest.raises(TimeoutError):
        errors.recover(action, 4, 5.0, sleep=waits.append, failed=seen.append)
    assert waits == [5.0, 10.0, 20.0] and len(seen) == 4
    with pytest.raises(ValueError):
        errors.recover(lambda: int("x"), 4, 5.0, sleep=waits.append)
    assert len(waits) == 3 and errors.category(ValueError(), in_region=True, has_status=False) == "RECOVER" and errors.category(PermissionError()) == "FINAL"


def test_a_stream_that_dies_before_its_commit(spark, sf, tmp_path):
    """Tasks have written, the commit fails, the query ends; the replay writes each row once and leaves no other segments."""
    e = Q.rows_to_write(spark, sf)
    e.repartition(3).write.parquet(str(tmp_path / "in"))

    def dying():
        class Dying(datasource.StreamWriter):
            def commit(self, messages, batchId):
                raise RuntimeError("died")

        class DyingLog(datasource.TidemarkLog):
            @classmethod
            def name(cls):
                return "dying"

            def streamWriter(self, schema, overwrite):
                return Dying(self.options)

        return DyingLog

    def stream():
        return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    spec, home = SinkSpec(transactional=True), f"file://{tmp_path}/w"
    q = LogWriter(spark, spec, home, 3, source=dying()).start(stream())
    with pytest.raises(Exception, match="died"):
        q.awaitTermination(120)
    assert segments.Store(home).manifest().num_rows == 0
    w = LogWriter(spark, spec, home, 3)
    q = w.start(stream())
    q.awaitTermination(120)
    assert q.exception() is None
    log = w.log()
    assert log.count() == e.count() == log.select(*KEY).distinct().count()
    ids = log.select(F.col("value").cast("string").alias("v")).groupBy("v").count()
    assert ids.exceptAll(e.select(F.col("message").alias("v")).groupBy("v").count()).isEmpty()
    # What the data source wrote is read by it, as a stream, too.
    _, rows = follow(spark, home, f"{tmp_path}/home", f"{tmp_path}/out", pattern=".*", start="beginning")
    assert keys(rows) == keys(log)


def test_abort_of_a_writer_without_transactions(tmp_path):
    """What finished tasks have written stays; a transactional writer takes it back."""
    def task(transactional):
        w = datasource.BatchWriter({"path": f"{tmp_path}/{transactional}", "transactional": str(transactional)})
        records = pa.array([[{"topic": "a", "partition": 0, "timestamp_ms": 1, "key": b"k", "value": b"v", "failure": None, "reason": None}]], pa.list_(pa.struct([("topic", pa.string()), ("partition", pa.int32()), ("timestamp_ms", pa.int64()), ("key", pa.binary()), ("value", pa.binary()), ("failure", pa.string()), ("reason", pa.string())])))
        return w, w.write(iter([pa.RecordBatch.from_arrays([pa.array([{"x": 1}]), records], ["row", "records"])]))

    w, message = task(True)
    w.abort([message, None])
    assert w.store.files("data") == [] and w.store.manifest().num_rows == 0
    w, message = task(False)
    w.abort([message, None])
    assert w.store.extents() == {("a", 0): (0, 1)}


def test_measures_of_a_running_writer(spark, sf, tmp_path):
    """Totals by topic as the plan observes them, each failure once; rates fade; sizes and latencies have mean and maximum."""
    e = Q.rows_to_write(spark, sf).withColumn("partition", F.when(F.col("event_id") % 10 == 0, 7).cast("int"))
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    seen = metrics.Measures()
    spark.streams.addListener(seen)
    try:
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        w = LogWriter(spark, SinkSpec(), f"file://{tmp_path}/w", 3, measured=Q.ALL_TOPICS)
        q = w.start(stream)
        q.awaitTermination(120)
        want = {f"{r.topic}:record-send-total": r["count"] for r in w.log().groupBy("topic").count().collect()}
        for _ in range(50):
            if {k: seen.totals.get(k) for k in want} == want:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    values = seen.values()
    assert {k: values[k] for k in want} == want and len(want) == 5
    assert sum(v for k, v in values.items() if k.endswith("record-error-total")) == e.where("event_id % 10 = 0").count() == w.status().count()
    assert values["batch-size-max"] >= values["batch-size-avg"] > 0 and "commit-latency-max" in values and values["click:byte-rate"] > 0


def test_rates_fade():
    m = metrics.Measures(fade_s=10)
    m.add(0, {"a:record-send-total": 100})
    assert m.rates["a:record-send-rate"] == 10 and m.totals["a:record-send-total"] == 100
    m.add(10, {"a:record-send-total": 0})
    assert abs(m.rates["a:record-send-rate"] - 10 / 2.718281828) < 1e-6
    for t in range(11, 200):
        m.add(t, {"a:record-send-total": 5})
    assert abs(m.rates["a:record-send-rate"] - 5) < 0.3  # five a second
