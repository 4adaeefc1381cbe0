"""The log queries against their SQL, specs, properties and round trips."""

import json
import math
import time
import warnings

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import queries as Q
from tidemark.functions import control_messages, serde
from tidemark.operators import assign, control, metrics, offsets, sink
from tidemark.plans import props
from tidemark.plans.spec import Commit, ConsumerSpec, Region, SinkSpec, SpecError, StartPosition, check_group, check_status_schema
from tidemark.sources import log as logs
from tidemark.sources import reader

TABLES = ["events", "conversations"]


def rows(values):
    return sorted(repr(tuple(v)) for v in values)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_equals_sql(spark, sf, name):
    got = Q.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    rel = con.sql(Q.ORACLES[name])
    assert sorted(got.columns) == sorted(rel.columns)
    order = sorted(got.columns)
    assert rows(got.select(*order).collect()) == rows(con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in order)} from rel").fetchall())


def bad(**args):
    with pytest.raises(SpecError):
        ConsumerSpec(**args)


def test_consumer_checks():
    bad()
    control_schema = T.StructType([T.StructField("json", T.StringType())])
    bad(control=control_schema, topics="a")
    bad(control=T.StructType([T.StructField("n", T.IntegerType())]))
    bad(pattern="a", partitions=[0])
    bad(pattern="a", topics="b")
    bad(topics="a", start_position=StartPosition.END, start_position_str="end")
    bad(topics="a", start_offsets=[1])
    bad(topics="a", commit_count=5, commit_period=1.0)
    bad(topics="a", region=Region.OPERATOR_DRIVEN)
    bad(topics="a", region=Region.OPERATOR_DRIVEN, trigger_count=0)
    bad(topics="a", start_position_str="time")
    bad(topics="a", partitions=[0], start_position_str="offset")
    bad(topics="a", partitions=[0, 1], start_position_str="offset", start_offsets=[1])
    bad(topics="a,b", partitions=[0], start_position_str="offset", start_offsets=[1])
    bad(pattern="a", start_position_str="offset")
    bad(pattern="a", legacy_groups=True)
    bad(topics="a", commit_count=0)
    bad(topics="a", message_type="decimal")
    bad(topics="a", start_position_str="nowhere")
    bad(topics="a", start_position=StartPosition.END, has_offset_store=False)
    assert ConsumerSpec(topics="a", commit_period=0.01).commit_period == 0.1
    assert ConsumerSpec(topics="a").commit_period == 5.0 and ConsumerSpec(topics="a").commit is Commit.TIME
    assert ConsumerSpec(topics="a", commit_count=9).commit is Commit.COUNT
    assert ConsumerSpec(topics=["a, b", "c,"]).topics == ["a", "b", "c"]
    assert ConsumerSpec(control=control_schema).client == "dummy"
    assert ConsumerSpec(topics="a").client == "group" and ConsumerSpec(topics="a", partitions=[0]).client == "static"
    assert ConsumerSpec(topics="a", region=Region.PERIODIC).client == "region-group" and ConsumerSpec(topics="a", region=Region.PERIODIC).commit is Commit.DRAIN
    with pytest.warns(UserWarning):
        assert StartPosition.of("oldest") is StartPosition.END
    spec = ConsumerSpec(topics="a")
    assert spec.bind(["message", "key", "other"]) == {"message": "message", "key": "key"}
    for args in ({"columns": ["key"]}, {"columns": ["message"], "named": {"key": "nokey"}}):
        with pytest.raises(SpecError):
            spec.bind(**args)


def test_sink_checks(spark):
    s = lambda text: T._parse_datatype_string(text)
    assert SinkSpec().bind(s("topic string, message int, key double, partition int, messageTimestamp long")) == {"topic": "topic", "message": "message", "key": "key", "partition": "partition", "timestamp_ms": "messageTimestamp"}
    for spec, schema in ((SinkSpec(), "message string"), (SinkSpec(), "topic int, message string"), (SinkSpec("t"), "m string"), (SinkSpec("t"), "message array<int>"), (SinkSpec("t"), "message string, partition long"), (SinkSpec("t", key_column="k"), "message string"), (SinkSpec("t"), "message string, key boolean")):
        with pytest.raises(SpecError):
            spec.bind(s(schema))
    with pytest.raises(SpecError):
        SinkSpec("t", starts_region=True)
    inner = s("a int")
    check_status_schema(s("t struct<a:int>, f string"), inner)
    for text in ("t struct<a:int>, f string, g string", "t struct<b:int>", "f string, g string", "n int"):
        with pytest.raises(SpecError):
            check_status_schema(s(text), inner)


def test_properties(tmp_path):
    (tmp_path / "p").write_text("# c\nbootstrap.servers = a:1\nx: {applicationDir}/y\nlong=a\\\n b\n\n")
    file = props.read_properties("p", str(tmp_path))
    assert file == {"bootstrap.servers": "a:1", "x": "{applicationDir}/y", "long": "ab"}
    assert props.expand(file, "/app")["x"] == "/app/y"
    with pytest.warns(UserWarning):
        assert props.read_properties("none", str(tmp_path)) == {}
    assert props.merge({"a": "1"}, {"a": "2", "b": "3"}, {"b": 4, "c": None}) == {"a": "1", "b": "4"}
    assert props.java_hash("hello") == 99162322 and props.java_hash("polygenelubricants") == -2147483648 and props.java_hash("") == 0
    assert props.group_id("hello", 7, "hello") == "iP99162322-j7-oP99162322"
    assert props.client_id(True, 3, "op") == "C-J3-op" and props.client_id(False, 3, "op", "me", 2) == "me-2"
    c = props.consumer_properties({})
    assert (c["max.poll.interval.ms"], c["session.timeout.ms"], c["request.timeout.ms"], c["metadata.max.age.ms"], c["enable.auto.commit"], c["isolation.level"]) == ("300000", "20000", "25000", "2000", "false", "read_committed")
    c = props.consumer_properties({"group.instance.id": "x", "session.timeout.ms": "90000", "metadata.max.age.ms": "100"}, region=True, reset_ms=180_000, drain_ms=60_000)
    assert (c["max.poll.interval.ms"], c["session.timeout.ms"], c["request.timeout.ms"], c["metadata.max.age.ms"]) == ("540000", "90000", "25000", "100")
    assert props.consumer_properties({"group.instance.id": "x"}, region=True, reset_ms=180_000)["session.timeout.ms"] == "216000"
    p = props.producer_properties({"acks": "1", "retries": "0", "max.in.flight.requests.per.connection": "9"}, True)
    assert (p["acks"], p["retries"], p["max.in.flight.requests.per.connection"], p["linger.ms"], p["batch.size"]) == ("all", "1", "5", "100", "32768")
    assert props.producer_properties({})["max.in.flight.requests.per.connection"] == "10"
    assert props.assignor({}, region=False, single_topic=True) == {} and props.assignor({}, region=True, single_topic=True)["partition.assignment.strategy"] == props.RANGE
    assert props.assignor({"partition.assignment.strategy": props.COOPERATIVE[0]}, region=True, single_topic=False)["partition.assignment.strategy"] == props.ROUND_ROBIN
    assert props.transaction_timeout_ms(10_000) == 130_000 and props.transaction_timeout_ms(10**7) == 900_000
    o = props.reader_options({"a": "1", "group.id": "g", "enable.auto.commit": "false"}, topics=["t"], starting={"t": {0: -2}})
    assert o == {"kafka.a": "1", "kafka.group.id": "g", "subscribe": "t", "startingOffsets": '{"t": {"0": -2}}'}


@given(st.text(max_size=20))
def test_control_text_escapes(topic):
    assert json.loads(control_messages.text("ADD", topics=[topic])) == {"action": "ADD", "topics": [{"topic": topic}]}


VALUES = {
    "string": ["", "ä😀", "x" * 500], "int32": [0, -1, 2**31 - 1, -(2**31)], "int64": [0, -2, 2**63 - 1, -(2**63)], "uint32": [0, 2**32 - 1],
    "float32": [0.0, 10.5, -math.inf], "float64": [10.1, -0.0, 1e300], "blob": [b"", b"\x00\xff"],
}
SQL = {"string": "string", "int32": "int", "int64": "long", "uint32": "long", "float32": "float", "float64": "double", "blob": "binary"}


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_serde_round_trip(spark, kind):
    df = spark.createDataFrame([(v,) for v in [*VALUES[kind], None]], f"v {SQL[kind]}")
    raw = df.select("v", serde.encode(F.col("v"), kind).alias("raw"))
    got = [(r.v, r.w) for r in raw.select("v", serde.decode(F.col("raw"), kind).alias("w")).collect()]
    assert all(a == b for a, b in got) and len(got) == len(VALUES[kind]) + 1
    if kind not in ("string", "blob"):
        cut = spark.createDataFrame([(b"abc",), (b"abcdefghi",), (None,)], "raw binary")
        assert all(r[0] is None for r in cut.select(serde.decode(F.col("raw"), kind)).collect())
    missing = spark.createDataFrame([(None,)], f"v {SQL[kind]}").select(serde.or_default(F.col("v"), kind).alias("v")).first().v
    assert missing == serde.DEFAULTS[kind]


@pytest.mark.parametrize("kind,sql", [("float32", "float"), ("float64", "double")])
def test_float_values_that_are_no_numbers(spark, kind, sql):
    """NaN and the infinities are values, null is none; through the reader nothing of them is dropped."""
    df = spark.createDataFrame([(0, float("nan")), (1, None), (2, float("inf")), (3, float("-inf")), (4, -0.0)], f"i int, v {sql}").repartition(1)
    back = df.select("i", serde.decode(serde.encode(F.col("v"), kind), kind).alias("w")).orderBy("i").collect()
    assert math.isnan(back[0].w) and back[1].w is None and [r.w for r in back[2:4]] == [float("inf"), float("-inf")] and math.copysign(1, back[4].w) == -1
    log = df.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("i").cast("long").alias("offset"), F.lit(0).cast("long").alias("timestamp_ms"), F.lit(None).cast("binary").alias("key"), serde.encode(F.col("v"), kind).alias("value"), F.lit(None).cast("string").alias("txn_id"), F.lit(None).cast("string").alias("txn_state"))
    assert reader.read(log, ConsumerSpec(topics="t", start_position=StartPosition.BEGINNING, message_type=kind)).count() == 4
    assert df.limit(0).select(serde.decode(serde.encode(F.col("v"), kind), kind)).count() == 0


def test_malformed_text_is_replaced(spark):
    assert spark.createDataFrame([(b"\xffA",)], "v binary").select(serde.decode(F.col("v"), "string")).first()[0] == "�A"


def test_empty_log(spark):
    empty = spark.createDataFrame([], logs.SCHEMA)
    spec = ConsumerSpec(topics="a", start_position=StartPosition.BEGINNING)
    assert reader.read(empty, spec).count() == 0 and offsets.next_offsets(empty).count() == 0
    with pytest.raises(logs.UnknownTopic):
        logs.assigned(empty, spec)


def test_log_round_trip_and_pruning(spark, tmp_path, sf):
    log = Q.events_log(spark, sf)
    logs.write(log, str(tmp_path / "log"))
    back = logs.read(spark, str(tmp_path / "log"))
    assert rows(back.collect()) == rows(log.collect())
    plan = logs.subscribed(back, ConsumerSpec(topics="click", partitions=[1])).where("offset >= 5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(offset,5)" in plan


def test_offsets_in_buckets_equal_plain_ones(spark, sf):
    e = Q.events(spark, sf)
    make = lambda b: logs.from_table(e, topic=F.lit("t"), partition=F.lit(0), order_by=F.col("event_id"), timestamp_ms=F.col("ms"), key=F.col("props").cast("binary"), value=serde.encode(F.col("event_id"), "int64"), bucket=b)
    assert rows(make(None).select("offset", "value").collect()) == rows(make(F.floor(F.col("event_id") / 37)).select("offset", "value").collect())


def test_control_errors(spark):
    texts = ["", "null", "[1]", "{}", '{"action":"ADD"}', '{"action":"x","topics":[]}', '{"action":"remove","topics":[{"topic":"a"},{"topic":"a"}]}', '{"action":"ADD","topicPartitionOffsets":[{"topic":"a","partition":"zero"}]}',
             '{"action":"ADD","topicPartitionOffsets":[{"topic":"a","partition":1,"offset":-2},{"topic":"a","partition":1,"offset":7}]}', None]
    got = {r.seq: r for r in control.parse(spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "consumer long, seq int, json string")).collect()}
    assert [got[i].error is not None for i in range(len(texts))] == [True, True, True, True, False, True, False, True, False, True]
    assert got[4].kind == "NONE" and got[6].topics == ["a"]
    folded = control.assignments(control.accept(control.parse(spark.createDataFrame([(1, 8, texts[8])], "consumer long, seq int, json string")))).collect()
    assert [tuple(r) for r in folded] == [(1, "a", 1, 7)]


def test_sample_sequences(spark):
    """Dynamic assignment that ends empty, and dynamic subscription that ends with one topic."""
    m = control_messages.text
    assign_ = [m("ADD", partitions=[("t1", 0, 40)]), m("ADD", partitions=[("t1", 1, -2), ("t2", 1, 40)]), m("REMOVE", partitions=[("t2", 1)]), m("REMOVE", partitions=[("t1", 0), ("t1", 1)])]
    sub = [m("ADD", topics=["t1"]), m("ADD", topics=["t2"]), m("REMOVE", topics=["t1", "t2"]), m("ADD", topics=["t2"])]
    rows_ = [(1, i, t) for i, t in enumerate(assign_)] + [(2, i, t) for i, t in enumerate(sub)]
    acc = control.accept(control.parse(spark.createDataFrame(rows_, "consumer long, seq int, json string")))
    assert control.assignments(acc).count() == 0 and [tuple(r) for r in control.subscriptions(acc).collect()] == [(2, "t2")]


def test_partitions_by_key_fixture(spark):
    df = spark.createDataFrame([(i % 3, "ABC"[i % 3] + str(i)) for i in range(9)], "key int, message string")
    out = sink.produce(df, SinkSpec("test"), 3, sink.by_integer_key)
    assert {(r.partition, bytes(r.value).decode()) for r in out.collect()} == {(i % 3, "ABC"[i % 3] + str(i)) for i in range(9)}
    own = sink.produce(df.withColumn("partition", F.lit(1)), SinkSpec("test"), 3, sink.by_integer_key)
    assert {r.partition for r in own.collect()} == {1}


def test_observed_counters(spark):
    df, seen = metrics.observed(spark.createDataFrame([("a",), (None,), ("b",)], "message string"))
    df.count()
    assert seen.get == {"nSubmitted": 3, "nDroppedMalformedMessages": 1}


def test_member_ids():
    made = props.with_member_id({"a": "1"}, True, True, "inst", "op")
    assert made == {"a": "1", "group.instance.id": props.group_instance_id("inst", "op")}
    assert props.with_member_id({"group.instance.id": "mine"}, True, True, "inst", "op") == {"group.instance.id": "mine"}
    assert props.with_member_id({"group.instance.id": "mine"}, True, False, "inst", "op") == {} == props.with_member_id({}, False, True, "inst", "op")


def test_reader_counters(spark):
    at = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("b", 0, 5)], "topic string, partition int, offset long")
    assert {r.name: r.value for r in metrics.reader_counters(at, True).collect()} == {"nAssignedPartitions": 3, "nConsumedTopics": 2, "isGroupManagementActive": 1}


def test_progress_log(spark, tmp_path):
    """Batches of a running query with their rows and the longest time so far."""
    log = metrics.ProgressLog()
    spark.streams.addListener(log)
    try:
        spark.range(7).write.parquet(str(tmp_path / "in"))
        q = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination(60)
        for _ in range(50):
            if log.rows:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert sum(r["rows"] for r in log.rows) == 7 and log.longest_ms == max(r["ms"] for r in log.rows) == log.rows[-1]["longest_ms"]


def test_every_partition_has_one_member(spark):
    log = spark.createDataFrame([(t, p, 10 * p) for t in "abc" for p in range(7)] * 2, "topic string, partition int, timestamp_ms long")
    for n in (1, 3, 10):
        for how in (assign.by_hash(n), assign.by_range(n, 7)):
            got = assign.load(log, how).collect()
            assert sum(r.n_partitions for r in got) == 21 and sum(r.n_records for r in got) == 42 and {r.member for r in got} <= set(range(n))
    assert {(r.before, r.after) for r in assign.moved(log, assign.by_range(7, 7), assign.by_range(1, 7)).collect()} == {(p, 0) for p in range(7)}


def test_assignment_names_the_reader_of_every_partition(spark):
    """Against both deals written out, with topics whose partitions don't divide by the readers and more readers than partitions."""
    parts = [(t, p) for t, n in (("a", 7), ("b", 1), ("c", 4)) for p in range(n)]
    log = spark.createDataFrame([(t, p, 10 * p + x) for t, p in parts for x in range(p + 1)], "topic string, partition int, timestamp_ms long")
    for n in (1, 3, 10):
        turn = {k: f"m{i % n}" for i, k in enumerate(parts)}
        runs = {}
        for t in "abc":
            mine, at = [k for k in parts if k[0] == t], 0
            for m in range(n):
                size = len(mine) // n + (m < len(mine) % n)
                runs |= {k: f"m{m}" for k in mine[at : at + size]}
                at += size
        for how, want in ((assign.in_turn(n), turn), (assign.in_runs(n), runs)):
            got = assign.assignment(log, how).collect()
            assert {(r.topic, r.partition): r.member for r in got} == want and len(got) == 12
            assert all((r.n_records, r.first_ms, r.last_ms) == (r.partition + 1, 10 * r.partition, 11 * r.partition) for r in got)
        moved = {(r.member, r.topic, r.partition, r.change) for r in assign.changes(log, assign.in_turn(n), assign.in_turn(3)).collect()}
        after = {k: f"m{i % 3}" for i, k in enumerate(parts)}
        assert moved == {x for k in parts for x in ([(turn[k], *k, "kept")] if turn[k] == after[k] else [(turn[k], *k, "revoked"), (after[k], *k, "assigned")])}


def test_assignment_says_what_each_reader_has_in_all(spark, sf):
    """Against the records added up by reader, with fewer and more readers than partitions; then the query over all events."""
    parts = [(t, p) for t, n in (("a", 7), ("b", 1), ("c", 4)) for p in range(n)]
    log = spark.createDataFrame([(t, p, 10 * p + x) for t, p in parts for x in range(p + 1)], "topic string, partition int, timestamp_ms long")
    for n in (1, 5, 20):
        got = assign.with_loads(assign.assignment(log, assign.in_turn(n))).collect()
        assert {(r.topic, r.partition, r.member) for r in got} == {(*k, f"m{i % n}") for i, k in enumerate(parts)} and len(got) == 12
        for r in got:
            mine = [p for i, (_, p) in enumerate(parts) if f"m{i % n}" == r.member]
            assert (r.n_partitions, r.reader_records, r.reader_first_ms, r.reader_last_ms) == (len(mine), sum(p + 1 for p in mine), 10 * min(mine), 11 * max(mine))
    got = Q.QUERIES["assign_round_robin"](spark, sf).collect()
    assert {(r.member, r.n_partitions) for r in got} == {("m0", 4), ("m1", 4), ("m2", 4), ("m3", 3)}
    assert sum(dict((r.member, r.reader_records) for r in got).values()) == sum(r.n_records for r in got) == spark.read.parquet(f"{sf}/events.parquet").count()


def test_readers_of_a_group():
    one = lambda group, **a: ConsumerSpec(topics="a", group_id=group, **a)
    check_group([one("g"), one("g"), one("h", region=Region.PERIODIC), one("h", region=Region.PERIODIC), ConsumerSpec(topics="a", region=Region.PERIODIC)])
    with pytest.raises(SpecError, match="same consistent region"):
        check_group([one("g"), one("g", region=Region.PERIODIC)])
    with pytest.raises(SpecError, match="same consistent region"):
        check_group([one("g", region=Region.PERIODIC), one("g", region=Region.OPERATOR_DRIVEN, trigger_count=5)])
