import pytest
from pyspark.sql import functions as F

from tidemark import queries as Q
from tidemark.functions import control_messages
from tidemark.operators import offsets
from tidemark.plans.spec import ConsumerSpec, Region, StartPosition
from tidemark.sources import log as logs
from tidemark.streaming import error_windows, subscriptions, transactions
from tidemark.streaming.delivery import Delivery


def run(d: Delivery) -> None:
    q = d.start({"availableNow": True})
    q.awaitTermination(120)
    assert q.exception() is None


def test_each_record_once_over_restarts(spark, sf, tmp_path):
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    logs.write(log.where("offset < 20"), path)
    spec = ConsumerSpec(topics="click,view", start_position=StartPosition.BEGINNING, isolation="read_uncommitted")
    d = Delivery(spark, path, spec, str(tmp_path / "home"), max_files=4)
    run(d)
    first = d.delivered().count()
    logs.write(log.where("offset >= 20"), path)
    run(Delivery(spark, path, spec, str(tmp_path / "home"), max_files=4))
    want = log.where("topic in ('click', 'view')")
    got = d.delivered()
    assert 0 < first < got.count() == want.count() and got.select("topic", "partition", "offset").distinct().count() == want.count()
    assert sorted(map(tuple, d.committed().collect())) == sorted(map(tuple, offsets.next_offsets(want).collect()))
    before = sorted(map(tuple, d.initial().select("topic", "partition", "offset").collect()))
    d.deliver(want.where("offset < 3"), 700)
    d.deliver(want.where("offset < 3"), 700)  # a batch that runs again replaces its transaction
    assert d.delivered().count() == want.count() + want.where("offset < 3").count()
    assert sorted(map(tuple, d.initial().select("topic", "partition", "offset").collect())) == before


STEPS = ["prepare", "_place_new", "write", "_commit", "after"]


@pytest.mark.parametrize("position", [StartPosition.BEGINNING, StartPosition.END])
@pytest.mark.parametrize("step", STEPS)
def test_replay_after_a_crash(spark, sf, tmp_path, monkeypatch, step, position):
    """A batch that breaks off after any of its writes is delivered whole by its replay, from unchanged positions."""
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    old = "offset < 10 and partition <> 2"
    logs.write(log.where(old), path)
    spec = ConsumerSpec(topics="click", start_position=position, isolation="read_uncommitted")
    home = str(tmp_path / "home")
    if position is StartPosition.END:
        Delivery(spark, path, spec, home).prepare()
    logs.write(log.where(f"not ({old})"), path)

    class Crash(Exception):
        pass

    def then_crash(f):
        def g(*a, **k):
            f(*a, **k)
            raise Crash("Crash")

        return g

    d = Delivery(spark, path, spec, home)
    with monkeypatch.context() as m:
        if step == "write":
            m.setattr(transactions, "write", then_crash(transactions.write))
        elif step == "after":
            m.setattr(Delivery, "deliver", then_crash(Delivery.deliver))
        else:
            m.setattr(Delivery, step, then_crash(getattr(Delivery, step)))
        with pytest.raises(Exception, match="Crash"):
            d.start({"availableNow": True}).awaitTermination(120) if step != "prepare" else d.deliver(log, 0)
    positions = sorted(map(tuple, d.initial().select("topic", "partition", "offset").collect()))
    run(Delivery(spark, path, spec, home))
    want = log.where("topic = 'click'")
    if position is StartPosition.END:
        want = want.where(f"not ({old})")  # the partition that came later is read from its beginning
    key = ["topic", "partition", "offset"]
    assert sorted(map(tuple, d.delivered().select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    now = sorted(map(tuple, d.initial().select(*key).collect()))
    assert set(positions) <= set(now) and (step in ("prepare",) or positions == now)
    assert sorted(map(tuple, d.committed().collect())) == sorted(map(tuple, offsets.next_offsets(want).collect()))


def test_reset_to_the_initial_state(spark, sf, tmp_path):
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    logs.write(log.where("offset < 5"), path)
    spec = ConsumerSpec(topics="click", start_position=StartPosition.END, isolation="read_uncommitted")
    d = Delivery(spark, path, spec, str(tmp_path / "home"))
    run(d)
    logs.write(log.where("offset >= 5"), path)
    run(d)
    once = d.delivered().count()
    assert once == log.where("topic = 'click' and offset >= 5").count() > 0
    d.reset_to_initial()
    assert d.committed().count() == 0 and d.committed_once().count() > 0
    run(d)
    assert d.delivered().count() == once


def test_commit_by_count_of_the_reader(spark, sf, tmp_path):
    """Commits wait until the reader's records over all partitions reach the count, malformed ones too."""
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    logs.write(log.where("offset < 3"), path)
    spec = ConsumerSpec(topics="click", start_position=StartPosition.BEGINNING, isolation="read_uncommitted", commit_count=15)
    d = Delivery(spark, path, spec, str(tmp_path / "home"))
    run(d)  # nine records
    assert d.delivered().count() == 9 and d.committed().count() == 0
    logs.write(log.where("offset >= 3 and offset < 6"), path)
    run(d)
    assert {(r.partition, r.offset) for r in d.committed().collect()} == {(0, 6), (1, 6), (2, 6)}
    logs.write(log.where("offset >= 6 and offset < 7"), path)
    run(d)
    assert {r.offset for r in d.committed().collect()} == {6} and d.delivered().count() == 21


def test_transactions_of_the_trigger_count(spark, sf, tmp_path):
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    logs.write(log.where("offset < 8"), path)
    spec = ConsumerSpec(topics="click", partitions=[0, 1, 2], start_position=StartPosition.BEGINNING, isolation="read_uncommitted", region=Region.OPERATOR_DRIVEN, trigger_count=10)
    d = Delivery(spark, path, spec, str(tmp_path / "home"))
    run(d)
    out = transactions.read(spark, str(tmp_path / "home/run=0/out"))
    assert sorted(r["count"] for r in out.groupBy("txn_id").count().collect()) == [4, 10, 10]
    times = {r.txn_id: (r.lo, r.hi) for r in out.groupBy("txn_id").agg(F.min("messageTimestamp").alias("lo"), F.max("messageTimestamp").alias("hi")).collect()}
    assert times["0r0"][1] <= times["0r1"][0] and times["0r1"][1] <= times["0r2"][0]


def test_group_commits_and_the_committed_once_flag(spark, sf, tmp_path):
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    logs.write(log.where("offset < 6"), path)
    store = str(tmp_path / "commits")
    spec = ConsumerSpec(topics="click", group_id="g", start_position=StartPosition.BEGINNING, isolation="read_uncommitted")
    a = Delivery(spark, path, spec, str(tmp_path / "a"), store=store, job="a")
    run(a)
    logs.write(log.where("offset >= 6"), path)
    later = log.where("topic = 'click' and offset >= 6").count()
    default = ConsumerSpec(topics="click", group_id="g", isolation="read_uncommitted")
    b = Delivery(spark, path, default, str(tmp_path / "b"), store=store, job="b")
    run(b)  # Default goes on from the group's commits
    assert b.delivered().count() == later > 0
    again = Delivery(spark, path, spec, str(tmp_path / "a2"), store=store, job="a")
    run(again)  # the same job has committed before: the start position no longer counts
    assert again.delivered().count() == 0 or again.delivered().agg(F.min("offset")).first()[0] >= 6
    fresh = Delivery(spark, path, spec, str(tmp_path / "c"), store=store, job="c")
    run(fresh)
    assert fresh.delivered().count() == log.where("topic = 'click'").count()


def test_start_at_end_reads_only_later_records(spark, sf, tmp_path):
    log, path = Q.events_log(spark, sf), str(tmp_path / "log")
    logs.write(log.where("offset < 20"), path)
    spec = ConsumerSpec(topics="click", start_position=StartPosition.END, isolation="read_uncommitted")
    d = Delivery(spark, path, spec, str(tmp_path / "home"))
    run(d)
    assert d.delivered().count() == 0
    logs.write(log.where("offset >= 20"), path)
    run(d)
    assert d.delivered().count() == log.where("topic = 'click' and offset >= 20").count()


def test_transactions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5)
    transactions.write(df, path, "1")
    transactions.write(df, path, "1")
    transactions.begin(df, path, "2")
    transactions.begin(df, path, "3")
    transactions.abort(spark, path, "3")
    assert transactions.read(spark, path).count() == 5
    every = transactions.read(spark, path, "read_uncommitted")
    assert {r.txn_state: r["count"] for r in every.groupBy("txn_state").count().collect()} == {"committed": 5, "open": 5, "aborted": 5}


def drained(queries):
    for q in queries:
        q.processAllAvailable()
        q.stop()


@pytest.mark.parametrize("files", [1, 3])
def test_control_stream(spark, tmp_path, files):
    m = control_messages.text
    rows = [(1, 0, m("REMOVE", topics=["a"])), (1, 1, m("ADD", partitions=[("a", 0, 5), ("b", 1)])), (1, 2, m("ADD", topics=["a"])), (1, 3, m("REMOVE", partitions=[("a", 0)])), (2, 4, m("ADD", topics=["a", "b"])), (2, 5, "{"), (2, 6, m("REMOVE", topics=["a"]))]
    schema = "consumer long, seq int, json string"
    per = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * per : (i + 1) * per], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    drained(subscriptions.follow(stream, str(tmp_path / "home")))
    got = {tuple(r) for r in subscriptions.followed(spark, str(tmp_path / "home")).collect()}
    assert got == {(1, "ASSIGNED", "b", 1, -3), (2, "SUBSCRIBED", "b", None, None)}


def test_stream_equals_batch_fold(spark, sf, tmp_path):
    """Also over several batches, in which the messages of each reader go on."""
    rows = Q.control_rows(spark, sf).withColumn("json", F.regexp_replace("json", "topicpartitionoffsets", "topicPartitionOffsets")).select("consumer", F.col("seq").cast("int").alias("seq"), "json")
    for k in range(3):
        rows.where(f"seq >= {350 * k} and seq < {350 * (k + 1)}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("consumer long, seq int, json string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    drained(subscriptions.follow(stream, str(tmp_path / "home")))
    now = subscriptions.followed(spark, str(tmp_path / "home"))
    assert {tuple(r) for r in now.where("mode = 'ASSIGNED'").drop("mode").collect()} == {tuple(r) for r in Q.control_fold_assignment(spark, sf).collect()} != set()
    assert {tuple(r) for r in now.where("mode = 'SUBSCRIBED'").select("consumer", "topic").collect()} == {tuple(r) for r in Q.control_fold_subscription(spark, sf).collect()} != set()
    plan = subscriptions.elements(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Python" not in plan


def test_control_texts_are_parsed_once(spark):
    """No filter parses a text again; readers without an ADD have no mode, and in a region topics open none."""
    m = control_messages.text
    rows = spark.createDataFrame([(1, 0, m("REMOVE", topics=["a"])), (2, 1, m("ADD", topics=["a"])), (2, 2, m("ADD", partitions=[("a", 0, 5)])), (3, 3, "{"), (3, 4, '{"action": "add"}')], "consumer long, seq int, json string")
    assert {tuple(r) for r in subscriptions.modes(rows).collect()} == {(2, "SUBSCRIBED", 1)}
    assert {tuple(r) for r in subscriptions.modes(rows, region=True).collect()} == {(2, "ASSIGNED", 2)}
    assert {(r.consumer, r.family, r.last.add) for r in subscriptions.elements(rows).collect()} == {(1, "SUBSCRIBED", False), (2, "SUBSCRIBED", True), (2, "ASSIGNED", True)}
    for df in (subscriptions.elements(rows), subscriptions.modes(rows)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_batches_of_control_messages_have_many_tasks(spark, sf, monkeypatch):
    """Each of the three batches is read from several files, not by one task."""
    homes = []
    real = Q.scratch.new_folder
    monkeypatch.setattr(Q.scratch, "new_folder", lambda s, label: homes.append(real(s, label)) or homes[-1])
    assert Q.stream_control_state(spark, sf).count() > 0
    files = spark.read.parquet(f"{homes[0]}/in").inputFiles()
    batches = spark.read.parquet(f"{homes[0]}/elements").select("batch").distinct().count()
    assert batches == 3 and len(files) >= 2 * batches


@pytest.mark.parametrize("batches", [1, 4])
def test_error_windows_of_a_stream_are_those_of_the_batch(spark, sf, tmp_path, batches):
    kinds = F.array(*map(F.lit, ("TimeoutException", "SerializationException", "AuthException")))
    e = Q.events(spark, sf).select((F.col("user_id") % 5).cast("string").alias("source"), F.get(kinds, (F.col("event_id") % 3).cast("int")).alias("class"), F.col("ms").alias("ts_ms"), "event_id", (F.col("event_id") % 7 == 0).alias("retriable"), (F.col("event_type") == "purchase").alias("is_data"))
    step = -(-e.count() // batches)
    for k in range(batches):
        e.where(f"event_id >= {k * step} and event_id < {(k + 1) * step}").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = error_windows.suppressed(stream, 7_200_000).writeStream.outputMode("update").format("memory").queryName(f"errors_{batches}").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(100)  # its timers would keep a query without an end busy
    finally:
        spark.conf.unset(key)
    got = sorted(map(tuple, spark.table(f"errors_{batches}").select("event_id", "in_window", "suppressed").collect()))
    assert got == sorted(map(tuple, Q.poll_error_rules(spark, sf).collect()))
