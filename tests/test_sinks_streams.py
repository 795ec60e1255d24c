import json
import time
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F, types as T

from tollspark.operators import rates, reports, summary
from tollspark.plans import views
from tollspark.session import shared_folder
from tollspark.sinks import tables as sinks
from tollspark.sinks.tables import Upsert
from tollspark.sources import tables as sources
from tollspark.streaming import join as stream_join, ledger, runs, stateful


def test_upsert_replaces_and_repeats(spark, rows):
    target = Upsert(shared_folder(spark, "t"), ["k"])
    frame = lambda *r: spark.createDataFrame(r, "k int, v string")
    target.write(frame((1, "a"), (2, "b")), 0)
    target.write(frame((2, "c"), (3, None)), 1)
    target.write(frame((2, "c"), (3, None)), 1)  # a repeated batch
    assert rows(target.read(spark)) == [(1, "a"), (2, "c"), (3, None)]
    smaller = target.compact(spark, shared_folder(spark, "t"))
    smaller.write(frame((1, "z")), 2)
    assert rows(smaller.read(spark)) == [(1, "z"), (2, "c"), (3, None)]


def test_upsert_within_a_batch_and_text_nulls(spark, rows):
    frame = spark.createDataFrame([(1, 5, "old"), (1, 6, None)], "k int, t int, v string")
    target = sinks.upsert_batch(frame, shared_folder(spark, "t"), ["k"], 0, order=["t"], legacy_nulls=True)
    assert rows(target.read(spark)) == [("1", "6", "null")]


def test_upsert_of_many_batches_stays_near_its_live_rows(spark, rows, tmp_path):
    target = Upsert(str(tmp_path / "t"), ["k"], files=1, merge_after=4)
    for batch_id in range(30):
        target.write(spark.range(20).selectExpr("id as k", f"id + {batch_id} as v"), batch_id)
    target.write(spark.range(20).selectExpr("id as k", "id + 29 as v"), 29)  # a repeated batch
    assert {r.k: r.v for r in target.read(spark).collect()} == {k: k + 29 for k in range(20)}
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() <= 20 * 2 * (4 + 2) and stored.where("part = 'merged'").count() <= 40
    *_, base, fresh = target._layout(spark)
    assert len(base) == 1 and len(fresh) < 8


def test_an_unfinished_merge_is_not_read(spark, rows, tmp_path):
    target = Upsert(str(tmp_path / "t"), ["k"], merge_after=2)
    frame = lambda *r: spark.createDataFrame(r, "k int, v string")
    target.write(frame((1, "a")), 0)
    frame((1, "half")).write.parquet(str(tmp_path / "t" / "part=merged" / "batch_id=0"))
    (tmp_path / "t" / "part=merged" / "batch_id=0" / "_SUCCESS").unlink()
    assert rows(target.read(spark)) == [(1, "a")]
    target.write(frame((2, "b")), 1)
    target.write(frame((1, "c")), 2)
    assert rows(target.read(spark)) == [(1, "c"), (2, "b")]


def test_upsert_failure_propagates(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception):
        Upsert(str(tmp_path / "file" / "sub"), ["k"]).write(spark.range(1).toDF("k"), 0)


def test_overwrite_table(spark):
    sinks.overwrite(spark.range(3), "t_over")
    sinks.overwrite(spark.range(2), "t_over")
    assert spark.table("t_over").count() == 2
    spark.sql("drop table t_over")


def test_overwrite_only_named_partitions(spark, rows, tmp_path):
    path, schema = str(tmp_path / "p"), "n int, collectDay string, eventDay string"
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], schema), path, ["collectDay", "eventDay"])
    sinks.overwrite_partitions(spark.createDataFrame([(3, "a", "y")], schema), path, ["collectDay", "eventDay"])
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "a", "x"), (3, "a", "y")]


def test_row_key_table_is_sorted_in_ranges(spark, tmp_path):
    frame = sinks.with_row_key(spark.range(500).selectExpr("cast(id as string) as trade_id"), "trade_id")
    sinks.write_by_row_key(frame, str(tmp_path / "r"), 4, ("rowkey", "trade_id"))
    parts = spark.read.parquet(str(tmp_path / "r")).groupBy(F.input_file_name().alias("f")).agg(F.min("rowkey").alias("a"), F.max("rowkey").alias("b"))
    spans = sorted((r.a, r.b) for r in parts.collect())
    assert len(spans) == 4 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_append_json(spark, tmp_path):
    for _ in range(2):
        sinks.append_json(spark.range(20), str(tmp_path / "j"), 5)
    assert spark.read.json(str(tmp_path / "j")).count() == 40
    assert len(list((tmp_path / "j").glob("*.json"))) == 10


def test_kafka_adapters(spark):
    row = sinks.to_kafka_value(spark.sql("select 1 a, 'x' b"), F.col("a")).first()
    assert row.key == "1" and json.loads(row.value) == {"a": 1, "b": "x"}
    assert runs.kafka_sink_options("h:9092", "out", "/c") == {"kafka.bootstrap.servers": "h:9092", "topic": "out", "checkpointLocation": "/c"}


def test_offset_ledger(spark):
    batch = spark.createDataFrame([("a", 0, 5), ("a", 0, 9), ("a", 1, 2), ("b", 0, 0)], "topic string, partition int, offset bigint")
    target = Upsert(shared_folder(spark, "ledger"), ["group_id", "topic", "partition"])
    target.write(ledger.offset_ledger(batch, "g", "2024-01-01 00:00:10"), 0)
    target.write(ledger.offset_ledger(batch.where("topic = 'b'").withColumn("offset", F.lit(7)), "g", "2024-01-01 00:00:20"), 1)
    assert json.loads(ledger.starting_offsets(target.read(spark), "g")) == {"a": {"0": 10, "1": 3}, "b": {"0": 8}}
    assert json.loads(ledger.starting_offsets(target.read(spark), "other")) == {}


def test_shared_folder_needs_a_setting_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        shared_folder(Cluster, "x")


@pytest.fixture(scope="module")
def split_events(spark, sf_dir):
    """The events table as time-ordered files, so that a replay takes several batches."""
    path = shared_folder(spark, "events")
    views.table(spark, sf_dir, "events").repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


def stream_of(spark, path, name):
    stream = sources.stream_table(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)
    return runs.with_lateness(views.over(name, stream), "event_ts", "40 days")


def run(spark, df, keys, **options):
    target = Upsert(shared_folder(spark, "t"), keys)
    query = runs.run_update(df, target, shared_folder(spark, "c"), trigger=None, **options)
    query.awaitTermination()
    return target, query


def test_batches_accumulate_like_the_table(spark, rows, split_events, sf_dir):
    build = lambda df: reports.exit_station_period(df, "1 day", event="event_ts")
    target, query = run(spark, build(stream_of(spark, split_events, "v_exit_evt")), ["extollstationid", "statisticDay"])
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert rows(target.read(spark)) == rows(build(views.view(spark, sf_dir, "v_exit_evt")))


def test_enriched_rates_over_batches(spark, rows, split_events, sf_dir):
    dim = views.view(spark, sf_dir, "v_dim")
    build = lambda df: rates.deal_success(df, ["gantry_id"], event="event_ts", dim=dim)
    target, _ = run(spark, build(stream_of(spark, split_events, "v_gantry")), ["gantry_id", "window_start"])
    assert rows(target.read(spark)) == rows(build(views.view(spark, sf_dir, "v_gantry")))


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path, rows):
    source, target, checkpoint = str(tmp_path / "in"), Upsert(str(tmp_path / "out"), ["k"]), str(tmp_path / "c")
    for ids in ((0, 10), (10, 25)):
        spark.range(*ids).selectExpr("cast(id % 3 as int) as k").write.mode("append").parquet(source)
        counts = sources.stream_table(spark, source, "k int").groupBy("k").count()
        runs.run_update(counts, target, checkpoint, trigger=None).awaitTermination()
    assert rows(target.read(spark)) == [(0, 9), (1, 8), (2, 8)]


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    source = str(tmp_path / "in")
    start = datetime(2024, 1, 10)
    checkpoint, target = str(tmp_path / "c"), Upsert(str(tmp_path / "out"), ["k", "window_start"])
    # Rows are judged by the watermark of the batch before theirs, hence the batch in between.
    later = start + timedelta(days=5)
    for moments in ([start], [later], [later], [start - timedelta(hours=1), later]):
        spark.createDataFrame([("k", m) for m in moments], "k string, t timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = runs.with_lateness(sources.stream_table(spark, source, "k string, t timestamp"), "t", "1 day")
        runs.run_update(summary.count_by(stream, ["k"], "1 day", "t"), target, checkpoint, trigger=None).awaitTermination()
    counts = {r.window_start: r.n for r in target.read(spark).collect()}
    assert counts == {start: 1, later: 3}


def test_stream_lines_and_tokens(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x y x")
    target, _ = run(spark, summary.token_count(sources.read_lines(spark, str(tmp_path / "in")), "value"), ["value"], mode="complete")
    assert {r.value: r.n for r in target.read(spark).collect()} == {"x": 2, "y": 1}


def test_sliding_count_on_a_stream(spark, rows, split_events, sf_dir):
    build = lambda df: summary.sliding_count(df, ["station_id"], "2 days", "1 day", "event_ts")
    target, _ = run(spark, build(stream_of(spark, split_events, "v_exit_evt")), ["station_id", "window_start"])
    assert rows(target.read(spark)) == rows(build(views.view(spark, sf_dir, "v_exit_evt")))


def test_stream_match_emits_unmatched_after_the_watermark(spark, tmp_path):
    etc, viu = str(tmp_path / "etc"), str(tmp_path / "viu")
    t = datetime(2024, 1, 1, 12)
    end = t + timedelta(days=10)
    spark.createDataFrame([("E1", "G", "P", t), ("E2", "G", "Q", t), ("E9", "G", "Z", end)], "trade_id string, gantry_id string, plate string, trans_time timestamp").write.parquet(etc)
    spark.createDataFrame([("V1", "G", "P", t + timedelta(seconds=200)), ("V2", "G", "P", t + timedelta(seconds=201)), ("V9", "G", "Y", end)],
                          "pic_id string, gantry_id string, plate string, pic_time timestamp").write.parquet(viu)
    pairs = stream_join.stream_interval_match(
        sources.stream_table(spark, etc, spark.read.parquet(etc).schema), sources.stream_table(spark, viu, spark.read.parquet(viu).schema),
        ["gantry_id", "plate"], "trans_time", "pic_time", 200, delay="1 hour")
    with runs.rocksdb_state(spark):
        runs.passthrough(pairs, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {(r.trade_id, r.pic_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("E1", "V1"), ("E2", None)}


def test_running_count_sums_over_batches(spark, split_events, sf_dir):
    stream = sources.stream_table(spark, split_events, spark.read.parquet(split_events).schema, max_files_per_trigger=1)
    target, _ = run(spark, stateful.running_count(stream, "event_type", 86400), ["event_type"])
    want = {r.event_type: r["count"] for r in views.table(spark, sf_dir, "events").groupBy("event_type").count().collect()}
    assert {r.event_type: r.n for r in target.read(spark).collect()} == want


def test_a_count_that_timed_out_starts_a_new_session(spark, tmp_path):
    """`a` pauses for longer than its timeout and returns: its first session keeps its count, a second one begins."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    target = Upsert(str(tmp_path / "out"), ["k", "session"])
    for keys in (["a", "a", "b"], ["b"], ["b"], ["a"]):
        spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1).write.mode("append").parquet(source)
        counts = stateful.keyed_count(sources.stream_table(spark, source, "k string"), ["k"], 1, "n", sessions=True)
        runs.run_update(counts, target, checkpoint, trigger=None).awaitTermination()
    stored = target.read(spark)
    assert sorted(r.n for r in stored.where("k = 'a'").collect()) == [1, 2]
    assert {r.k: r.n for r in stateful.session_totals(stored, ["k"], "n").collect()} == {"a": 3, "b": 3}


def test_a_timer_reports_a_count_and_the_key_resumes(spark, tmp_path):
    """By the clock: `a` falls silent, its timer closes it in a later batch, and it starts again from zero."""
    source, checkpoint, seen = str(tmp_path / "in"), str(tmp_path / "c"), []

    def deliver(*keys):
        spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1).write.mode("append").parquet(source)
        counts = stateful.keyed_count(sources.stream_table(spark, source, "k string"), ["k"], 1500, "n", closing=True)
        runs.foreach_batch(counts, lambda batch, i: seen.extend(map(tuple, batch.collect())), checkpoint).awaitTermination()

    deliver("a", "a")
    time.sleep(2)
    deliver("b")
    deliver("a")
    assert [row for row in seen if row[0] == "a"] == [("a", 2, False), ("a", 2, True), ("a", 1, False)]
    assert ("b", 1, False) in seen


class Store:
    """The state of one bucket, which counts how often it is asked."""

    def __init__(self):
        self.rows, self.timers, self.asked = [], [], 0

    def getListState(self, name, schema, ttl):
        return self

    def get(self):
        self.asked += 1
        return iter(self.rows)

    def put(self, rows):
        self.asked, self.rows = self.asked + 1, rows

    def clear(self):
        self.rows = []

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


@pytest.mark.parametrize("closing", [False, True])
def test_keyed_state_asks_its_store_by_bucket(closing):
    """A thousand keys cost one look into the store, and each keeps a count, a session and a timeout of its own."""
    keys, store = T.StructType().add("k", "string").add("i", "long"), Store()
    names = ["k", "i", "session", "n", *(["closed"] if closing else [])]
    counts = stateful.IdleCounts(keys, names, 100, True, closing)
    counts.init(store)

    def call(now, *rows):
        at = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        given = iter([Row(k=k, i=i, _n=n) for k, i, n in rows])
        return [tuple(r)[:4 + closing] for r in counts.handleInputRows((0,), given, at)]

    last = (False,) if closing else ()
    found = call(1000, *[("a", i, 2) for i in range(1000)], (None, None, 1), ("a", 0, 3))
    assert store.asked == 2 and len(found) == 1001
    assert ("a", 0, 1000, 5, *last) in found and (None, None, 1000, 1, *last) in found
    assert call(1050, ("a", 0, 1), (None, None, 1)) == [("a", 0, 1000, 6, *last), (None, None, 1000, 2, *last)]
    late = call(1100, ("a", 7, 1), ("a", 0, 1))  # all others have been idle for the timeout
    assert ("a", 0, 1000, 7, *last) in late and len(store.rows) == 3
    if closing:
        assert ("a", 7, 1000, 3, False) in late and sum(r[4] for r in late) == 998 and store.timers == [1150]
        at = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 1160)
        assert [tuple(r) for r in counts.handleExpiredTimer((0,), at, None)] == [(None, None, 1000, 2, True)]
        assert store.timers == [1200]
    else:
        assert ("a", 7, 1100, 1) in late and len(late) == 2


def test_keyed_counts_cross_by_bucket(spark):
    """Rows of many Arrow batches are counted together, and all keys of a bucket travel in one value."""
    df = spark.range(0, 30000, 1, 1).selectExpr("cast(id % 15000 as string) k", "nullif(id % 3, 2) + 9007199254740992 i")
    parts = stateful._partial_counts(df, df.schema.fields, 8).collect()
    assert sorted(r["_bucket"] for r in parts) == list(range(8))
    schema = pa.schema([("k", pa.string()), ("i", pa.int64()), ("_n", pa.int64())])
    found = {(k, i): n for r in parts for k, i, n in stateful._rows(r["_packed"], schema)}
    assert found == {(str(k), None if k % 3 == 2 else k % 3 + 2 ** 53): 2 for k in range(15000)}


def test_packed_state_holds_a_bucket_in_one_value():
    out = T.StructType().add("k", "string").add("at", "timestamp").add("session", "long").add("n", "long").add("closed", "boolean")
    store, day = Store(), datetime(2024, 1, 1, tzinfo=timezone.utc)
    counts = stateful.PackedIdleCounts(T.StructType(out.fields[:2]), out, 100, True, True)
    counts.init(store)
    at = lambda now: SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
    given = lambda *rows: Row(_packed=stateful._pack(rows, counts.given))
    read = lambda found: [row for one in found for row in stateful._rows(one["_packed"], counts.out)]

    first = read(counts.handleInputRows((0,), iter([given(("a", day, 2), (None, None, 1)), given(("a", day, 3))]), at(1000)))
    assert first == [("a", day, 1000, 5, False), (None, None, 1000, 1, False)] and len(store.rows) == 1
    second = read(counts.handleInputRows((0,), iter([given(("a", day, 1))]), at(1050)))
    assert second == [("a", day, 1000, 6, False)] and store.asked == 4
    assert read(counts.handleExpiredTimer((0,), at(1100), None)) == [(None, None, 1000, 1, True)]
    assert read(counts.handleExpiredTimer((0,), at(1150), None)) == [("a", day, 1000, 6, True)] and store.rows == []
    assert list(counts.handleExpiredTimer((0,), at(1200), None)) == []


def test_keyed_count_keeps_keys_of_any_type(spark, rows, tmp_path):
    """Long numbers beside nulls keep their last digits, and zeros and times are one key each."""
    frame = spark.sql("select explode(array(named_struct('l', 9007199254740993, 'd', 0.0d, 't', timestamp'2024-01-01', 'b', x'01'), "
                      "named_struct('l', 9007199254740992, 'd', -0.0d, 't', timestamp'2024-01-01', 'b', x'01'), "
                      "named_struct('l', 9007199254740992, 'd', 0.0d, 't', timestamp'2024-01-01', 'b', x'01'), "
                      "named_struct('l', null, 'd', null, 't', null, 'b', null))) r").select("r.*")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = sources.stream_table(spark, str(tmp_path / "in"), frame.schema)
    target, _ = run(spark, stateful.keyed_count(stream, ["l", "d", "t", "b"], 86400000, "n", buckets=2), ["l", "d", "t", "b"])
    assert rows(target.read(spark).select("l", "d", "b", "n")) == [
        (9007199254740992, 0.0, b"\x01", 2), (9007199254740993, 0.0, b"\x01", 1), (None, None, None, 1)]
    assert target.read(spark).exceptAll(frame.groupBy("l", "d", "t", "b").agg(F.count("*").alias("n"))).count() == 0


def test_pv_windows_count_like_the_keyed_state(spark):
    t = datetime(2024, 1, 1, 8, 0, 30)
    views_ = spark.createDataFrame([(t, "v", "u"), (t, "v", "u"), (t, None, "u"), (None, "v", "u"), (t + timedelta(minutes=1), "v", "u")],
                                   "timestamp timestamp, eventType string, userID string")
    assert sorted(map(tuple, stateful.pv_per_minute_windowed(views_).collect())) == [("2024-01-01 08:00", "u", 2), ("2024-01-01 08:01", "u", 1)]


def test_pv_per_minute_ignores_incomplete_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    t = datetime(2024, 1, 1, 8, 0, 30)
    spark.createDataFrame([(t, "v", "u"), (t, "v", "u"), (t, None, "u"), (None, "v", "u"), (t, "v", None)],
                          "timestamp timestamp, eventType string, userID string").write.parquet(source)
    stream = sources.stream_table(spark, source, spark.read.parquet(source).schema)
    target, _ = run(spark, stateful.pv_per_minute(stream, timeout_seconds=86400), ["minute", "userID"])
    assert [tuple(r) for r in target.read(spark).collect()] == [("2024-01-01 08:00", "u", 2)]
