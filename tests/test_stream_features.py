"""Buckets, staging, late rows, chained aggregates and catalog tables."""

import os

from pyspark.sql import functions as F

from tollspark.operators import rates
from tollspark.plans import queries, views
from tollspark.session import shared_folder
from tollspark.sinks import tables as sinks
from tollspark.sources import records, tables as sources, wide
from tollspark.streaming import late, runs, staging


def sizes(path):
    """Bytes and change time of every data file."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                at = os.path.join(folder, name)
                found[at] = os.path.getsize(at)
    return found


def test_buckets_replace_repeat_and_delete(spark, rows, tmp_path):
    target = sinks.BucketUpsert(str(tmp_path / "t"), ["k"], buckets=4, order=["t"], deleted="gone")
    frame = lambda *r: spark.createDataFrame(r, "k int, t int, v string, gone boolean")
    target.write(frame((1, 1, "a", False), (1, 2, "b", False), (2, 1, "x", None), (None, 1, "n", False)), 0)
    target.write(frame((2, 1, "x", True), (3, 1, "y", False)), 1)
    target.write(frame((2, 1, "x", True), (3, 1, "y", False)), 1)  # a repeated batch
    assert rows(target.read(spark)) == [(1, 2, "b"), (3, 1, "y"), (None, 1, "n")]
    target.write(frame((2, 9, "back", False)), 2)
    target.write(frame().limit(0), 3)
    assert rows(target.read(spark).where("k = 2")) == [(2, 9, "back")]


def test_fifty_batches_rewrite_only_their_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    target = sinks.BucketUpsert(path, ["k"], buckets=16)
    target.write(spark.range(4000).selectExpr("id as k", "0 as n", "uuid() as filler"), 0)
    whole, rewritten = sum(sizes(path).values()), 0
    for i in range(1, 51):
        before = sizes(path)
        target.write(spark.createDataFrame([(i * 37 % 4000, i, "x")], "k long, n int, filler string"), i)
        rewritten += sum(size for name, size in sizes(path).items() if name not in before)
    assert rewritten < 50 * whole / 8  # a sixteenth of the table each time, and not the table
    assert target.read(spark).where("n > 0").count() == 50 and target.read(spark).count() == 4000


def test_two_results_read_the_source_once(spark, sf_dir, tmp_path):
    events = views.table(spark, sf_dir, "events")
    source, folder = str(tmp_path / "in"), str(tmp_path / "decoded")
    queries._gantry_json(spark, sf_dir).select("value").write.parquet(source)
    decoded = wide.decode(sources.stream_table(spark, source, "value string"), wide.GANTRY, keep_raw=True)
    staged = staging.stage(decoded, folder, str(tmp_path / "c"), trigger=None)
    staged.awaitTermination()
    assert sum(p.numInputRows for p in staged.recentProgress) == events.count()
    rows = runs.with_lateness(staging.decoded_rows(spark, folder, decoded.schema), "event_time")
    results = [(rates.deal_success(rows, ["gantry_id"]), "a"), (rates.timeliness(rows, ["gantry_id"]), "b")]
    for frame, name in results:
        run = runs.run_update(frame, sinks.Upsert(str(tmp_path / name), ["gantry_id", "window_start"]), str(tmp_path / f"c{name}"), None)
        run.awaitTermination()
        described = [s.description for p in run.recentProgress for s in p.sources]
        assert described and all(folder in text and source not in text for text in described)
        assert sum(p.numInputRows for p in run.recentProgress) == events.count()
    assert spark.read.parquet(folder).where("not valid").count() == 0


def test_rejects_have_a_partition_of_their_own(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "decoded")
    spark.createDataFrame([('{"tradeId":"T","stationDBTime":"2020-07-12T08:00:00"}',), ("{broken",), (None,)], "value string").write.parquet(source)
    decoded = wide.decode(sources.stream_table(spark, source, "value string"), wide.GANTRY, keep_raw=True)
    staging.stage(decoded, folder, str(tmp_path / "c"), trigger=None).awaitTermination()
    assert {r.value for r in spark.read.parquet(f"{folder}/valid=false").select("value").collect()} == {"{broken", None}
    assert spark.read.parquet(f"{folder}/valid=true").first().trade_id == "T"
    assert records.GANTRY.wire_names()[0] == "tradeId"


def test_rows_behind_the_watermark_are_marked(spark, tmp_path):
    source = str(tmp_path / "in")
    for day in ("2024-01-05", "2024-01-04", "2024-01-01"):
        spark.sql(f"select timestamp'{day} 12:00:00' as at, '{day}' as name").write.mode("append").parquet(source)
    stream = sources.stream_table(spark, source, "at timestamp, name string", max_files_per_trigger=1)
    marked = late.mark_late(stream.withColumn("ends", F.window("at", "1 day")["end"]), "at", "ends", "1 day")
    path = str(tmp_path / "out")
    with runs.rocksdb_state(spark):
        runs.passthrough(marked, path, str(tmp_path / "c")).awaitTermination()
    assert {r.name: r.late for r in spark.read.parquet(path).collect()} == {
        "2024-01-05": False, "2024-01-04": False, "2024-01-01": True}


def test_replays_take_several_batches_and_keep_bounded_state(spark, sf_dir):
    stream = runs.with_lateness(views.over("v_exit_evt", queries._events_stream(spark, sf_dir)), "event_ts")
    counts = stream.groupBy(F.window("event_ts", "1 day").alias("window")).agg(F.count(F.lit(1)).alias("n"))
    seen = []
    run = runs.foreach_batch(counts, lambda batch, i: seen.append(batch.count()), shared_folder(spark, "c"))
    run.awaitTermination()
    busy = [p for p in run.recentProgress if p.numInputRows]
    days = views.view(spark, sf_dir, "v_exit_evt").select(F.to_date("event_ts")).distinct().count()
    assert len(busy) == 3 and max(op.numRowsTotal for p in busy for op in p.stateOperators) < days


def test_catalog_table_prunes_partitions(spark, sf_dir):
    found = queries.all_queries()["overwrite_table"](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "2024-01-01" in scan[:scan.index("PushedFilters")]
