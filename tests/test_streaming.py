from __future__ import annotations

import json

import pytest
from helpers import READING, agg_row, aggs, readings
from pyspark.sql import functions as F

from obsweave.functions.quality import Bounds
from obsweave.operators.latest import latest_per_key
from obsweave.operators.validate import clean, quarantine
from obsweave.operators.windows import tumbling
from obsweave.plans.report import report, write_report
from obsweave.schemas import AGGREGATE
from obsweave.sinks import fanout
from obsweave.sources import files, messages, streams
from obsweave.streaming import counters, jobs, windows

ANY_AGE = Bounds(timestamp_max_lag_sec=10 ** 9)


def stored(spark, path):
    return files.load_parquet(spark, path, partition=files.PARTITION_DATE).select(*AGGREGATE.names)


def fill(spark, path, *batches):
    """One file per batch, in order."""
    import os
    for i, rows in enumerate(batches):
        readings(spark, rows).coalesce(1).write.mode("append").parquet(path)
        for n in os.listdir(path):
            if n.startswith("part") and not n.startswith("part-b"):
                os.rename(f"{path}/{n}", f"{path}/part-b{i}.parquet")
                os.utime(f"{path}/part-b{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))


def run_of(city, seconds, temp=10.0):
    return [(city, temp + s % 7, 50, 1000, 3.0, s, f"s{s % 2}") for s in seconds]


def test_stream_then_drain_equals_batch(spark, folder):
    src, table = folder + "/in", folder + "/table"
    fill(spark, src, run_of("A", range(0, 200, 7)) + run_of("B", range(0, 200, 11)),
         run_of("A", range(200, 500, 7)), run_of("B", range(150, 900, 13)))
    live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
    q = jobs.start_windows(live, table, folder + "/cp", delay="120 seconds", bounds=ANY_AGE)
    q.awaitTermination()
    batch_source = clean(spark.read.schema(READING).parquet(src), ANY_AGE)
    want = sorted(tumbling(batch_source).select(*AGGREGATE.names).collect())
    mark = windows.final_watermark(q)
    emitted = sorted(stored(spark, table).collect())
    closed = [r for r in want if r.window_end <= mark.replace(tzinfo=None)]
    assert windows.dropped_late(q) == 0
    assert emitted == closed and 0 < len(closed) < len(want)
    rest = windows.drain(batch_source, mark).select(*AGGREGATE.names)
    assert sorted(emitted + rest.collect()) == want


def test_late_rows_are_counted(spark, folder):
    src = folder + "/in"
    fill(spark, src, run_of("A", range(0, 2000, 50)), run_of("A", [2100]), run_of("A", [5, 6]))
    live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
    q = jobs.start_windows(live, folder + "/table", folder + "/cp", bounds=ANY_AGE)
    q.awaitTermination()
    assert windows.dropped_late(q) >= 1


def test_restart_continues_and_update_mode_settles_on_the_last_state(spark, folder):
    src, table = folder + "/in", folder + "/table"
    fill(spark, src, run_of("A", range(0, 30, 3)))

    def go():
        live = streams.open_stream(spark, "parquet", path=src, schema=READING)
        jobs.start_windows(live, table, folder + "/cp", bounds=ANY_AGE, mode="update").awaitTermination()

    go()
    assert stored(spark, table).first()["count"] == 10
    readings(spark, run_of("A", range(30, 60, 3))).coalesce(1).write.mode("append").parquet(src)
    go()
    assert [r["count"] for r in stored(spark, table).collect()] == [20]


def test_quarantine_stream(spark, folder):
    src = folder + "/in"
    fill(spark, src, [("A", 999.0, 50, 1000, 1.0, 0), ("A", 1.0, 50, 1000, 1.0, 0), (" ", 1.0, 50, 1000, 1.0, 0)])
    live = streams.open_stream(spark, "parquet", path=src, schema=READING)
    jobs.start_quarantine(live, folder + "/bad", folder + "/cp", bounds=ANY_AGE).awaitTermination()
    got = spark.read.parquet(folder + "/bad")
    assert got.count() == 2
    assert sorted(got.collect()) == sorted(quarantine(spark.read.schema(READING).parquet(src), ANY_AGE).collect())


def test_messages_from_two_sources_with_dead_letters(spark, folder):
    a, b = folder + "/a", folder + "/b"
    rows = aggs(spark, agg_row("A", 0, temp=1.0), agg_row("B", 0, temp=2.0))
    rows.select(messages.encode_aggregates(rows.columns).alias("value")).write.text(a)
    again = aggs(spark, agg_row("A", 0, 2, temp=5.0), agg_row("B", 0, temp=2.0))
    again.select(messages.encode_aggregates(again.columns).alias("value")).union(
        spark.createDataFrame([("{broken",)], "value STRING")).write.text(b)
    both = streams.merge_streams(streams.open_stream(spark, "text", path=a), streams.open_stream(spark, "text", path=b))
    jobs.start_messages(both, folder + "/table", folder + "/dead", folder + "/cp").awaitTermination()
    assert {r.city: r.avg_temp for r in stored(spark, folder + "/table").collect()} == {"A": 5.0, "B": 2.0}
    assert [(r.value, r.reason) for r in spark.read.parquet(folder + "/dead").collect()] == [("{broken", "not a JSON object")]


def test_latest_per_key_over_batches_equals_batch(spark, folder):
    src = folder + "/in"
    for i in range(3):
        aggs(spark, agg_row("A", i, temp=float(i)), agg_row(f"B{i}", 10 - i)).coalesce(1).write.mode("append").parquet(src)
    live = streams.open_stream(spark, "parquet", path=src, schema=AGGREGATE, max_files=1)
    jobs.start_latest(live, folder + "/latest", folder + "/cp").awaitTermination()
    got = files.load_parquet(spark, folder + "/latest", AGGREGATE).select(*AGGREGATE.names)
    assert sorted(got.collect()) == sorted(latest_per_key(spark.read.parquet(src)).collect())


def test_bounded_history(spark, folder):
    src = folder + "/in"
    for i in range(3):
        spark.range(i * 4, i * 4 + 4).coalesce(1).write.mode("append").parquet(src)
    live = streams.open_stream(spark, "parquet", path=src, schema="id BIGINT", max_files=1)
    jobs.start_history(live, folder + "/h", folder + "/cp", n=5, sequence="id").awaitTermination()
    kept = sorted(r.id for r in jobs.history(spark, folder + "/h", live.schema).collect())
    assert kept == [7, 8, 9, 10, 11]
    assert jobs._versions(spark, folder + "/h") == [1, 2]      # older ones are gone
    assert jobs.history(spark, folder + "/none", live.schema).count() == 0


def test_intake_sends_each_reading_to_one_table(spark, folder):
    src = folder + "/in"
    rows = [("A", 999.0, 50, 1000, 1.0, 0), ("A", 1.0, 50, 1000, 1.0, 0), (" ", 1.0, 50, 1000, 1.0, 0)]
    fill(spark, src, rows[:2], rows[2:])
    live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
    jobs.start_intake(live, folder + "/good", folder + "/bad", folder + "/cp", bounds=ANY_AGE).awaitTermination()
    good, bad = spark.read.parquet(folder + "/good"), spark.read.parquet(folder + "/bad")
    assert [(r.city, r.temperature) for r in good.collect()] == [("A", 1.0)]
    assert sorted((r.city, r.errors[0].field) for r in bad.collect()) == [(" ", "city"), ("A", "temperature")]


def test_late_rows_of_every_batch_are_counted(spark, folder):
    src = folder + "/in"
    late = [run_of("A", [5 + i]) for i in range(4)]
    fill(spark, src, run_of("A", range(0, 2000, 50)), run_of("A", [2100]), *late)
    listener = counters.LateRows()
    spark.streams.addListener(listener)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
        q = jobs.start_windows(live, folder + "/table", folder + "/cp", bounds=ANY_AGE)
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(listener)
    assert listener.totals[str(q.id)] == len(late) > windows.dropped_late(q)


def test_failing_sink_leaves_the_others_and_can_be_replayed(spark, folder):
    seen = {}

    def good(df, batch_id):
        seen[batch_id] = df.count()

    def bad(df, batch_id):
        raise RuntimeError("broker away")

    write = fanout.fan_out({"bad": bad, "absent": None, "good": good}, folder + "/failed")
    df = aggs(spark, agg_row(), agg_row("B"))
    write(df, 4)
    write(df, 4)      # a repeated batch keeps one copy
    assert seen == {4: 2}
    kept = spark.read.parquet(folder + "/failed")
    assert {(r.sink, r.batch, r.error) for r in kept.collect()} == {("bad", 4, "broker away")} and kept.count() == 2
    fanout.replay(kept, good, 9)
    assert seen[9] == 2
    fanout.fan_out({"none": None}, folder + "/x")(df, 0)


def test_windows_to_table_and_more_sinks(spark, folder):
    src = folder + "/in"
    fill(spark, src, run_of("A", range(0, 900, 5)))
    live = streams.open_stream(spark, "parquet", path=src, schema=READING)

    def kv(df, batch_id):
        messages.key_value(df).write.mode("append").parquet(folder + "/kv")

    jobs.start_windows(live, folder + "/table", folder + "/cp", bounds=ANY_AGE, more_sinks={"kv": kv},
                       failed_path=folder + "/failed").awaitTermination()
    sent = [json.loads(r.value) for r in spark.read.parquet(folder + "/kv").collect()]
    assert len(sent) == stored(spark, folder + "/table").count() > 0
    assert {m["city"] for m in sent} == {"A"}


def test_counters(spark, folder):
    src = folder + "/in"
    spark.createDataFrame([("A", None), ("B", "timeout"), ("C", None)], "city STRING, error STRING").write.parquet(src)
    listener = counters.RunningCounters()
    spark.streams.addListener(listener)
    try:
        live = streams.open_stream(spark, "parquet", path=src, schema="city STRING, error STRING")
        out = counters.count_published(counters.count_fetches(live).where("error IS NULL"))
        q = out.writeStream.format("parquet").option("checkpointLocation", folder + "/cp").option(
            "path", folder + "/out").trigger(availableNow=True).start()
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time
        for _ in range(50):
            if listener.totals["fetches"]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals == {"fetches": 3, "fetch_errors": 1, "publishes": 2}


def test_kafka_is_chosen_by_configuration(spark):
    options = streams.kafka_options(["a:1", "b:2"], "t", "g", 50)
    assert options == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "startingOffsets": "latest",
                       "failOnDataLoss": "true", "kafka.group.id": "g", "maxOffsetsPerTrigger": "50"}
    with pytest.raises(ValueError):
        streams.open_stream(spark, "carrier pigeon")


def test_report(spark, folder):
    df = aggs(spark, *[agg_row(c, i * 30, temp=i + 0.5) for i in range(20) for c in ("A", "B")])
    parts = write_report(df, folder + "/report")
    assert parts == list(report(df))
    assert spark.read.parquet(folder + "/report/top10").count() == 2
    assert spark.read.parquet(folder + "/report/histogram").agg(F.sum("n")).first()[0] == 40
    assert spark.read.parquet(folder + "/report/timeline").count() == 40
