"""The message log: offsets, start positions, admission, restarts, epochs."""

from __future__ import annotations

import glob
import json
import os

import pytest
from helpers import agg_row, aggs
from pyspark.sql import functions as F

from obsweave.schemas import AGGREGATE
from obsweave.sources import files, message_log as ml
from obsweave.streaming import jobs


def send(spark, path, pairs, **more):
    ml.append_log(spark.createDataFrame(pairs, "key STRING, value STRING").coalesce(1), path, **more)


def values(df):
    return [r.value for r in df.orderBy("partition", "offset").collect()]


def test_offsets_have_no_gaps_and_keys_keep_their_order(spark, folder):
    log = folder + "/log"
    for i in range(3):
        send(spark, log, [(f"k{j % 5}" if j % 7 else None, f"{i:02}-{j:02}") for j in range(40)], epoch=i)
    rows = ml.read_log(spark, log).collect()
    assert len(rows) == 120
    by_part, by_key = {}, {}
    for r in sorted(rows, key=lambda r: (r.partition, r.offset)):
        by_part.setdefault(r.partition, []).append(r.offset)
        by_key.setdefault(r.key, []).append((r.partition, r.value))
    assert all(o == list(range(len(o))) for o in by_part.values())
    assert all(len({p for p, _ in v}) == 1 and [x for _, x in v] == sorted(x for _, x in v) for v in by_key.values())


def test_start_and_end_positions(spark, folder):
    log = folder + "/log"
    send(spark, log, [("a", "1"), ("b", "2"), ("a", "3")], partitions=1)
    assert values(ml.read_log(spark, log, startingOffsets="latest")) == []
    assert values(ml.read_log(spark, log, startingOffsets='{"0": 1}')) == ["2", "3"]
    assert values(ml.read_log(spark, log, endingOffsets='{"0": 2}')) == ["1", "2"]
    assert values(ml.read_log(spark, log, startingOffsets="lastPerKey")) == ["2", "3"]
    assert values(ml.read_log(spark, folder + "/none")) == []


def test_a_repeated_epoch_is_written_once(spark, folder):
    log = folder + "/log"
    for _ in range(2):
        send(spark, log, [("a", "1")], writer="w", epoch=7)
    send(spark, log, [("a", "2")], writer="other", epoch=7)
    assert values(ml.read_log(spark, log)) == ["1", "2"]
    assert len(glob.glob(log + "/data/*")) == 2


def test_a_task_that_fails_leaves_nothing_visible(spark, folder):
    log = folder + "/log"
    send(spark, log, [("a", "1")])

    def fail(batches):
        for b in batches:
            yield b
        raise RuntimeError("task lost")

    bad = spark.range(0, 100, 1, 3).selectExpr("CAST(id AS STRING) AS key", "'x' AS value").mapInArrow(
        fail, "key STRING, value STRING")
    with pytest.raises(Exception, match="task lost"):
        ml.append_log(bad, log, epoch=1)
    assert values(ml.read_log(spark, log)) == ["1"]
    ml.append_log(spark.range(100).selectExpr("CAST(id AS STRING) AS key", "'x' AS value"), log, epoch=1)
    assert ml.read_log(spark, log).count() == 101


def start(spark, log, out, cp, begin="earliest", limit=None):
    live = ml.stream_log(spark, log, begin, "g" if limit else None, limit)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return live.writeStream.foreachBatch(keep).option("checkpointLocation", cp).trigger(processingTime="0 seconds").start()


def sizes(spark, out):
    return {r.batch: r["count"] for r in spark.read.parquet(out).groupBy("batch").count().collect()}


def test_admission_limit_and_restarts(spark, folder):
    log, out, cp = (folder + x for x in ("/log", "/out", "/cp"))
    send(spark, log, [(f"k{i % 9}", str(i)) for i in range(50)])
    jobs.run_until_idle(start(spark, log, out, cp, limit=20))
    assert list(sizes(spark, out).values()) and max(sizes(spark, out).values()) <= 20 and sum(sizes(spark, out).values()) == 50
    send(spark, log, [(f"k{i % 9}", str(i)) for i in range(50, 95)])
    jobs.run_until_idle(start(spark, log, out, cp, limit=20))
    # the last batch is taken as not done: it is repeated with the same messages
    last = max(int(os.path.basename(n)) for n in glob.glob(cp + "/commits/[0-9]*"))
    os.remove(f"{cp}/commits/{last}")
    for crc in glob.glob(f"{cp}/commits/.{last}.crc"):
        os.remove(crc)
    send(spark, log, [("k1", "95")])
    jobs.run_until_idle(start(spark, log, out, cp, limit=20))
    got = sizes(spark, out)
    assert max(got.values()) <= 20
    assert sorted(int(r.value) for r in spark.read.parquet(out).collect()) == list(range(96))


def test_stream_from_the_last_message_of_every_key(spark, folder):
    log, out, cp = (folder + x for x in ("/log", "/out", "/cp"))
    send(spark, log, [(f"k{i % 3}", str(i)) for i in range(30)])
    jobs.run_until_idle(start(spark, log, out, cp, "lastPerKey"))
    assert sorted(int(r.value) for r in spark.read.parquet(out).collect()) == [27, 28, 29]
    send(spark, log, [("k0", "30"), ("k0", "31")])
    jobs.run_until_idle(start(spark, log, out, cp, "lastPerKey"))
    assert sorted(int(r.value) for r in spark.read.parquet(out).collect()) == [27, 28, 29, 30, 31]


def test_latest_start_sees_only_what_comes_later(spark, folder):
    log, out, cp = (folder + x for x in ("/log", "/out", "/cp"))
    send(spark, log, [("a", "old")])
    q = start(spark, log, out, cp, "latest")
    q.processAllAvailable()
    send(spark, log, [("a", "new")])
    jobs.run_until_idle(q)
    assert [r.value for r in spark.read.parquet(out).collect()] == ["new"]


def test_stream_to_log_to_table(spark, folder):
    src, log, table = (folder + x for x in ("/in", "/log", "/table"))
    rows = aggs(spark, *[agg_row(c, i, temp=float(i)) for i in range(5) for c in "AB"])
    rows.coalesce(1).write.parquet(src)
    for again in range(2):
        live = spark.readStream.schema(AGGREGATE).parquet(src)
        jobs.start_log(live, log, folder + "/cp").awaitTermination()
        if not again:   # committed to the log, lost in the checkpoint
            for n in glob.glob(folder + "/cp/commits/*") + glob.glob(folder + "/cp/commits/.*.crc"):
                os.remove(n)
    assert ml.read_log(spark, log).count() == 10
    sent = {json.loads(r.value)["city"] for r in ml.read_log(spark, log).collect()}
    assert sent == {"A", "B"}
    jobs.run_until_idle(jobs.start_messages(ml.stream_log(spark, log, "earliest"), table, folder + "/dead", folder + "/cp2",
                                            every="0 seconds"))
    got = files.load_parquet(spark, table, partition=files.PARTITION_DATE).select(*AGGREGATE.names)
    assert sorted(got.collect()) == sorted(rows.withColumn("count", F.col("count")).collect())


def test_a_limit_needs_a_group(spark, folder):
    with pytest.raises(Exception, match="needs the name of a group"):
        q = start(spark, folder + "/log", folder + "/o", folder + "/cp", limit=None)
        q.stop()
        ml._StreamReader({"path": folder + "/log", "maxoffsetspertrigger": "5"})


def test_admission_shares():
    assert ml.admit({"0": 5}, {"0": 6, "1": 100, "2": 100}, 21) == {"0": 6, "1": 10, "2": 10}
    assert ml.admit({}, {"0": 2}, 10) == {"0": 2}
    assert ml.admit({"0": 2}, {"0": 2}, 10) == {"0": 2}
