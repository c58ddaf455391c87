"""State of streams: fixed width, drained without the source; late readings kept."""

from __future__ import annotations

from datetime import timedelta

import pytest
from helpers import READING, T0, readings

from obsweave.functions.quality import Bounds
from obsweave.operators.windows import tumbling
from obsweave.schemas import AGGREGATE
from obsweave.sources import files, streams
from obsweave.streaming import jobs, windows
from test_streaming import ANY_AGE, fill, run_of, stored

SHARDS = ["s0", "s1"]


@pytest.mark.parametrize("shards", [SHARDS, ["s1", "x", "s0"]])
def test_open_windows_come_from_the_state(spark, folder, shards):
    src, table, cp = (folder + x for x in ("/in", "/table", "/cp"))
    fill(spark, src, run_of("A", range(0, 200, 7)) + run_of("B", range(0, 200, 11)), run_of("A", range(200, 500, 7)),
         run_of("B", range(150, 900, 13)) + [(None, None, 50, None, 3.0, 880, None)])
    live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
    q = jobs.start_windows(live, table, cp, delay="120 seconds", bounds=None, shards=shards)
    q.awaitTermination()
    want = sorted(tumbling(spark.read.schema(READING).parquet(src), shards=shards).select(*AGGREGATE.names).collect(), key=str)
    emitted = stored(spark, table).collect()
    fs_gone = folder + "/gone"
    import os
    os.rename(src, fs_gone)      # the source is not needed any more
    rest = windows.drain_state(spark, cp, live, shards=shards).select(*AGGREGATE.names).collect()
    assert 0 < len(rest) < len(want)
    assert sorted(emitted + rest, key=str) == want


def test_running_plan_has_hash_aggregates_only(spark, folder):
    src = folder + "/in"
    fill(spark, src, run_of("A", range(0, 200, 7)))
    for shards, sorts in ((SHARDS, False), (None, True)):
        live = streams.open_stream(spark, "parquet", path=src, schema=READING)
        q = jobs.start_windows(live, f"{folder}/t{sorts}", f"{folder}/cp{sorts}", bounds=None, shards=shards)
        q.awaitTermination()
        assert ("SortAggregate" in q._jsq.explainInternal(False)) == sorts


def test_state_of_other_windows_is_refused(spark, folder):
    src = folder + "/in"
    fill(spark, src, run_of("A", range(0, 200, 7)))
    live = streams.open_stream(spark, "parquet", path=src, schema=READING)
    wide = live.selectExpr("city", "collected_at", "shard_id", "humidity", "pressure", "wind_speed",
                           "CAST(temperature AS INT) AS temperature")
    jobs.start_windows(wide, folder + "/t", folder + "/cp", bounds=None, shards=SHARDS).awaitTermination()
    with pytest.raises(ValueError, match="the state has"):
        windows.drain_state(spark, folder + "/cp", live, shards=SHARDS)


def test_late_readings_are_kept_and_nothing_is_lost(spark, folder):
    src, good, late, bad = (folder + x for x in ("/in", "/good", "/late", "/bad"))
    rows = [run_of("A", range(0, 2000, 50)), run_of("A", [2100]) + [("A", 999.0, 50, 1000, 1.0, 5)],
            run_of("A", [5, 6, 1990, 2150]) + run_of("B", [7])]
    fill(spark, src, *rows)

    def intake():
        live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
        jobs.start_intake(live, good, bad, folder + "/cp", bounds=ANY_AGE, late_path=late).awaitTermination()

    intake()

    def seconds(path):
        return sorted((r.collected_at - T0.replace(tzinfo=None)) // timedelta(seconds=1)
                      for r in files.load_parquet(spark, path, readings(spark, []).schema).collect())

    assert seconds(late) == [5, 6, 7]
    assert seconds(bad) == [5]
    assert len(seconds(good)) == sum(map(len, rows)) - 4
    # the windows of what came in time lose no reading
    live = streams.open_stream(spark, "parquet", path=good, schema=READING)
    q = jobs.start_windows(live, folder + "/table", folder + "/cp2", bounds=None, shards=SHARDS)
    q.awaitTermination()
    assert windows.dropped_late(q) == 0
    open_ = windows.drain_state(spark, folder + "/cp2", live, shards=SHARDS)
    assert sum(r["count"] for r in stored(spark, folder + "/table").collect() + open_.collect()) == len(seconds(good))
    # a batch that is repeated is split alike
    import glob
    import os
    last = max(int(os.path.basename(n)) for n in glob.glob(folder + "/cp/commits/[0-9]*"))
    for n in (f"{folder}/cp/commits/{last}", f"{folder}/cp/commits/.{last}.crc"):
        if os.path.exists(n):
            os.remove(n)
    intake()
    assert seconds(late) == [5, 6, 7]


def test_no_valid_reading_yet(spark, folder):
    src, good, late, bad = (folder + x for x in ("/in", "/good", "/late", "/bad"))
    fill(spark, src, [("A", 999.0, 50, 1000, 1.0, 5)], run_of("A", [1]))
    live = streams.open_stream(spark, "parquet", path=src, schema=READING, max_files=1)
    jobs.start_intake(live, good, bad, folder + "/cp", bounds=Bounds(timestamp_max_lag_sec=10 ** 9), late_path=late).awaitTermination()
    assert spark.read.parquet(good).count() == 1 and spark.read.parquet(bad).count() == 1
