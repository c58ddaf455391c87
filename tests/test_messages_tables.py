from __future__ import annotations

import json
from datetime import datetime

import pyarrow as pa
import pytest
from helpers import agg_row, aggs, at, dicts, plan_of
from pyspark.sql import functions as F

from obsweave.schemas import AGGREGATE, REQUEST, conform, empty_frame, frame_of
from obsweave.sinks import tables
from obsweave.sources import files, messages

EPOCH = datetime(1970, 1, 1)


def decode(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    d = messages.decode_aggregates(df)
    return d.good.collect(), d.dead.collect()


FULL = agg_row("Turku") | {"window_start": "2025-03-09T06:30:00", "window_end": "2025-03-09T06:45:00"}


@pytest.mark.parametrize("start,want", [
    ("2024-01-01T00:00:00", datetime(2024, 1, 1)),
    ("2024-01-01T00:00:00Z", datetime(2024, 1, 1)),
    ("2024-01-01T03:00:00.250+03:00", datetime(2024, 1, 1, 0, 0, 0, 250000)),
    ("2024-01-01", datetime(2024, 1, 1)),
    (1700000000, datetime(2023, 11, 14, 22, 13, 20)),
    (1700000000.5, datetime(2023, 11, 14, 22, 13, 20, 500000)),
    (2024, datetime(1970, 1, 1, 0, 33, 44)),
    (0, EPOCH),
])
def test_time_encodings(spark, start, want):
    good, dead = decode(spark, json.dumps({**FULL, "window_start": start}))
    assert not dead and good[0].window_start == want


def test_missing_keys_take_defaults(spark):
    good, dead = decode(spark, "{}")
    assert not dead
    assert tuple(good[0]) == ("", EPOCH, EPOCH, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "")


def test_numbers_are_coerced(spark):
    good, _ = decode(spark, json.dumps({**FULL, "count": 7.9, "avg_temp": "-2.25", "min_temp": -4}))
    assert (good[0]["count"], good[0].avg_temp, good[0].min_temp) == (7, -2.25, -4.0)


@pytest.mark.parametrize("text,reason", [
    ('{"city": "Tur', "not a JSON object"), ("", "not a JSON object"), ("7", "not a JSON object"), (None, "not a JSON object"),
    (json.dumps({**FULL, "count": "many"}), "bad count"), (json.dumps({**FULL, "count": None}), "bad count"),
    (json.dumps({**FULL, "avg_temp": "warm"}), "bad avg_temp"), (json.dumps({**FULL, "window_end": "noon"}), "bad window_end"),
    (json.dumps({**FULL, "window_start": None}), "bad window_start"),
])
def test_bad_messages_become_dead_letters(spark, text, reason):
    good, dead = decode(spark, text, json.dumps(FULL))
    assert len(good) == 1
    assert [(r.value, r.reason) for r in dead] == [(text, reason)]


def test_message_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value STRING")
    assert plan_of(messages.decode_aggregates(df).good).count("from_json") <= 2    # once, named once in the output


def test_encode_then_decode_gives_the_row_back(spark):
    df = aggs(spark, agg_row(), agg_row("B", start=0.0025, minutes=1.00001), agg_row("C", temp=-0.1))
    kv = messages.key_value(df)
    assert {r.key for r in kv.collect()} == {"Turku", "B", "C"}
    first = json.loads(kv.where("key = 'Turku'").first().value)
    assert first["window_start"] == "2024-06-01T00:00:00" and list(first) == AGGREGATE.names
    good, dead = messages.decode_aggregates(kv.select("value"))
    assert sorted(good.collect()) == sorted(df.collect()) and dead.count() == 0


PAYLOAD = {"id": 8, "name": "Tartu", "dt": 1720000000,
           "main": {"temp": -3.25, "feels_like": -7.0, "temp_min": -4.5, "temp_max": -1.5, "pressure": 991, "humidity": 88},
           "wind": {"speed": 9.5, "deg": 275}, "clouds": {"all": 90},
           "weather": [{"description": "sleet", "icon": "13n"}, {"description": "fog", "icon": "50n"}],
           "coord": {"lat": 58.375, "lon": 26.75}, "sys": {"country": "EE"}}


def test_flatten_payload(spark):
    texts = [PAYLOAD, {**PAYLOAD, "weather": []}, {k: v for k, v in PAYLOAD.items() if k not in ("coord", "wind", "sys")}, {},
             {**PAYLOAD, "wind": None, "more": [1]}]
    df = spark.createDataFrame([(i, json.dumps(t), at(0)) for i, t in enumerate(texts)], "i INT, value STRING, seen TIMESTAMP")
    rows = messages.flatten_payload(df, collected_at="seen", shard_id="'s7'").orderBy("i").collect()
    r = rows[0]
    assert (r.city, r.country, r.lat, r.temperature, r.pressure, r.wind_deg, r.clouds_all, r.description, r.shard_id) == (
        "Tartu", "EE", 58.375, -3.25, 991, 275, 90, "sleet", "s7")
    assert r.collected_at == at(0).replace(tzinfo=None)
    assert rows[1].description == "" and (rows[2].lat, rows[2].wind_speed, rows[2].country) == (0.0, 0.0, "")
    assert (rows[3].city, rows[3].pressure, rows[3].description) == ("", 0, "")
    assert (rows[4].city, rows[4].wind_speed, rows[4].wind_deg) == ("Tartu", 0.0, 0)


def test_payloads_that_cannot_be_read_are_dead_letters(spark):
    main = PAYLOAD["main"]
    broken = [json.dumps(t) for t in (
        {**PAYLOAD, "main": {**main, "temp": "abc"}}, {**PAYLOAD, "main": {**main, "humidity": "hot"}},
        {**PAYLOAD, "main": {**main, "pressure": 991.5}}, {**PAYLOAD, "main": 5}, {**PAYLOAD, "coord": [1, 2]},
        {**PAYLOAD, "weather": "sleet"}, {**PAYLOAD, "wind": {"speed": "9.5"}}, [PAYLOAD], 7)]
    broken += [json.dumps(PAYLOAD)[:70], "", "no json", None]
    df = spark.createDataFrame([(i, t, at(0), "s") for i, t in enumerate([*broken, json.dumps(PAYLOAD)])],
                               "i INT, value STRING, collected_at TIMESTAMP, shard_id STRING")
    good, dead = messages.split_payloads(df)
    assert [r.i for r in good.collect()] == [len(broken)]
    rows = sorted(dead.collect(), key=lambda r: r.i)
    assert [r.i for r in rows] == list(range(len(broken)))
    assert [r.value for r in rows] == broken
    assert {r.reason for r in rows} == {"payload cannot be read", "no payload"}


def stored(spark, path):
    return files.load_parquet(spark, path, partition=files.PARTITION_DATE).select(*AGGREGATE.names)


def test_missing_table_is_empty_with_schema(spark, folder):
    df = files.load_parquet(spark, folder + "/none")
    assert df.count() == 0 and df.schema == AGGREGATE
    assert empty_frame(spark).schema == AGGREGATE


def test_unreadable_table_is_an_error(spark, folder):
    with open(folder + "/x.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        files.load_parquet(spark, folder + "/x.parquet").collect()


def test_save_load_and_replace(spark, folder):
    path = folder + "/a/b/table"
    df = aggs(spark, agg_row(), agg_row("B", start=1500))
    tables.save_parquet(df, path)
    assert sorted(stored(spark, path).collect()) == sorted(df.collect())
    tables.save_parquet(aggs(spark, agg_row("C", start=3000)), path)
    assert [r.city for r in stored(spark, path).collect()] == ["C"]


def test_date_filter_skips_partitions(spark, folder):
    from obsweave.operators.select import timeline
    path = folder + "/table"
    tables.save_parquet(aggs(spark, *[agg_row("A", start=i * 1440) for i in range(5)]), path)
    df = files.load_parquet(spark, path, partition=files.PARTITION_DATE)
    out = timeline(df, ["A"], 24, as_of=at(4 * 1440 + 10), longest_window="1 HOUR")
    assert "PartitionFilters: [isnotnull(window_date" in plan_of(out)
    assert out.count() == 1


def test_upsert_keeps_latest_and_is_idempotent(spark, folder):
    path = folder + "/table"
    first = aggs(spark, agg_row("A", 0, 1, temp=1.0), agg_row("A", 1500, temp=2.0))
    second = aggs(spark, agg_row("A", 0, 2, temp=3.0), agg_row("B", 0, temp=4.0), agg_row("B", 0, temp=3.5))
    tables.upsert_parquet(first, path)
    for _ in range(2):
        tables.upsert_parquet(second, path)
        got = {(r.city, r.window_start): r.avg_temp for r in stored(spark, path).collect()}
        assert len(got) == stored(spark, path).count() == 3
        assert got[("A", at(0).replace(tzinfo=None))] == 3.0
        assert got[("B", at(0).replace(tzinfo=None))] == 4.0
    tables.upsert_parquet(aggs(spark, agg_row("A", 0, 1, temp=9.0)), path)       # older end: ignored
    assert stored(spark, path).where("avg_temp = 9").count() == 0
    tables.upsert_parquet(aggs(spark, agg_row("A", 0, 2, temp=8.0)), path)       # same end: the new one wins
    assert stored(spark, path).where("avg_temp = 8").count() == 1
    tables.upsert_parquet(aggs(spark), path)
    assert stored(spark, path).count() == 3


def test_upsert_rewrites_only_touched_dates(spark, folder):
    import glob
    path = folder + "/table"
    tables.upsert_parquet(aggs(spark, *[agg_row("A", i * 1440) for i in range(3)]), path)

    def names():
        return {p.split("window_date=")[1] for p in glob.glob(path + "/window_date=*/*.parquet")}

    before = names()
    tables.upsert_parquet(aggs(spark, agg_row("B", 1440)), path)
    assert {n for n in before if not n.startswith("2024-06-02")} <= names()
    assert len(names() - before) >= 1


def test_upsert_over_several_dates(spark, folder):
    path = folder + "/table"
    tables.upsert_parquet(aggs(spark, *[agg_row("A", i * 1440) for i in range(4)]), path)
    tables.upsert_parquet(aggs(spark, *[agg_row("A", i * 1440, 2, temp=7.0) for i in range(1, 3)]), path)
    assert sorted(r.avg_temp for r in stored(spark, path).collect()) == [7.0, 7.0, 12.0, 12.0]


def test_jsonl_appends_and_keeps_nulls(spark, folder):
    path = folder + "/log"
    rows = [{"city": "A", "response_time_ms": 1.5, "error": None}, {"city": "B", "error": "timeout"}]
    for _ in range(2):
        tables.append_jsonl(frame_of(spark, rows, REQUEST), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 4 and all("error" in x for x in lines)
    assert spark.read.schema(REQUEST).json(path).where("error IS NULL").count() == 2


def test_arrow_export(spark):
    df = aggs(spark, *[agg_row("Turku" if i < 3 else "Perth", start=i + 0.01) for i in range(5)]).withColumn(
        "seq", F.unix_micros("window_start"))
    out = tables.to_arrow(df, "seq", rows=1000)
    assert out.num_rows == 5 and out.column_names == AGGREGATE.names
    assert out.schema.field("count").type == pa.int32()
    assert pa.types.is_timestamp(out.schema.field("window_start").type) and out.schema.field("window_start").type.unit == "s"
    assert [tables.to_arrow(df, "seq", c, rows=1000).num_rows for c in ("Turku", "Bergen", "all")] == [3, 0, 5]
    assert tables.to_arrow(df, "seq", rows=3).num_rows == 3
    assert tables.to_arrow(df, "seq", "Turku", rows=3).num_rows == 1


def test_epoch_seconds_there_and_back(spark):
    df = aggs(spark, agg_row())
    seconds = tables.to_epoch(df)
    assert seconds.first().window_start == int(at(0).timestamp())
    assert tables.from_epoch(seconds).collect() == df.collect()


def test_newest_result_file(spark, folder):
    for stamp, rps in (("20230105_101500", 1.0), ("20231102_080910", 812.5), ("20230611_235959", 2.0)):
        runs = [{"name": n, "total_requests": 40, "throughput_rps": r} for n, r in (("a", rps), ("b", 3.25))]
        with open(f"{folder}/bench_{stamp}.json", "w") as f:
            json.dump({"timestamp": stamp, "results": runs}, f, indent=2)
    with open(f"{folder}/zzz.json", "w") as f:
        f.write("{}")
    got = {r["name"]: r for r in dicts(files.newest_results(spark, folder))}
    assert got["a"]["throughput_rps"] == 812.5 and got["b"]["total_requests"] == 40 and got["a"]["failed"] is None
    with pytest.raises(FileNotFoundError):
        files.newest_results(spark, folder, "nothing_*.json")


def test_frames_from_records_and_conform(spark):
    df = frame_of(spark, [FULL | {"window_start": at(0), "window_end": at(1)}])
    assert df.schema == AGGREGATE
    other = df.selectExpr("CAST(count AS INT) AS count", "city", "1 AS extra")
    assert conform(other).schema == AGGREGATE and conform(other).first().avg_temp is None
    assert frame_of(spark, []).schema == AGGREGATE


def test_upsert_keeps_columns_that_a_batch_lacks(spark, folder):
    path = folder + "/t"
    tables.upsert_parquet(aggs(spark, agg_row("A", 0), agg_row("B", 0)).withColumn("extra", F.lit(7)), path)
    tables.upsert_parquet(aggs(spark, agg_row("A", 0, 1)).withColumn("other", F.lit("x")), path)
    rows = {r.city: (r.extra, r.other) for r in spark.read.option("mergeSchema", "true").parquet(path).collect()}
    assert rows == {"A": (None, "x"), "B": (7, None)}
