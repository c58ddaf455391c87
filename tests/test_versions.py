"""Versioned tables: whole versions, stopped writes, schemas, pruning."""

from __future__ import annotations

import glob
import json

import pytest
from helpers import agg_row, aggs, at, plan_of
from pyspark.sql import functions as F

from obsweave.operators.select import timeline
from obsweave.schemas import AGGREGATE
from obsweave.sinks import versions
from obsweave.sources import files


def rows(spark, path):
    return sorted(versions.load_table(spark, path).select("city", "window_start", "avg_temp").collect())


def test_upsert_keeps_the_latest_and_can_be_repeated(spark, folder):
    path = folder + "/a/table"
    first = aggs(spark, agg_row("A", 0, 1, temp=1.0), agg_row("A", 1500, temp=2.0))
    second = aggs(spark, agg_row("A", 0, 2, temp=3.0), agg_row("B", 0, temp=4.0), agg_row("B", 0, temp=3.5))
    assert versions.upsert_table(first, path) == 1
    for _ in range(2):
        versions.upsert_table(second, path)
        got = {(r.city, r.window_start): r.avg_temp for r in versions.load_table(spark, path).collect()}
        assert got == {("A", at(0).replace(tzinfo=None)): 3.0, ("A", at(1500).replace(tzinfo=None)): 2.0,
                       ("B", at(0).replace(tzinfo=None)): 4.0}
    versions.upsert_table(aggs(spark, agg_row("A", 0, 1, temp=9.0)), path)      # older end
    assert 9.0 not in [r.avg_temp for r in versions.load_table(spark, path).collect()]
    versions.upsert_table(aggs(spark, agg_row("A", 0, 2, temp=8.0)), path)      # same end
    assert 8.0 in [r.avg_temp for r in versions.load_table(spark, path).collect()]
    assert versions.upsert_table(aggs(spark), path) is None
    assert files.load_parquet(spark, path, partition=files.PARTITION_DATE).count() == 3


@pytest.mark.parametrize("stop_at", ["_write", "_publish", "_clean"])
def test_a_write_that_stops_leaves_a_whole_version(spark, folder, monkeypatch, stop_at):
    path = folder + "/t"
    versions.upsert_table(aggs(spark, *[agg_row("A", i * 1440, temp=float(i)) for i in range(3)]), path)
    before = rows(spark, path)
    batch = aggs(spark, *[agg_row("A", i * 1440, 2, temp=50.0) for i in range(2)])
    real = getattr(versions, stop_at)

    def stop(*args):
        if stop_at == "_write":
            real(*args)     # files are there, the manifest is not
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versions, stop_at, stop)
        with pytest.raises(RuntimeError):
            versions.upsert_table(batch, path)
    done = [r.avg_temp for r in rows(spark, path)] == [50.0, 50.0, 2.0]
    assert done if stop_at == "_clean" else rows(spark, path) == before
    versions.upsert_table(batch, path)
    assert [r.avg_temp for r in rows(spark, path)] == [50.0, 50.0, 2.0]


def test_readers_keep_their_version_while_the_table_changes(spark, folder):
    path = folder + "/t"
    versions.upsert_table(aggs(spark, agg_row("A", 0, temp=1.0), agg_row("A", 1440, temp=2.0)), path)
    reader = versions.load_table(spark, path)
    versions.upsert_table(aggs(spark, agg_row("A", 0, 2, temp=5.0)), path)
    assert sorted(r.avg_temp for r in reader.collect()) == [1.0, 2.0]
    assert sorted(r.avg_temp for r in versions.load_table(spark, path).collect()) == [2.0, 5.0]
    for i in range(3):
        versions.upsert_table(aggs(spark, agg_row("A", 0, 3 + i, temp=6.0 + i)), path)
    kept = glob.glob(path + "/v=*/window_date=2024-06-01")
    assert len(kept) == 2 and len(glob.glob(path + "/v=*/window_date=2024-06-02")) == 1
    assert len(glob.glob(path + "/_versions/*.json")) == 2
    assert sorted(r.avg_temp for r in versions.load_table(spark, path).collect()) == [2.0, 8.0]


def test_two_writers_do_not_lose_rows(spark, folder, monkeypatch):
    path = folder + "/t"
    versions.save_table(aggs(spark, agg_row("A", 0)), path)
    real = versions._publish

    def late(spark_, path_, m):
        monkeypatch.setattr(versions, "_publish", real)
        versions.create_file(spark_, f"{path_}/_versions/{m.version:012d}.json", "{}")
        real(spark_, path_, m)

    monkeypatch.setattr(versions, "_publish", late)
    with pytest.raises(versions.Conflict):
        versions.upsert_table(aggs(spark, agg_row("B", 0)), path)


def test_columns_and_types(spark, folder):
    path = folder + "/t"
    versions.upsert_table(aggs(spark, agg_row("A", 0), agg_row("B", 0)).withColumn("extra", F.lit(7)), path)
    versions.upsert_table(aggs(spark, agg_row("A", 0, 1)).withColumn("other", F.lit("x")), path)
    assert {r.city: (r.extra, r.other) for r in versions.load_table(spark, path).collect()} == {"A": (None, "x"), "B": (7, None)}
    narrow = aggs(spark, agg_row("C", 3000)).withColumn("count", F.col("count").cast("int"))
    versions.upsert_table(narrow, path)
    assert versions.load_table(spark, path).schema["count"].dataType.simpleString() == "bigint"
    wide = aggs(spark, agg_row("D", 3000)).withColumn("extra", F.lit(7).cast("bigint"))
    with pytest.raises(ValueError, match="extra is stored as int and arrives as bigint"):
        versions.upsert_table(wide, path)
    assert versions.load_table(spark, path).count() == 3


def test_null_and_odd_partitions(spark, folder):
    path = folder + "/t"
    part = ("kind", "substring(city, 1, 3)")
    data = aggs(spark, agg_row("a/b", 0), agg_row(None, 0), agg_row("ü=%", 0))
    versions.upsert_table(data, path, ("city",), partition=part)
    versions.upsert_table(aggs(spark, agg_row(None, 1, temp=5.0), agg_row("a/b", 1, temp=6.0)), path, ("city",), partition=part)
    got = {r.city: r.avg_temp for r in versions.load_table(spark, path).collect()}
    assert got == {"a/b": 6.0, None: 5.0, "ü=%": 12.0}


def test_recent_rows_are_found_without_being_told_the_window(spark, folder):
    path = folder + "/t"
    versions.save_table(aggs(spark, *[agg_row(c, start=i * 1440, minutes=60) for i in range(5) for c in "AB"]), path)
    assert versions.longest_window(spark, path) == "3600000000 MICROSECONDS"
    out = timeline(versions.load_table(spark, path), ["A"], 24, as_of=at(4 * 1440 + 70),
                   longest_window=versions.longest_window(spark, path))
    assert "PartitionFilters: [isnotnull(window_date" in plan_of(out)
    assert out.count() == 1
    versions.upsert_table(aggs(spark, agg_row("A", 0, 3000)), path)
    assert versions.longest_window(spark, path) == f"{3000 * 60_000_000} MICROSECONDS"


def test_row_groups_of_other_cities_are_skipped(spark, folder):
    import pyarrow.parquet as pq
    path = folder + "/t"
    versions.save_table(aggs(spark, *[agg_row(f"c{i}", start=i) for i in range(40)]), path)
    (name,) = glob.glob(path + "/v=1/window_date=*/*.parquet")
    with open(name, "rb") as f:
        column = pq.ParquetFile(f).metadata.row_group(0).column(0)
    assert column.path_in_schema == "city"
    df = versions.load_table(spark, path).where("city = 'c11x'")    # between the least and the largest
    assert "EqualTo(city,c11x)" in plan_of(df)
    rows_out = [m for m in _metrics(df) if "numOutputRows" in m]
    assert rows_out and all(m["numOutputRows"] == 0 for m in rows_out)


def _metrics(df):
    """Numbers of rows that the scans gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName():
            out.append({"numOutputRows": node.metrics().apply("numOutputRows").value()})
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
    return out


def test_schema_is_not_read_from_files(spark, folder):
    path = folder + "/t"
    versions.save_table(aggs(spark, agg_row("A", 0)), path)
    (name,) = glob.glob(path + "/_versions/*.json")
    assert [f["name"] for f in json.load(open(name))["schema"]["fields"]] == AGGREGATE.names
