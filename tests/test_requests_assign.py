from __future__ import annotations

import random

import pytest
from helpers import dicts

from obsweave.operators import assign, ranks, requests, reshape
from obsweave.plans.catalog import METRICS

LOG = "name STRING, round INT, response_time_ms DOUBLE, error STRING"


def index_percentile(values, p):
    values = sorted(values)
    return round(values[min(int(len(values) * p / 100), len(values) - 1)], 2)


def test_latency_summary(spark):
    random.seed(3)
    a = [round(random.expovariate(0.1), 2) for _ in range(150)]
    log = spark.createDataFrame([("a", 1, v, None if i % 5 else "timeout") for i, v in enumerate(a)]
                                + [("b", 1, 7.5, None)], LOG)
    got = {r["name"]: r for r in dicts(requests.latency_summary(log, "max(round) * 2"))}
    assert (got["a"]["total_requests"], got["a"]["successful"], got["a"]["failed"]) == (150, 120, 30)
    assert got["a"]["throughput_rps"] == 75.0 and got["a"]["total_time_sec"] == 2.0
    for p in (50, 95, 99):
        assert got["a"][f"p{p}_latency_ms"] == index_percentile(a, p)
        assert got["b"][f"p{p}_latency_ms"] == 7.5
    assert got["a"]["avg_latency_ms"] == pytest.approx(sum(a) / 150, abs=0.0051)
    assert (got["a"]["min_latency_ms"], got["a"]["max_latency_ms"]) == (min(a), max(a))
    sequential = {r["name"]: r for r in dicts(requests.latency_summary(log))}
    assert sequential["b"]["throughput_rps"] == 133.33


def test_run_without_latencies(spark):
    log = spark.createDataFrame([("a", 1, None, "timeout")], LOG)
    (row,) = dicts(requests.latency_summary(log, "0"))
    assert (row["avg_latency_ms"], row["p99_latency_ms"], row["throughput_rps"]) == (0.0, 0.0, None)


def test_request_stats_counts_only_successes(spark):
    log = spark.createDataFrame([("a", 1, 10.0, None), ("a", 1, 90.0, "x"), ("a", 1, 11.0, None), ("a", 2, 5.0, "x")], LOG)
    got = {r["round"]: r for r in dicts(requests.request_stats(log))}
    assert got[1] == {"round": 1, "total": 3, "success": 2, "errors": 1, "avg_response_ms": 10.5}
    assert got[2]["avg_response_ms"] == 0.0


def test_ratio_and_rates(spark):
    runs = spark.createDataFrame([("a", 9, 1, 812.5), ("b", 3, 0, 3.25), ("none", 0, 0, 10.0)],
                                 "name STRING, successful BIGINT, failed BIGINT, throughput_rps DOUBLE")
    assert dicts(requests.throughput_ratio(runs.where("name <> 'none'"))) == [{"winner": "a", "ratio": 250.0}]
    assert requests.throughput_ratio(runs.limit(1)).count() == 0
    stopped = runs.selectExpr("name", "CASE name WHEN 'a' THEN 0D ELSE throughput_rps END AS throughput_rps")
    assert requests.throughput_ratio(stopped).count() == 0
    assert {r["name"]: (r["success_pct"], r["failure_pct"]) for r in dicts(requests.success_rate(runs))} == {
        "a": (90.0, 10.0), "b": (100.0, 0.0)}


def test_metric_matrix(spark):
    log = spark.createDataFrame([("a", 1, 10.0, None), ("b", 1, 20.0, "x")], LOG)
    rows = {r["metric"]: r for r in dicts(reshape.metric_matrix(requests.latency_summary(log), METRICS, ["a", "b"]))}
    assert len(rows) == 9
    assert (rows["p50_latency_ms"]["a"], rows["p50_latency_ms"]["b"], rows["failed"]["b"]) == (10.0, 20.0, 1.0)


def test_order_statistics_of_one_hot_group(spark):
    df = spark.range(50_000).selectExpr("IF(id % 10 = 0, concat('k', id % 7), 'hot') AS k", "(id * 7919 % 50021) / 100D AS v")
    got = {r["k"]: r for r in dicts(requests.indexed_percentiles(df, ["k"], "v"))}
    values = {}
    for r in df.collect():
        values.setdefault(r.k, []).append(r.v)
    for k, vs in values.items():
        assert [got[k][f"p{p}_latency_ms"] for p in (50, 95, 99)] == [index_percentile(vs, p) for p in (50, 95, 99)]


def shards(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "shard STRING")


def test_round_robin(spark):
    items = spark.createDataFrame(list(enumerate("ABCDEF")), "pos INT, item STRING")

    def of(me, *ids):
        return "".join(r.item for r in assign.assigned_to(items, shards(spark, *ids), me).orderBy("pos").collect())

    assert of("s1", "s2", "s0", "s1") == "BE"
    assert (of("s0", "s0", "s1"), of("s1", "s0", "s1")) == ("ACE", "BDF")
    assert of("s0", "s0") == "ABCDEF"
    assert of("s9", "s0", "s1") == "ABCDEF"
    assert of("s0") == "ABCDEF"
    dealt = assign.assign_round_robin(items, shards(spark, "s2", "s0", "s1")).orderBy("pos").collect()
    assert [r.shard for r in dealt] == ["s0", "s1", "s2"] * 2
    assert [r.shard for r in assign.assign_round_robin(items, shards(spark)).collect()] == [None] * 6


def test_lookup(spark):
    dim = spark.createDataFrame([("london", "GB", 51.5), ("tokyo", "JP", 35.7)], "name STRING, country STRING, lat DOUBLE")
    asked = spark.createDataFrame([(0, " LONDON "), (1, "atlantis"), (2, "Tokyo"), (3, None)], "i INT, q STRING")
    got = assign.dim_lookup(asked, dim, "q", "name", {"country": "", "lat": 0.0}).orderBy("i").collect()
    assert [(r.found, r.country, r.lat) for r in got] == [
        (True, "GB", 51.5), (False, "", 0.0), (True, "JP", 35.7), (False, "", 0.0)]
    assert assign.lookup_one(dim, "name", "TOKYO").count() == 1
    assert assign.lookup_one(dim, "name", "Atlantis").count() == 0


def test_lookup_with_doubled_and_padded_keys(spark):
    from obsweave.operators import assign, select

    dim = spark.createDataFrame([("Oslo", 1), ("OSLO", 2), (None, 3)], "name STRING, v INT")
    asked = spark.createDataFrame([("\toslo ",), ("x",), (None,)], "k STRING")
    got = sorted((str(r.k), r.found, r.v) for r in assign.dim_lookup(asked, dim, "k", "name", {"v": 0}).collect())
    assert got == [("\toslo ", True, 2), ("None", False, 0), ("x", False, 0)]
    items = spark.createDataFrame([(0,), (None,)], "pos INT")
    shards = spark.createDataFrame([("s0",)], "shard STRING")
    assert {r.pos: r.shard for r in assign.assign_round_robin(items, shards).collect()} == {0: "s0", None: None}
    many = spark.range(30_000).selectExpr("IF(id % 10 = 0, NULL, id) AS id", "timestamp_seconds(id) AS at")
    assert [select.sample_n(many, n, "id").count() for n in (9_000, 30_000, 40_000)] == [9_000, 30_000, 30_000]
    assert select.retain_last_n(many, 12_000, "at").count() == 12_000


def test_histogram_with_nan_and_null_key(spark):
    from obsweave.operators import aggregate

    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", float("nan")), (None, 5.0)], "city STRING, avg_temp DOUBLE")
    rows = aggregate.histogram(df, bins=2).collect()
    assert sum(r.n for r in rows if r.city == "a") == 2 and sum(r.n for r in rows if r.city is None) == 1
    assert all(r.bin_start == r.bin_start for r in rows)
