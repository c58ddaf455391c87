from __future__ import annotations

import math
import random
import statistics

import numpy as np
import pytest
from helpers import agg_row, aggs, at, dicts, optimized, plan_of
from pyspark.sql import functions as F

from obsweave.functions import numeric
from obsweave.functions.comfort import register_sql_functions
from obsweave.operators import aggregate as agg
from obsweave.operators import latest, ranks, reshape, rolling, select, sqltext


def test_enrich(spark):
    df = aggs(spark, agg_row(temp=15.0), agg_row("B", minutes=1.5, temp=None), agg_row("C", temp=-60.0))
    got = {r["city"]: r for r in dicts(select.enrich(df))}
    assert got["Turku"]["temp_range"] == 4.0
    assert got["Turku"]["window_duration_sec"] == 60
    assert got["Turku"]["comfort_index"] == 87.1        # 100 - 6 - 2.4 - 4.5
    assert got["B"]["comfort_index"] is None and got["B"]["temp_range"] is None
    assert got["B"]["window_duration_sec"] == 90
    assert got["C"]["comfort_index"] == 0.0


def test_duration_is_cut_to_whole_seconds(spark):
    (row,) = dicts(select.enrich(aggs(spark, agg_row(minutes=60.9 / 60))))
    assert row["window_duration_sec"] == 60


def test_comfort_of_nan_is_nan_and_sql_function_agrees(spark):
    df = aggs(spark, agg_row(temp=15.0), agg_row("B", temp=None), agg_row("C", temp=float("nan")), agg_row("D", temp=-99.0))
    register_sql_functions(spark)
    both = select.enrich(df).selectExpr(
        "comfort_index AS a", "comfort_index(avg_temp, avg_humidity, avg_wind_speed) AS b").collect()
    assert all(r.a == r.b or (math.isnan(r.a) and math.isnan(r.b)) for r in both if r.a is not None)
    assert sum(r.a is None and r.b is None for r in both) == 1


def test_city_mean_is_not_weighted(spark):
    df = aggs(spark, agg_row(temp=10.0, count=1), agg_row(start=1, temp=20.0, count=99))
    (row,) = dicts(agg.city_summary(df))
    assert (row["overall_avg_temp"], row["window_count"], row["total_readings"]) == (15.0, 2, 100)
    assert row["avg_comfort"] is None
    assert dicts(agg.city_summary(select.enrich(df)))[0]["avg_comfort"] == 83.1   # of 77.1 and 89.1


def test_summary_of_nothing_has_the_columns(spark):
    out = agg.city_summary(aggs(spark))
    assert out.count() == 0 and "overall_avg_temp" in out.columns


def test_top_cities_order_and_ties(spark):
    df = aggs(spark, agg_row("Turku", temp=5.0), agg_row("Perth", temp=25.0), agg_row("Bergen", temp=5.0))
    assert [r.city for r in agg.top_cities_by_temp(df, 3).collect()] == ["Perth", "Bergen", "Turku"]
    assert agg.top_cities_by_temp(df, 1).count() == 1
    assert "TakeOrderedAndProject" in plan_of(agg.top_cities_by_temp(df, 1))


def test_hourly_stats_uses_window_start(spark):
    df = aggs(spark, agg_row(start=59, minutes=2, temp=10.0), agg_row(start=61, temp=20.0))
    assert [(r.hour_of_day, r.avg_temp, r.samples) for r in agg.hourly_stats(df).collect()] == [(0, 10.0, 1), (1, 20.0, 1)]
    assert [r.hour for r in agg.humidity_by_hour(df).collect()] == [1]


def test_percentiles_interpolate(spark):
    random.seed(1)
    values = {c: [round(random.gauss(m, 9), 2) for _ in range(n)] for c, m, n in [("A", 3, 101), ("B", -50, 2), ("C", 0, 1)]}
    df = aggs(spark, *[agg_row(c, start=i, temp=v) for c, vs in values.items() for i, v in enumerate(vs)])
    got = {r["city"]: r for r in dicts(agg.temperature_percentiles(df))}
    for city, vs in values.items():
        for name, p in agg.PERCENTILES.items():
            assert got[city][name] == pytest.approx(float(np.percentile(vs, p * 100)), abs=0.0051)
    assert [r.city for r in agg.temperature_percentiles(df).collect()][-1] == "B"
    approx = {r["city"]: r for r in dicts(agg.temperature_percentiles(df, approximate=True))}
    assert approx["C"]["median"] == got["C"]["median"]


def test_anomalies(spark):
    temps = [10.0, 11.0] * 10 + [40.0]
    df = aggs(spark, *[agg_row("A", start=i, temp=t) for i, t in enumerate(temps)],
              agg_row("alone", temp=99.0), agg_row("flat", temp=1.0), agg_row("flat", start=1, temp=1.0),
              agg_row(None, temp=500.0))
    (row,) = dicts(agg.anomalies(df))
    z = abs(40.0 - statistics.mean(temps)) / statistics.stdev(temps)
    assert (row["city"], row["avg_temp"], row["z_score"]) == ("A", 40.0, round(z, 2))
    assert agg.anomalies(df, z_threshold=z + 1).count() == 0


def test_anomalies_join_without_shuffling_the_table(spark):
    df = spark.range(1000).selectExpr("concat('c', id % 5) AS city", "timestamp_seconds(id) AS window_start",
                                      "CAST(id % 17 AS DOUBLE) AS avg_temp")
    plan = plan_of(agg.anomalies(df))
    assert "BroadcastHashJoin" in plan
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")     # the statistics are larger than this
    try:
        beyond = agg.anomalies(df)
        assert "BroadcastHashJoin" not in plan_of(beyond)
        few = sorted(beyond.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert few == sorted(agg.anomalies(df).collect())


def test_histogram_matches_numpy(spark):
    random.seed(7)
    values = {"A": [round(random.uniform(-9, 31), 2) for _ in range(500)] + [0.1 * i for i in range(50)],
              "B": [2.0, 2.0, 2.0], "C": [1.0, 2.0]}
    df = aggs(spark, *[agg_row(c, start=i, temp=v) for c, vs in values.items() for i, v in enumerate(vs)],
              agg_row("A", start=-1, temp=None))
    got = {}
    for r in agg.histogram(df).collect():
        got.setdefault(r.city, []).append(r.n)
    for city, vs in values.items():
        assert got[city] == np.histogram(vs, bins=15)[0].tolist(), city


def test_pivot_has_every_hour_and_leaves_gaps(spark):
    df = aggs(spark, agg_row(start=0, avg_humidity=50.0), agg_row(start=10, avg_humidity=51.0), agg_row("B", start=23 * 60))
    got = {r["city"]: r for r in dicts(reshape.humidity_pivot(df))}
    assert len(got["B"]) == 25
    assert (got["Turku"]["h0"], got["Turku"]["h5"], got["B"]["h23"]) == (50.5, None, 58.0)


def test_rolling_mean_by_rows(spark):
    df = aggs(spark, *[agg_row(start=i, temp=t) for i, t in enumerate([10.0, 20.0, 30.0])])
    assert [r.rolling_avg_temp_2w for r in rolling.rolling_mean(df, 2).collect()] == [10.0, 15.0, 25.0]
    assert [r.rolling_avg_temp_1w for r in rolling.rolling_mean(df, 1).collect()] == [10.0, 20.0, 30.0]


@pytest.mark.parametrize("n", [2, 3, 5, 40])
@pytest.mark.parametrize("chunk", ["minute", "hour", "day"])
def test_rolling_mean_across_chunks_equals_plain_window(spark, n, chunk):
    random.seed(n)
    rows = [agg_row(c, start=random.choice([i, i * 17, i * 300]), temp=random.choice([None, i * 1.5, -i / 3]))
            for i in range(60) for c in ("A", "B")]
    df = aggs(spark, *rows).dropDuplicates(["city", "window_end"])
    plain = df.selectExpr("city", "window_end", f"avg(avg_temp) OVER (PARTITION BY city ORDER BY window_end "
                          f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS m")
    want = {(r.city, r.window_end): r.m for r in plain.collect()}
    out = rolling.rolling_mean(df, n, chunk=chunk)
    got = {(r.city, r.window_end): r[f"rolling_avg_temp_{n}w"] for r in out.collect()}
    assert out.columns == [*df.columns, f"rolling_avg_temp_{n}w"]
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None and v is None) or got[k] == pytest.approx(v, abs=0.0051)


def test_rolling_mean_is_sorted_by_one_shuffle(spark):
    df = spark.range(2000).selectExpr("concat('c', id % 3) AS city", "timestamp_seconds(id * 977) AS window_end",
                                      "CAST(id % 17 AS DOUBLE) AS avg_temp")
    out = rolling.rolling_mean(df.repartition(5), 1)
    assert plan_of(out).count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan_of(out)
    rows = [(r.city, r.window_end) for r in rolling.rolling_mean(df.repartition(5), 3).collect()]
    assert rows == sorted(rows)


def test_latest_per_key_and_its_aggregate_form(spark):
    df = aggs(spark, agg_row("A", start=1, temp=1.0), agg_row("A", start=5, temp=2.0), agg_row("A", start=5, temp=3.0),
              agg_row("B", start=0, temp=9.0))
    got = {r.city: r.avg_temp for r in latest.latest_per_key(df).collect()}
    assert got == {"A": 3.0, "B": 9.0}
    assert sorted(latest.latest_per_key_agg(df).collect()) == sorted(latest.latest_per_key(df).collect())


def test_latest_sends_one_row_per_key_and_task(spark):
    df = spark.range(100).selectExpr("id % 3 AS city", "id AS window_end", "id AS v")
    before_shuffle = plan_of(latest.latest_per_key(df)).rsplit("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_shuffle


def test_dedup_keeps_latest_end(spark):
    df = aggs(spark, agg_row("A", 0, 1, temp=1.0), agg_row("A", 0, 2, temp=2.0), agg_row("B", 0, 1))
    out = latest.dedup_latest(df)
    assert out.count() == 2
    assert out.where("city = 'A'").first().avg_temp == 2.0


def test_kpis_over_latest_rows(spark):
    df = aggs(spark, agg_row("A", 0, temp=-5.0), agg_row("A", 1, temp=5.0), agg_row("B", 0, temp=-5.0))
    assert dicts(agg.kpi_latest(df)) == [{"avg_temp": 0.0, "avg_humidity": 58.0, "avg_pressure": 987.0, "avg_wind": 3.0}]


def test_counts_and_distinct(spark):
    df = aggs(spark, agg_row("A"), agg_row("A", 1), agg_row("B"), agg_row(None))
    assert dicts(agg.table_counts(df)) == [{"row_count": 4, "cities": 2}]
    assert [r.city for r in agg.distinct_cities(df).collect()] == [None, "A", "B"]
    assert dicts(agg.table_counts(aggs(spark))) == [{"row_count": 0, "cities": 0}]


def test_display_rows(spark):
    df = aggs(spark, *[agg_row("A", i, temp=i + 0.25, avg_humidity=64.5) for i in range(30)])
    rows = select.latest_records(df).collect()
    assert len(rows) == 20
    newest = max(rows, key=lambda r: r.window_end)
    assert (newest.avg_temp, newest.avg_humidity, newest.avg_pressure) == (29.3, 65, 987)


def test_timeline_and_filters(spark):
    df = aggs(spark, agg_row("A", 0), agg_row("A", 100), agg_row("B", 101), agg_row("C", 102))
    got = select.timeline(df, ["A", "B"], 1, as_of=at(103)).collect()
    assert [r.city for r in got] == ["A", "B"]
    assert select.timeline(df, None, None).count() == 4
    assert [select.by_city(df, c).count() for c in ("A", "all", "", None, "Z")] == [2, 4, 4, 4, 0]
    assert select.since(df, 1, as_of="2024-06-01T01:41:00Z").count() == 3


def test_gauges_scatter_and_ranking(spark):
    df = aggs(spark, agg_row("A", temp=18.0, avg_humidity=50.0, avg_wind_speed=0.0), agg_row("B", temp=-70.0),
              agg_row("C", temp=0.0, avg_humidity=50.0, avg_wind_speed=0.0), agg_row("D", temp=18.0))
    gauges = [(r.city, r.comfort, r.band) for r in select.comfort_gauges(df, ["A", "B", "C"]).collect()]
    assert gauges == [("A", 100.0, "green"), ("C", 64.0, "orange"), ("B", 0.0, "red")]
    assert select.comfort_gauges(df, ["A", "B", "C", "D"], show=2).count() == 2
    assert {r.city: r["size"] for r in select.scatter_points(df).collect()}["B"] == 1.0
    assert [r.city for r in select.current_temps(df).collect()] == ["A", "D", "C", "B"]


def test_union_fills_missing_columns(spark):
    a, b = aggs(spark, agg_row()), select.enrich(aggs(spark, agg_row()))
    out = reshape.union_diagonal(a, b)
    assert out.count() == 2 and out.where("temp_range IS NULL").count() == 1


def test_retain_last_n(spark):
    df = spark.range(1000).selectExpr("id * 37 % 1009 - 300 AS seq", "id AS v")
    want = sorted(r.seq for r in df.collect())
    for n in (1, 10, 777, 5000):
        assert [r.seq for r in select.retain_last_n(df, n, "seq").collect()] == want[-n:]


def test_sample_is_exact_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    for n in (0, 7, 400, 1000, 2000):
        a = {r.k for r in select.sample_n(df, n, "k").collect()}
        assert len(a) == min(n, 1000)
        assert a == {r.k for r in select.sample_n(df.repartition(13), n, "k").collect()}
    assert a != {r.k for r in select.sample_n(df, 400, "k", seed=43).collect()}


@pytest.mark.parametrize("kind", ["TIMESTAMP", "DATE", "STRING", "DOUBLE"])
def test_retain_takes_any_sequence_at_any_size(spark, kind):
    value = {"TIMESTAMP": "timestamp_seconds(s)", "DATE": "date_from_unix_date(CAST(s AS INT))",
             "STRING": "lpad(CAST(s AS STRING), 6, '0')", "DOUBLE": "IF(s = 40, double('NaN'), CAST(s AS DOUBLE))"}[kind]
    # one value holds a third of the rows, some have none
    df = spark.range(900).selectExpr("id AS n", "IF(id % 3 = 0, 20, id % 41) AS s").selectExpr(
        "n", f"IF(n % 50 = 1, NULL, {value}) AS seq")
    rows = df.orderBy(F.col("seq").desc(), F.col("n").desc()).collect()
    for n in (0, 300, 5000):
        got = {r.n for r in select.retain_last_n(df, n, "seq").collect()}
        assert got == {r.n for r in rows[:n]}


def test_close_values_of_a_hot_group_fill_many_tasks(spark):
    df = spark.range(40_000).selectExpr("IF(id % 20 = 0, 'cold', 'hot') AS city", "1010D + (id * 7919 % 9901) / 1000D AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = df.groupBy("city", "v").agg(F.expr("count(1) AS n"))
        held = ranks._in_ranges(counts, [F.col("city"), F.col("v")], "t").where("city = 'hot'").groupBy("part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(held) > 2 and max(r["count"] for r in held) < 5000
    got = {r.city: r.m for r in ranks.percentiles(df, ["city"], "v", {"m": 0.5}).collect()}
    want = {r.city: r.m for r in df.groupBy("city").agg(F.expr("percentile(v, 0.5) AS m")).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_percentiles_of_infinities_and_missing_keys(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", 1.0), ("a", inf), ("a", inf), ("a", inf), (None, 2.0), (None, None), ("b", None)],
                               "k STRING, v DOUBLE")
    got = {r.k: (r.low, r.high) for r in ranks.percentiles(df, ["k"], "v", {"low": 0.0, "high": 0.95}).collect()}
    assert got == {"a": (1.0, inf), None: (2.0, 2.0)}


def test_means_neither_overflow_nor_depend_on_order(spark):
    def mean(df, **more):
        return {numeric.summarize(df.repartition(n), [], {"m": ("v", None)}, **more).first().m for n in (1, 4, 13)}

    assert mean(spark.range(10).selectExpr("1.0e-10D AS v"), digits=15) == {1e-10}
    assert mean(spark.range(10_000).selectExpr("CAST(1.7e15 AS BIGINT) AS v")) == {1.7e15}
    assert len(mean(spark.range(999).selectExpr("(id + 0.1D) * 1.37e11D AS v"))) == 1
    assert mean(spark.range(10).selectExpr("IF(id = 3, double('Infinity'), 1D) AS v")) == {float("inf")}
    assert mean(spark.createDataFrame([(None,)], "v DOUBLE")) == {None}
    # far more than one bigint could hold
    assert numeric.summarize(spark.range(30_000_000).selectExpr("8.0e9D AS v"), [], {"m": ("v", None)}).first().m == 8e9


def test_sql_over_frame_and_path(spark, folder):
    df = aggs(spark, agg_row("A"), agg_row("B", temp=1.0))
    df.write.parquet(folder + "/t")
    text = "SELECT city FROM {src} WHERE avg_temp > :t"
    for src in (df, folder + "/t"):
        assert [r.city for r in sqltext.sql_over(spark, text, src, {"t": 10.0}).collect()] == ["A"]


def test_sql_and_dataframe_spelling_give_one_plan(spark):
    df = spark.range(10).selectExpr("concat('c', id % 3) AS city", "CAST(id AS INT) AS avg_temp")
    by_sql = sqltext.sql_over(
        spark, "SELECT city, avg(avg_temp) AS m FROM {src} GROUP BY city ORDER BY m DESC, city", df)
    by_api = df.groupBy("city").agg(F.avg("avg_temp").alias("m")).orderBy(F.col("m").desc(), "city")
    assert by_sql.sameSemantics(by_api)
    assert "Aggregate" in optimized(by_sql)


def test_kelvin(spark):
    df = spark.createDataFrame([(273.15, 300.0)], "a DOUBLE, b DOUBLE")
    assert select.to_celsius(df, ["a"]).first() == (0.0, 300.0)
