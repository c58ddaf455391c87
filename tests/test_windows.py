from __future__ import annotations

import pytest
from helpers import dicts, plan_of, readings
from pyspark.sql import functions as F

from obsweave.operators.windows import tumbling


def test_known_window(spark):
    df = readings(spark, [("Turku", 10.0, 50, 1000, 1.0, 5, "b"), ("Turku", 20.0, 60, 1010, 2.0, 1, "a"),
                          ("Turku", 30.0, 70, 1020, 3.0, 9, "c")])
    (row,) = dicts(tumbling(df))
    assert row["count"] == 3
    assert (row["avg_temp"], row["min_temp"], row["max_temp"]) == (20.0, 10.0, 30.0)
    assert (row["avg_humidity"], row["avg_pressure"], row["avg_wind_speed"]) == (60.0, 1010.0, 2.0)
    assert row["shard_id"] == "a"          # the earliest reading's


def test_one_row_per_city_and_window(spark):
    df = readings(spark, [("A", 1.0, 1, 1, 1.0, 0), ("B", 1.0, 1, 1, 1.0, 59), ("A", 3.0, 1, 1, 1.0, 60)])
    got = {(r["city"], r["window_start"]) for r in dicts(tumbling(df))}
    assert len(got) == 3


def test_mean_is_rounded_half_away_and_min_max_are_not(spark):
    df = readings(spark, [("A", -0.125, 1, 1, 0.125, 0)])
    (row,) = dicts(tumbling(df))
    assert (row["avg_temp"], row["avg_wind_speed"], row["min_temp"]) == (-0.13, 0.13, -0.125)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), 1e12])
def test_values_that_do_not_fit_fall_back(spark, bad):
    df = readings(spark, [("A", bad, 1, 1, 1.0, 0), ("A", 2.0, 1, 1, 1.0, 1)])
    (row,) = dicts(tumbling(df))
    want = (bad + 2.0) / 2
    assert row["avg_temp"] == want or (want != want and row["avg_temp"] != row["avg_temp"])


def test_null_values_do_not_count_towards_the_mean(spark):
    df = readings(spark, [("A", None, None, 1, 1.0, 0), ("A", 2.0, 4, 1, 1.0, 1)])
    (row,) = dicts(tumbling(df))
    assert (row["count"], row["avg_temp"], row["avg_humidity"]) == (2, 2.0, 4.0)


def test_same_result_for_any_partitioning(spark):
    df = spark.range(20_000).selectExpr(
        "id AS reading_id", "concat('c', id % 3) AS city", "(id * 7919 % 9973) / 100 - 40 AS temperature",
        "CAST(id % 100 AS INT) AS humidity", "CAST(900 + id % 99 AS INT) AS pressure", "id % 31 / 3 AS wind_speed",
        "timestamp_seconds(id * 3) AS collected_at", "concat('s', id % 4) AS shard_id")
    one, many = (tumbling(df.repartition(n), "10 minutes").collect() for n in (1, 13))
    assert sorted(one) == sorted(many)


def test_without_shard_nothing_but_hash_aggregates(spark):
    df = readings(spark, [("A", 1.0, 1, 1, 1.0, 0)])
    out = tumbling(df, shard_col=None)
    assert "shard_id" not in out.columns
    assert "SortAggregate" not in plan_of(out)


def test_one_hash_aggregate_and_one_shuffle(spark):
    plan = plan_of(tumbling(readings(spark, [("A", 1.0, 1, 1, 1.0, 0)]), shards=["north"]))
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_shards_listed_or_not_give_the_same(spark):
    rows = [("A", 1.0, 1, 1, 1.0, 9 - i % 10, s) for i, s in enumerate(["b'", "a", "\\", None, "c", "ü", "b'"])]
    df = readings(spark, rows + [("B", 1.0, 1, 1, 1.0, 3, "z"), ("B", 1.0, 1, 1, 1.0, 3, "y"),
                                 ("C", 1.0, 1, 1, 1.0, 1, None), ("C", 1.0, 1, 1, 1.0, 1, "a"),
                                 (None, 1.0, 1, 1, 1.0, 1, "a")])
    listed = sorted(tumbling(df, shards=["b'", "a", "\\", "c", "ü", "y", "z"]).collect(), key=str)
    assert listed == sorted(tumbling(df).collect(), key=str)
    assert {r.city: r.shard_id for r in listed} == {"A": "b'", "B": "y", "C": None, None: "a"}


def test_many_shards_of_any_type(spark):
    rows = [("A", 1.0, 1, 1, 1.0, i % 50, f"s{i:03}") for i in range(200)]
    df = readings(spark, rows)
    assert tumbling(df).first().shard_id == "s000"
    assert tumbling(df, shards=[f"s{i:03}" for i in range(200)]).first().shard_id == "s000"
    numbers = df.withColumn("shard_id", F.expr("CAST(substring(shard_id, 2) AS INT)"))
    assert tumbling(numbers).first().shard_id == 0


def test_given_shards_are_used_and_an_unknown_one_is_an_error(spark):
    df = readings(spark, [("A", 1.0, 1, 1, 1.0, 0, "s1")])
    assert tumbling(df, shards=["s0", "s1"]).first().shard_id == "s1"
    with pytest.raises(Exception, match="not in the list"):
        tumbling(df, shards=["s0"]).collect()


def test_readings_before_1970(spark):
    df = readings(spark, [("A", 1.0, 1, 1, 1.0, 0, "s1"), ("A", 1.0, 1, 1, 1.0, 1, "s0")]).withColumn(
        "collected_at", F.expr("collected_at - INTERVAL 100 YEARS"))
    row = tumbling(df).first()
    assert row.shard_id == "s1" and row.window_start.year == 1924


def test_stream_form_agrees_with_batch_form(spark):
    rows = [("A", i / 7, i % 50, 900 + i, i / 3, i * 7, f"s{i % 3}") for i in range(50)]
    df = readings(spark, rows)
    two_level = tumbling(df).collect()
    single = (df.groupBy(F.window("collected_at", "60 seconds").alias("w"), "city")
              .agg(F.expr("min_by(shard_id, struct(collected_at, shard_id)) AS s")).collect())
    assert {(r.window_start, r.shard_id) for r in two_level} == {(r.w.start, r.s) for r in single}
