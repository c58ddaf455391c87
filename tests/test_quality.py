from __future__ import annotations

import pytest
from helpers import at, dicts, plan_of, readings
from pyspark.sql import functions as F

from obsweave.functions.quality import Bounds
from obsweave.operators import validate

NOW = at(60)
GOOD = ("Turku", -3.5, 81, 996, 7.25, 3590)


def errors_of(spark, row, now=NOW, bounds=Bounds()):
    (r,) = validate.tag(readings(spark, [row]), bounds, now).collect()
    assert r.is_valid == (len(r.errors) == 0)
    return [(e.field, e.message) for e in r.errors]


def changed(**c):
    names = ["city", "temperature", "humidity", "pressure", "wind", "seconds"]
    return tuple(c.get(n, v) for n, v in zip(names, GOOD))


def test_good_reading(spark):
    assert errors_of(spark, GOOD) == []


def test_five_errors_in_order(spark):
    found = errors_of(spark, ("", 999.0, -1, 500, -5.0, 3590))
    assert found == [
        ("city", "city name is empty"),
        ("temperature", "temperature 999.0 °C out of range [-80, 60]"),
        ("humidity", "humidity -1 out of range [0, 100]"),
        ("pressure", "pressure 500 hPa out of range [870, 1085]"),
        ("wind_speed", "wind_speed -5.0 m/s out of range [0, 120]"),
    ]


@pytest.mark.parametrize("city", ["", "   ", "\t", " ", "  \n", None])
def test_blank_city(spark, city):
    assert errors_of(spark, changed(city=city)) == [("city", "city name is empty")]


def test_padded_city_is_fine(spark):
    assert errors_of(spark, changed(city="  x ")) == []


@pytest.mark.parametrize("column,value,ok", [
    ("temperature", -80.0, True), ("temperature", 60.0, True), ("temperature", 60.01, False),
    ("temperature", -80.01, False), ("humidity", 0, True), ("humidity", 100, True), ("humidity", 101, False),
    ("pressure", 870, True), ("pressure", 1085, True), ("pressure", 869, False), ("pressure", 1086, False),
    ("wind", 0.0, True), ("wind", 120.0, True), ("wind", 120.5, False),
    ("temperature", float("nan"), False), ("wind", float("nan"), False),
    ("temperature", None, False), ("humidity", None, False), ("pressure", None, False), ("wind", None, False),
])
def test_bounds_are_inclusive_and_nan_and_null_fail(spark, column, value, ok):
    assert (errors_of(spark, changed(**{column: value})) == []) is ok


@pytest.mark.parametrize("lag,message", [
    (0, None), (3600, None), (3601, "timestamp is 3601 seconds old (max 3600)"),
    (-1, "timestamp is in the future"), (-9999, "timestamp is in the future"),
])
def test_age_of_reading(spark, lag, message):
    found = errors_of(spark, changed(seconds=3600 - lag))
    assert found == ([] if message is None else [("timestamp", message)])


@pytest.mark.parametrize("value,shown", [(62.25, "62.2"), (62.35, "62.4"), (62.55, "62.5"), (62.75, "62.8")])
def test_one_decimal_rounds_the_binary_value_half_to_even(spark, value, shown):
    assert errors_of(spark, changed(temperature=value))[0][1].startswith(f"temperature {shown} °C")


def test_configured_bounds_show_in_message(spark):
    found = errors_of(spark, changed(temperature=20.5), bounds=Bounds(temp_max_c=20.25))
    assert found == [("temperature", "temperature 20.5 °C out of range [-80, 20.25]")]


def test_batch_counts_and_list(spark):
    df = readings(spark, [GOOD, changed(temperature=999.0), GOOD])
    assert dicts(validate.report(df, now=NOW)) == [{
        "total": 3, "valid": 2, "invalid": 1, "valid_pct": 2 / 3 * 100, "errors_by_field": {"temperature": 1}}]
    (err,) = validate.error_list(df, "reading_id", now=NOW).collect()
    assert (err.reading_id, err.field) == (1, "temperature")


def test_empty_batch(spark):
    df = readings(spark, [])
    assert dicts(validate.report(df, now=NOW)) == [{
        "total": 0, "valid": 0, "invalid": 0, "valid_pct": 0.0, "errors_by_field": {}}]
    assert validate.error_list(df, "reading_id", now=NOW).count() == 0
    assert validate.errors_by_field(df, now=NOW).count() == 0


def test_split_is_a_partition_of_the_rows(spark):
    df = readings(spark, [GOOD, changed(wind=-1.0), changed(city=" "), changed(humidity=None)])
    good, bad = validate.split(df, now=NOW)
    assert [r.reading_id for r in good.collect()] == [0]
    assert sorted(r.reading_id for r in bad.collect()) == [1, 2, 3]


def test_reduced_rules_keep_blank_city_and_any_age(spark):
    df = readings(spark, [changed(city="  "), changed(seconds=-99999), changed(city=""), changed(temperature=61.0),
                          changed(humidity=None), changed(temperature=float("nan"))])
    assert sorted(r.reading_id for r in validate.reduced_mask(df).collect()) == [0, 1]


def test_time_may_be_unix_seconds_or_missing(spark):
    df = readings(spark, [GOOD])
    as_seconds = df.withColumn("collected_at", F.unix_seconds("collected_at"))
    preferred = as_seconds.withColumn("timestamp_unix", F.col("collected_at") - 10_000)
    assert validate.clean(as_seconds, now=NOW).count() == 1
    assert [e.field for e in validate.tag(preferred, now=NOW).first().errors] == ["timestamp"]
    assert [e.field for e in validate.tag(df.drop("collected_at"), now=NOW).first().errors] == ["timestamp"]


def test_absent_columns_count_as_zero_or_blank(spark):
    df = readings(spark, [GOOD]).drop("city", "pressure", "temperature")
    assert [e.field for e in validate.tag(df, now=NOW).first().errors] == ["city", "pressure"]


def test_now_defaults_to_the_clock(spark):
    df = readings(spark, [GOOD])
    assert [e.field for e in validate.tag(df).first().errors] == ["timestamp"]
    assert validate.clean(df.withColumn("collected_at", F.current_timestamp())).count() == 1


def test_no_python_in_the_plan(spark):
    plan = plan_of(validate.tag(readings(spark, [GOOD]), now=NOW))
    assert "Python" not in plan
