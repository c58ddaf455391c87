"""Derived weather columns: spread, window length, comfort score and band."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .numeric import round_sql

# Fixed values of the comfort score: ideal temperature and humidity, penalty weights.
IDEAL_TEMP = 18.0
IDEAL_HUMIDITY = 50.0
TEMP_WEIGHT = 2.0
HUMIDITY_WEIGHT = 0.3
WIND_WEIGHT = 1.5
# Fixed values of the bands: at least 70 is green, at least 40 orange, below that red.
GREEN_FROM = 70.0
ORANGE_FROM = 40.0


def comfort_sql(temp: str = "avg_temp", humidity: str = "avg_humidity", wind: str = "avg_wind_speed") -> str:
    """0..100: 100 is the ideal temperature and humidity without wind."""
    score = (f"(100D - abs({temp} - {IDEAL_TEMP}D) * {TEMP_WEIGHT}D"
             f" - abs({humidity} - {IDEAL_HUMIDITY}D) * {HUMIDITY_WEIGHT}D - {wind} * {WIND_WEIGHT}D)")
    # NULL and NaN stay what they are; a score within 0..100 is rounded by cutting
    return (f"(CASE WHEN {score} IS NULL OR isnan({score}) THEN {score}"
            f" ELSE floor(least(greatest({score}, 0D), 100D) * 10D + 0.5D) / 10D END)")


def comfort_index(temp: str = "avg_temp", humidity: str = "avg_humidity", wind: str = "avg_wind_speed") -> Column:
    return F.expr(comfort_sql(temp, humidity, wind))


def comfort_band(score: str) -> Column:
    return F.expr(f"CASE WHEN {score} >= {GREEN_FROM} THEN 'green' WHEN {score} >= {ORANGE_FROM} THEN 'orange'"
                  f" WHEN {score} IS NOT NULL THEN 'red' END")


def temp_range(low: str = "min_temp", high: str = "max_temp") -> Column:
    return F.expr(round_sql(f"({high} - {low})", 2))


def whole_seconds(start: str = "window_start", end: str = "window_end") -> Column:
    return F.expr(f"timestampdiff(SECOND, {start}, {end})")


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``comfort_index(t, h, w)`` callable from SQL text; Catalyst inlines its body."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION comfort_index(t DOUBLE, h DOUBLE, w DOUBLE)"
              f" RETURNS DOUBLE RETURN {comfort_sql('t', 'h', 'w')}")
