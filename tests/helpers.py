from __future__ import annotations

from datetime import datetime, timedelta, timezone

from obsweave.schemas import AGGREGATE, frame_of

T0 = datetime(2024, 6, 1, tzinfo=timezone.utc)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


OTHER = {"avg_humidity": 58.0, "avg_pressure": 987.0, "avg_wind_speed": 3.0, "count": 9, "shard_id": "north"}


def agg_row(city="Turku", start=0, minutes=1, temp=12.0, **more):
    """A window of ``minutes`` from ``start`` on; what a test does not name is arbitrary."""
    spread = {} if temp is None else {"avg_temp": temp, "min_temp": temp - 1.5, "max_temp": temp + 2.5}
    return OTHER | spread | {"city": city, "window_start": at(start), "window_end": at(start + minutes)} | more


def aggs(spark, *rows):
    return frame_of(spark, rows, AGGREGATE)


READING = "reading_id BIGINT, city STRING, temperature DOUBLE, humidity INT, pressure INT, wind_speed DOUBLE, " \
          "collected_at TIMESTAMP, shard_id STRING"


def readings(spark, rows):
    """(city, temperature, humidity, pressure, wind, seconds after T0[, shard])"""
    return spark.createDataFrame(
        [(i, r[0], r[1], r[2], r[3], r[4], T0 + timedelta(seconds=r[5]), r[6] if len(r) > 6 else "north")
         for i, r in enumerate(rows)], READING)


def dicts(df):
    return [r.asDict() for r in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
