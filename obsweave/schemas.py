"""Schemas of the tables this package works on, and typed frames built from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the exchanged tables.
AGGREGATE = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("count", T.LongType()),
    T.StructField("avg_temp", T.DoubleType()),
    T.StructField("min_temp", T.DoubleType()),
    T.StructField("max_temp", T.DoubleType()),
    T.StructField("avg_humidity", T.DoubleType()),
    T.StructField("avg_pressure", T.DoubleType()),
    T.StructField("avg_wind_speed", T.DoubleType()),
    T.StructField("shard_id", T.StringType()),
])

# A flat reading.
READING = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("feels_like", T.DoubleType()),
    T.StructField("temp_min", T.DoubleType()),
    T.StructField("temp_max", T.DoubleType()),
    T.StructField("pressure", T.IntegerType()),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("wind_deg", T.IntegerType()),
    T.StructField("clouds_all", T.IntegerType()),
    T.StructField("description", T.StringType()),
    T.StructField("collected_at", T.TimestampType()),
    T.StructField("shard_id", T.StringType()),
])

# A reading as the request log keeps it: with its latency and, if it failed, the error.
REQUEST = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("feels_like", T.DoubleType()),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("pressure", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("description", T.StringType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("response_time_ms", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

# What of the API payload is read.
PAYLOAD = """
    id INT, name STRING, dt BIGINT,
    main STRUCT<temp: DOUBLE, feels_like: DOUBLE, temp_min: DOUBLE, temp_max: DOUBLE,
                pressure: INT, humidity: INT>,
    wind STRUCT<speed: DOUBLE, deg: INT>,
    clouds STRUCT<all: INT>,
    weather ARRAY<STRUCT<description: STRING, icon: STRING>>,
    coord STRUCT<lat: DOUBLE, lon: DOUBLE>,
    sys STRUCT<country: STRING>
"""

# The summary of a run, in the order of its report.
RUN_RESULT = """
    name STRING, total_requests BIGINT, successful BIGINT, failed BIGINT,
    total_time_sec DOUBLE, throughput_rps DOUBLE, avg_latency_ms DOUBLE,
    p50_latency_ms DOUBLE, p95_latency_ms DOUBLE, p99_latency_ms DOUBLE,
    min_latency_ms DOUBLE, max_latency_ms DOUBLE, timestamp STRING
"""


def empty_frame(spark: SparkSession, schema: T.StructType = AGGREGATE) -> DataFrame:
    return spark.createDataFrame([], schema)


def frame_of(spark: SparkSession, records: Iterable[Mapping], schema: T.StructType = AGGREGATE) -> DataFrame:
    """A typed frame from driver-side records (small hand-made inputs only)."""
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(rows, schema)


def conform(df: DataFrame, schema: T.StructType = AGGREGATE) -> DataFrame:
    """Put columns in schema order with schema types; absent ones become NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
