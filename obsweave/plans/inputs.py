"""The given tables seen as readings, window aggregates, messages and request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import iso_text_sql
from ..operators.windows import tumbling

WINDOW = "1 hour"
SHARDS = ["shard-0", "shard-1", "shard-2"]      # the registry behind ``readings_of``

# Schemas of the given tables, so that no job is spent on reading them from the files.
EVENTS = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
SCHEMAS = {
    "events": EVENTS,
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
                " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING,"
                " l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def readings_of(events: DataFrame) -> DataFrame:
    """Events as readings; some of them break the quality rules."""
    return events.selectExpr(
        "event_id AS reading_id",
        "CASE WHEN event_id % 997 = 0 THEN '  ' ELSE event_type END AS city",
        "CAST(ts AS TIMESTAMP) AS collected_at",
        "value - 40 AS temperature",
        "CAST(user_id % 120 AS INT) AS humidity",
        "CAST(860 + event_id % 240 AS INT) AS pressure",
        "value / 3 AS wind_speed",
        "concat('shard-', CAST(user_id % 3 AS STRING)) AS shard_id")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling(readings(spark, sf_dir), WINDOW, shards=SHARDS)


def messages(aggs: DataFrame) -> DataFrame:
    """Aggregate messages the way different producers write them, some of them broken.

    By hour of the window start, mod 4: 0 ISO times with zone; 1 unix seconds; 2 no shard;
    3 plain, but cut short for count 1 and with a count in words for count 2.
    """
    iso = {"window_start": iso_text_sql("window_start"), "window_end": iso_text_sql("window_end")}

    def text(**changes: str) -> str:
        fields = {**{c: c for c in aggs.columns}, **iso, **changes}
        return "to_json(struct(" + ", ".join(f"{sql} AS {c}" for c, sql in fields.items() if sql) + "))"

    zoned = text(**{c: f"concat({sql}, 'Z')" for c, sql in iso.items()})
    unix = text(**{c: f"unix_seconds({c})" for c in iso})
    words = text(count="'a few'")
    return aggs.selectExpr(f"""CASE hour(window_start) % 4 WHEN 0 THEN {zoned} WHEN 1 THEN {unix}
        WHEN 2 THEN {text(shard_id='')}
        ELSE CASE count WHEN 1 THEN substring({text()}, 1, 30) WHEN 2 THEN {words} ELSE {text()} END
        END AS value""")


def payloads(events: DataFrame) -> DataFrame:
    """Events as nested API payloads; errors have no weather entry, sign-ups no coordinates.

    By event number mod 40, some are broken: 1 the temperature is a word, 2 cut short, 3 wind is no object.
    """
    whole = events.selectExpr(
        "event_id", "CAST(ts AS TIMESTAMP) AS collected_at",
        "concat('shard-', CAST(user_id % 3 AS STRING)) AS shard_id",
        """to_json(struct(
            CAST(event_id AS INT) AS id, event_type AS name, unix_seconds(CAST(ts AS TIMESTAMP)) AS dt,
            struct(value AS temp, value - 1 AS feels_like, value - 2 AS temp_min, value + 2 AS temp_max,
                   1013 AS pressure, CAST(user_id % 100 AS INT) AS humidity) AS main,
            struct(value / 3 AS speed, CAST(user_id % 360 AS INT) AS deg) AS wind,
            struct(CAST(user_id % 101 AS INT) AS all) AS clouds,
            CASE WHEN event_type = 'error' THEN array()
                 ELSE array(struct(props AS description, '04d' AS icon)) END AS weather,
            CASE WHEN event_type <> 'signup' THEN struct(55.5D AS lat, 37.5D AS lon) END AS coord,
            struct('XX' AS country) AS sys)) AS value""")
    return whole.withColumn("value", F.expr("""CASE event_id % 40
        WHEN 1 THEN regexp_replace(value, '"temp":[^,]*,', '"temp":"warm",')
        WHEN 2 THEN substring(value, 1, 60)
        WHEN 3 THEN regexp_replace(value, '"wind":[{][^}]*[}]', '"wind":7') ELSE value END"""))


def request_log(events: DataFrame) -> DataFrame:
    """Events as a request log: two runs, one poll round per day, latency = value."""
    return events.selectExpr(
        "CASE WHEN user_id % 2 = 0 THEN 'run-a' ELSE 'run-b' END AS name",
        "date_format(ts, 'yyyy-MM-dd') AS round", "value AS response_time_ms",
        "CASE WHEN event_type = 'error' THEN 'failed' END AS error", "CAST(ts AS TIMESTAMP) AS sent_at")
