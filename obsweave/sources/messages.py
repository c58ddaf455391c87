"""JSON messages: decoding with defaults, encoding, and flattening of nested payloads."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_text_sql, time_from_text_sql
from ..schemas import AGGREGATE, PAYLOAD

_TIMES = ("window_start", "window_end")
_TEXTS = ("city", "shard_id")
_NUMBERS = tuple(n for n in AGGREGATE.names if n not in (*_TIMES, *_TEXTS, "count"))


class Decoded(NamedTuple):
    good: DataFrame
    dead: DataFrame     # message column and ``reason``


def _names(names: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


def _if_given(key: str, converted: str, default: str) -> str:
    return f"IF(map_contains_key(raw, {key}), {converted}, {default})"


def _message_sql() -> str:
    """SQL for the typed message; what is NULL in it (but for texts) could not be converted.

    Fields of one kind are converted by one lambda.  Written out one by one, the generated
    code outgrows what the JVM compiles and runs several times slower.
    """
    wide = "try_cast(raw['count'] AS DOUBLE)"
    whole = (f"coalesce(try_cast(raw['count'] AS BIGINT),"
             f" CASE WHEN abs({wide}) < 9.0e18D THEN CAST({wide} AS BIGINT) END)")
    return f"""struct(
        {_if_given("'city'", "raw['city']", "''")} AS city,
        {_if_given("'shard_id'", "raw['shard_id']", "''")} AS shard_id,
        {_if_given("'count'", whole, "0L")} AS count,
        transform({_names(_TIMES)},
                  k -> {_if_given("k", time_from_text_sql("raw[k]"), "timestamp_seconds(0)")}) AS times,
        transform({_names(_NUMBERS)}, k -> {_if_given("k", "try_cast(raw[k] AS DOUBLE)", "0D")}) AS numbers)"""


def _place(name: str) -> str:
    """Where the typed message has a field."""
    if name in _TIMES:
        return f"m.times[{_TIMES.index(name)}]"
    return f"m.numbers[{_NUMBERS.index(name)}]" if name in _NUMBERS else f"m.{name}"


def decode_aggregates(df: DataFrame, value: str = "value") -> Decoded:
    """Split messages into typed aggregate rows and a dead-letter table.

    A missing key takes its default ("" or 0; times: the epoch).  A key that is present but
    cannot be converted, or text that is not a JSON object, makes the message a dead letter.
    """
    # Parse and conversion are generators, so that the optimizer copies neither into every
    # use of its result nor into the filters on it.
    problems = [f"WHEN {_place(n)} IS NULL THEN 'bad {n}'" for n in AGGREGATE.names if n not in _TEXTS]
    d = (df.select("*", F.expr(
            f"explode_outer(array(from_json(CAST({value} AS STRING), 'MAP<STRING, STRING>'))) AS raw"))
         .select("*", F.expr(f"explode_outer(array({_message_sql()})) AS m"))
         .withColumn("reason", F.expr(f"CASE WHEN raw IS NULL THEN 'not a JSON object' {' '.join(problems)} END")))
    keep = [c for c in df.columns if c != value and c not in AGGREGATE.names]
    return Decoded(
        good=d.where("reason IS NULL").selectExpr(*keep, *[f"{_place(n)} AS {n}" for n in AGGREGATE.names]),
        dead=d.where("reason IS NOT NULL").select(*keep, value, "reason"))


def encode_aggregates(columns: list[str]) -> Column:
    """The JSON text of an aggregate row with these columns, times in ISO form."""
    fields = [f"{iso_text_sql(c)} AS {c}" if c in _TIMES else c for c in AGGREGATE.names if c in columns]
    return F.expr(f"to_json(struct({', '.join(fields)}))")


def key_value(df: DataFrame, key: str = "city") -> DataFrame:
    """What a broker sink takes: message key and JSON value."""
    return df.select(F.col(key).cast("string").alias("key"), encode_aggregates(df.columns).alias("value"))


# Reading column, where the payload has it, and the default if it does not.
_FLAT = [
    ("city", "p.name", "''"), ("country", "p.sys.country", "''"),
    ("lat", "p.coord.lat", "0D"), ("lon", "p.coord.lon", "0D"),
    ("temperature", "p.main.temp", "0D"), ("feels_like", "p.main.feels_like", "0D"),
    ("temp_min", "p.main.temp_min", "0D"), ("temp_max", "p.main.temp_max", "0D"),
    ("pressure", "p.main.pressure", "0"), ("humidity", "p.main.humidity", "0"),
    ("wind_speed", "p.wind.speed", "0D"), ("wind_deg", "p.wind.deg", "0"),
    ("clouds_all", "p.clouds.all", "0"), ("description", "get(p.weather, 0).description", "''"),
]


_BROKEN = "__broken"


def split_payloads(df: DataFrame, value: str = "value", collected_at: str = "collected_at",
                   shard_id: str = "shard_id") -> Decoded:
    """Nested API payloads to flat readings, and those that cannot be read as dead letters.

    An absent key (or null) becomes "" or 0; the description is that of the first weather
    entry.  A key whose value has the wrong type, text that is not a JSON object, and NULL
    make a dead letter: a corrupt number must not become a valid reading of 0.
    Collection time and shard are columns or SQL expressions of the caller's (for a broker:
    the message timestamp).
    """
    keep = [c for c in df.columns if c not in (value, "collected_at", "shard_id")]
    flat = [f"coalesce({path}, {default}) AS {name}" for name, path, default in _FLAT]
    parsed = df.select("*", F.expr(f"""explode_outer(array(from_json(CAST({value} AS STRING),
        '{" ".join(PAYLOAD.split())}, {_BROKEN} STRING', map('columnNameOfCorruptRecord', '{_BROKEN}')))) AS p"""))
    bad = f"p IS NULL OR p.{_BROKEN} IS NOT NULL OR NOT startswith(ltrim(CAST({value} AS STRING)), '{{')"
    told = parsed.withColumn("reason", F.expr(
        f"CASE WHEN {value} IS NULL THEN 'no payload' WHEN {bad} THEN 'payload cannot be read' END"))
    return Decoded(
        good=told.where("reason IS NULL").selectExpr(
            *keep, *flat, f"{collected_at} AS collected_at", f"{shard_id} AS shard_id"),
        dead=told.where("reason IS NOT NULL").select(*[c for c in df.columns if c != "reason"], "reason"))


def flatten_payload(df: DataFrame, value: str = "value", collected_at: str = "collected_at",
                    shard_id: str = "shard_id") -> DataFrame:
    """The readings of :func:`split_payloads`."""
    return split_payloads(df, value, collected_at, shard_id).good
