"""Readings folded into per-key tumbling windows; one definition for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions.numeric import Means, round_sql

# Output column and the reading column it averages.
AVERAGES = {
    "avg_temp": "temperature",
    "avg_humidity": "humidity",
    "avg_pressure": "pressure",
    "avg_wind_speed": "wind_speed",
}


def tumbling(df: DataFrame, size: str = "60 seconds", key: str = "city",
             time_col: str = "collected_at", shard_col: str | None = "shard_id",
             shards: Sequence[str] | None = None) -> DataFrame:
    """Per key and window: count, mean/min/max temperature, mean humidity, pressure, wind.

    Windows are event-time and aligned to the epoch.  Means are rounded to two decimals,
    half away from zero; min and max are not rounded.  ``shard_id`` is the shard of the
    earliest reading (equal times: the smallest shard id).

    A text buffer would turn the aggregate into a sort of all readings.  Therefore, in
    batch, given the list ``shards``, the earliest shard is the minimum of one bigint: time
    within the window, then the number of the shard in the sorted list.  Without the list a
    second, narrow aggregate takes the earliest time per window and shard and is joined; it
    reads the input once more, so this should be a stored table.  No job runs while the plan
    is built.  A stream given the list keeps the same bigint as its state; without it, the shard as it is.
    """
    means = Means(df, AVERAGES.values())
    rows = means.prepare(df)
    pieces = {"count": "count(1)", "min_temp": "min(temperature)", "max_temp": "max(temperature)",
              **means.pieces()}
    listed = shard_col and shards is not None
    inside = f"pmod(unix_micros({time_col}), unix_micros(timestamp_micros(0L) + INTERVAL {size}))"
    if df.isStreaming:
        shard = "shard_id"
        if listed:
            shard = _add_first_shard(pieces, inside, shard_col, shards)
        elif shard_col:
            pieces["shard_id"] = f"min_by({shard_col}, struct({time_col}, {shard_col}))"
        grouped = (_aggregate(rows.groupBy(F.window(time_col, size).alias("w"), key), pieces)
                   .selectExpr("*", "w.start AS window_start", "w.end AS window_end"))
    else:
        rows = rows.select("*", F.window(time_col, size).alias("w")).selectExpr("*", "w.start AS window_start")
        shard = _add_first_shard(pieces, inside, shard_col, shards) if listed else "first_shard"
        grouped = (_aggregate(rows.groupBy("window_start", key), pieces)
                   .selectExpr("*", f"window_start + INTERVAL {size} AS window_end"))
        if shard_col and not listed:
            first = _first_shards(df, size, key, time_col, shard_col)
            grouped = grouped.join(first, F.expr(f"window_start = first_start AND {key} <=> first_key"))
    return _finished(grouped, means, key, shard if shard_col else None)


def _finished(grouped: DataFrame, means: Means, key: str, shard: str | None) -> DataFrame:
    """The columns of the result from the pieces; ``shard`` is the SQL that reads the first shard."""
    tail = [f"{shard} AS shard_id"] if shard else []
    valued = grouped.selectExpr(key, "window_start", "window_end", "count", "min_temp", "max_temp", *tail,
                                *[f"{means.value(src)} AS {out}" for out, src in AVERAGES.items()])
    rounded = {out: f"{round_sql(out, 2)} AS {out}" for out in AVERAGES}
    return valued.selectExpr(
        key, "window_start", "window_end", "count", rounded["avg_temp"], "min_temp", "max_temp",
        rounded["avg_humidity"], rounded["avg_pressure"], rounded["avg_wind_speed"],
        *(["shard_id"] if shard else []))


def from_state(state: DataFrame, readings: DataFrame, key: str = "city", shard_col: str | None = "shard_id",
               shards: Sequence[str] | None = None) -> DataFrame:
    """Windows from the state that a stream of :func:`tumbling` keeps (``key`` and ``value`` of the state data source).

    Only the columns' types of ``readings`` are used.  The state has to be the fixed-width one: no shards, or a list of them.
    """
    means = Means(readings, AVERAGES.values())
    pieces = {"count": "count(1)", "min_temp": "min(temperature)", "max_temp": "max(temperature)", **means.pieces()}
    shard = _add_first_shard(pieces, "0L", shard_col, shards or []) if shard_col else None
    # a sum of decimals keeps a flag besides; all other pieces are one field each
    fields, names = state.schema["value"].dataType.fields, []
    for name, sql in pieces.items():
        names.append(name)
        if sql.startswith("sum(") and "DECIMAL" in sql:
            names.append(f"{name}__empty")
    if len(names) != len(fields):
        raise ValueError(f"the state has {len(fields)} fields, not the {len(names)} of these windows")
    typed = ", ".join(f"{n}: {f.dataType.simpleString()}" for n, f in zip(names, fields, strict=True))
    grouped = (state.select(F.col("key").cast(f"struct<w: struct<start: timestamp, end: timestamp>, {key}: "
                                              f"{readings.schema[key].dataType.simpleString()}>").alias("k"),
                            F.col("value").cast(f"struct<{typed}>").alias("v"))
               .selectExpr(f"k.{key} AS {key}", "k.w.start AS window_start", "k.w.end AS window_end", "v.*"))
    return _finished(grouped, means, key, shard)


def _aggregate(grouped: GroupedData, pieces: dict[str, str]) -> DataFrame:
    return grouped.agg(*[F.expr(f"{sql} AS {name}") for name, sql in pieces.items()])


def _first_shards(df: DataFrame, size: str, key: str, time_col: str, shard_col: str) -> DataFrame:
    """``first_start, first_key, first_shard``: readings are reduced to one row per window and shard first."""
    times = (df.select(F.window(time_col, size)["start"].alias("first_start"), F.col(key).alias("first_key"),
                       F.col(shard_col).alias("s"), F.col(time_col).alias("t"))
             .groupBy("first_start", "first_key", "s").agg(F.min("t").alias("t")))
    return times.groupBy("first_start", "first_key").agg(F.expr("min_by(s, struct(t, s)) AS first_shard"))


def _add_first_shard(pieces: dict[str, str], inside: str, shard_col: str, shards: Sequence[str]) -> str:
    """Add the piece that finds the earliest shard; returns the SQL that reads it afterwards.

    ``inside`` is the time within the window in microseconds.
    """
    names = sorted({str(s) for s in shards})
    quoted = ", ".join("'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'" for s in names)
    listed = f"array({quoted})" if quoted else "CAST(array() AS ARRAY<STRING>)"
    bits = max(1, len(names)).bit_length()
    number = f"coalesce(array_position({listed}, CAST({shard_col} AS STRING)), 0L)"
    known = (f"IF({shard_col} IS NOT NULL AND {number} = 0, raise_error('shard not in the list of shards'),"
             f" {number})")
    pieces["first_shard"] = f"min(shiftleft({inside}, {bits}) | {known})"
    return f"try_element_at({listed}, CAST(nullif(first_shard & {(1 << bits) - 1}L, 0L) AS INT))"
