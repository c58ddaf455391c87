"""Quality rules as SQL conditions: six checks in a fixed order, all reported."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import Instant, instant_sql, unix_seconds_sql


@dataclass(frozen=True)
class Bounds:
    """Accepted ranges, ends included.  Fixed values: the defaults."""
    temp_min_c: float = -80.0
    temp_max_c: float = 60.0
    humidity_min: int = 0
    humidity_max: int = 100
    pressure_min: int = 870
    pressure_max: int = 1085
    wind_speed_max: float = 120.0
    timestamp_max_lag_sec: int = 3600


class Rule(NamedTuple):
    field: str
    broken: str    # SQL condition, never NULL
    message: str   # SQL text expression


def _number(bound: float) -> str:
    return str(int(bound)) if float(bound).is_integer() else repr(bound)


def _outside(x: str, low: float, high: float) -> str:
    """True also for NaN, which sorts above every number, and for NULL."""
    return f"coalesce({x} < {_number(low)} OR {x} > {_number(high)}, true)"


def _says(field: str, x: str, shown: str, unit: str, low: float, high: float) -> str:
    return (f"coalesce(concat('{field} ', {shown}, '{unit} out of range [{_number(low)}, {_number(high)}]'),"
            f" '{field} is missing')")


def _one_decimal(x: str) -> str:
    # this pattern rounds the exact binary value, half to even
    return f"format_number(CAST({x} AS DOUBLE), '0.0')"


def time_column(columns: Mapping[str, str]) -> str | None:
    return next((n for n in ("timestamp_unix", "collected_at") if n in columns), None)


def rules(columns: Mapping[str, str], bounds: Bounds = Bounds(), now: Instant = None) -> list[Rule]:
    """The checks for a frame with ``columns`` (name -> type), in reporting order.

    The observation time is ``timestamp_unix`` if the frame has it, else ``collected_at``;
    either may hold unix seconds or a timestamp.  A measurement column the frame lacks
    counts as 0 and a missing city column as blank.
    """
    def field(name: str, default: str) -> str:
        return name if name in columns else default

    city = field("city", "''")
    temperature, humidity = field("temperature", "0D"), field("humidity", "0")
    pressure, wind = field("pressure", "0"), field("wind_speed", "0D")
    taken = time_column(columns)
    seconds = unix_seconds_sql(taken, columns[taken]) if taken else "0L"
    lag = f"(unix_seconds({instant_sql(now)}) - {seconds})"
    b = bounds
    # The message texts.
    return [
        # blank means no character outside Unicode white space
        Rule("city", f"coalesce(NOT {city} RLIKE '(?U)\\\\S', true)", "'city name is empty'"),
        Rule("temperature", _outside(temperature, b.temp_min_c, b.temp_max_c),
             _says("temperature", temperature, _one_decimal(temperature), " °C", b.temp_min_c, b.temp_max_c)),
        Rule("humidity", _outside(humidity, b.humidity_min, b.humidity_max),
             _says("humidity", humidity, f"CAST({humidity} AS STRING)", "", b.humidity_min, b.humidity_max)),
        Rule("pressure", _outside(pressure, b.pressure_min, b.pressure_max),
             _says("pressure", pressure, f"CAST({pressure} AS STRING)", " hPa", b.pressure_min, b.pressure_max)),
        Rule("wind_speed", _outside(wind, 0.0, b.wind_speed_max),
             _says("wind_speed", wind, _one_decimal(wind), " m/s", 0.0, b.wind_speed_max)),
        Rule("timestamp", f"coalesce({lag} < 0 OR {lag} > {b.timestamp_max_lag_sec}, true)",
             f"CASE WHEN {lag} < 0 THEN 'timestamp is in the future' ELSE coalesce(concat('timestamp is ',"
             f" CAST({lag} AS STRING), ' seconds old (max {b.timestamp_max_lag_sec})'), 'timestamp is missing') END"),
    ]


def violations(checks: list[Rule]) -> Column:
    """``array<struct<field, message>>`` of every broken rule; empty for a good row."""
    found = ", ".join(f"CASE WHEN {r.broken} THEN struct('{r.field}' AS field, {r.message} AS message) END"
                      for r in checks)
    return F.expr(f"array_compact(array({found}))")


def valid_sql(checks: list[Rule]) -> str:
    """The same decision without building messages."""
    return "NOT (" + " OR ".join(r.broken for r in checks) + ")"


def within_ranges(bounds: Bounds = Bounds()) -> Column:
    """The reduced rule set: five ranges, city only non-empty, no time rule, NULL fails."""
    b = bounds
    return F.expr(f"""
        temperature BETWEEN {b.temp_min_c!r}D AND {b.temp_max_c!r}D
        AND humidity BETWEEN {b.humidity_min} AND {b.humidity_max}
        AND pressure BETWEEN {b.pressure_min} AND {b.pressure_max}
        AND wind_speed BETWEEN 0D AND {b.wind_speed_max!r}D AND char_length(city) > 0""")
