"""Time columns arrive as text, unix seconds or timestamps; here they become timestamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = datetime | str | int | float | None

_MAX_UNIX_SECONDS = "1.0e11D"


def time_from_text_sql(text: str) -> str:
    """ISO-8601 text (with or without zone, ``Z`` included) or unix seconds; NULL if neither."""
    # the shape is tested first: a failing cast to DOUBLE costs a Java exception per row
    return (f"(CASE WHEN trim({text}) LIKE '____-__-__%' THEN try_cast({text} AS TIMESTAMP)"
            f" WHEN abs(try_cast({text} AS DOUBLE)) < {_MAX_UNIX_SECONDS}"
            f" THEN timestamp_seconds(try_cast({text} AS DOUBLE)) END)")


def iso_text_sql(ts: str) -> str:
    """``2024-01-01T00:00:00``, with six decimals only if there is a fraction."""
    return (f"date_format({ts}, CASE WHEN unix_micros({ts}) % 1000000 = 0 THEN 'yyyy-MM-dd\\'T\\'HH:mm:ss'"
            f" ELSE 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS' END)")


def time_from_text(text: str) -> Column:
    return F.expr(time_from_text_sql(text))


def iso_text(ts: str) -> Column:
    return F.expr(iso_text_sql(ts))


def unix_seconds_sql(name: str, data_type: str) -> str:
    """Unix seconds of a column that holds either seconds or a timestamp."""
    if data_type.startswith("timestamp"):
        return f"unix_seconds(CAST({name} AS TIMESTAMP))"
    return f"CAST({name} AS BIGINT)"


def instant_sql(value: Instant) -> str:
    """A point in time given as datetime, ISO text or unix seconds; None is now.

    A datetime or text without zone is UTC.
    """
    if value is None:
        return "current_timestamp()"
    if isinstance(value, (int, float)):
        return f"timestamp_seconds({value!r})"
    moment = datetime.fromisoformat(value.replace("Z", "+00:00")) if isinstance(value, str) else value
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return f"TIMESTAMP '{moment.astimezone(timezone.utc):%Y-%m-%d %H:%M:%S.%f}+00:00'"
