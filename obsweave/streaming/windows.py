"""Tumbling windows on a stream, and the windows still open when it stops."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import from_state, tumbling


def windowed(readings: DataFrame, size: str = "60 seconds", delay: str = "120 seconds",
             key: str = "city", time_col: str = "collected_at", shards: Sequence[str] | None = None) -> DataFrame:
    """Windows of a stream of readings; given the list of ``shards``, their state has a fixed width.

    ``delay`` is how late a reading may come (default: two windows).  In append mode a
    window is emitted once, when the watermark passes its end; readings later than that are
    counted by :func:`dropped_late`.
    """
    return tumbling(readings.withWatermark(time_col, delay), size, key, time_col, shards=shards)


def final_watermark(query: StreamingQuery) -> datetime | None:
    """The watermark of the last batch of a finished query."""
    marks = [p.eventTime.get("watermark") for p in query.recentProgress if p.eventTime.get("watermark")]
    if not marks:
        return None
    return max(datetime.fromisoformat(m.replace("Z", "+00:00")) for m in marks)


def dropped_late(query: StreamingQuery) -> int:
    """Late rows of the batches whose progress the query still holds (100 by default).

    :class:`~obsweave.streaming.counters.LateRows` counts those of every batch.
    """
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def drain(readings: DataFrame, watermark: datetime | None, size: str = "60 seconds",
          key: str = "city", time_col: str = "collected_at", shards: Sequence[str] | None = None) -> DataFrame:
    """The windows an append-mode stream has not emitted, computed from the source in batch.

    Emitted windows end at or before the watermark.  Only the tail of the source is read:
    the filter on the time column reaches the scan.
    """
    if watermark is None:
        return tumbling(readings, size, key, time_col, shards=shards)
    mark = F.lit(watermark)
    tail = readings.where(F.col(time_col) >= mark - F.expr(f"INTERVAL {size}"))
    return tumbling(tail, size, key, time_col, shards=shards).where(F.col("window_end") > mark)


def drain_state(spark: SparkSession, checkpoint: str, like: DataFrame, key: str = "city",
                shards: Sequence[str] | None = None) -> DataFrame:
    """The windows still open when a stream stopped, from its own state: the source is not read again.

    ``like`` is any frame with the columns of the readings (the stream itself will do), ``shards`` the list that the
    stream was given.  An append-mode stream drops a window from its state when it emits it, so state and emitted windows are disjoint.
    """
    return from_state(spark.read.format("statestore").load(checkpoint), like, key, shards=shards)
