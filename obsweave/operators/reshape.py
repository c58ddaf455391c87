"""Unions, pivots and transposes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import humidity_by_hour


def union_diagonal(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column one side lacks is NULL there; copies are kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def humidity_pivot(df: DataFrame) -> DataFrame:
    """City by hour-of-day matrix (columns h0 to h23) of mean humidity; gaps stay NULL."""
    hours = list(range(24))
    wide = humidity_by_hour(df).groupBy("city").pivot("hour", hours).agg(F.first("humidity"))
    return wide.select("city", *[F.col(str(h)).alias(f"h{h}") for h in hours]).orderBy("city")


def metric_matrix(results: DataFrame, metrics: Sequence[str], names: Sequence[str],
                  name_col: str = "name") -> DataFrame:
    """Metrics as rows and the named runs as columns."""
    long = (results.select(name_col, *[F.col(m).cast("double").alias(m) for m in metrics])
            .unpivot([name_col], list(metrics), "metric", "value"))
    return long.groupBy("metric").pivot(name_col, list(names)).agg(F.first("value"))
