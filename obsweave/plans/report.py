"""The closing report: six tables computed from the stored aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.aggregate import (comfort_by_city, histogram, humidity_by_hour, mean_by_city,
                                   top_cities_by_temp)
from ..operators.select import enrich, timeline


def report(table: DataFrame) -> dict[str, DataFrame]:
    enriched = enrich(table)
    return {
        "top10": top_cities_by_temp(enriched, 10),
        "timeline": timeline(enriched, hours=None),
        "histogram": histogram(enriched),
        "humidity_by_hour": humidity_by_hour(enriched),
        "comfort": comfort_by_city(enriched),
        "mean_by_city": mean_by_city(enriched),
    }


def write_report(table: DataFrame, path: str) -> list[str]:
    """Write every table of the report as Parquet; the input is read once."""
    kept = table.persist()
    try:
        parts = report(kept)
        for name, df in parts.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        return list(parts)
    finally:
        kept.unpersist()
