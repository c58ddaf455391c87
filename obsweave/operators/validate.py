"""Row validation: tagging, splitting, error listing and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import Bounds, Rule, rules, valid_sql, violations, within_ranges
from ..functions.times import Instant


def _rules(df: DataFrame, bounds: Bounds, now: Instant) -> list[Rule]:
    return rules(dict(df.dtypes), bounds, now)


def tag(df: DataFrame, bounds: Bounds = Bounds(), now: Instant = None) -> DataFrame:
    """Add ``errors`` (every broken rule with its message) and ``is_valid``."""
    checks = _rules(df, bounds, now)
    return df.select("*", violations(checks).alias("errors"), F.expr(valid_sql(checks)).alias("is_valid"))


def clean(df: DataFrame, bounds: Bounds = Bounds(), now: Instant = None) -> DataFrame:
    return df.where(valid_sql(_rules(df, bounds, now)))


def quarantine(df: DataFrame, bounds: Bounds = Bounds(), now: Instant = None) -> DataFrame:
    """The rejected rows with their reasons."""
    checks = _rules(df, bounds, now)
    return df.where(f"NOT {valid_sql(checks)}").withColumn("errors", violations(checks))


def split(df: DataFrame, bounds: Bounds = Bounds(), now: Instant = None) -> tuple[DataFrame, DataFrame]:
    return clean(df, bounds, now), quarantine(df, bounds, now)


def error_list(df: DataFrame, row_id: str, bounds: Bounds = Bounds(), now: Instant = None) -> DataFrame:
    """One row per broken rule, keyed by a stable row id."""
    return quarantine(df, bounds, now).select(row_id, F.expr("inline(errors)"))


def _counts(df: DataFrame, bounds: Bounds, now: Instant) -> DataFrame:
    """Everything countable in one pass: a single row of partial counts per task is shuffled."""
    checks = _rules(df, bounds, now)
    found = ", ".join(f"struct('{r.field}' AS field, count_if({r.broken}) AS errors)" for r in checks)
    return df.agg(F.count(F.lit(1)).alias("total"), F.expr(f"count_if({valid_sql(checks)}) AS valid"),
                  F.expr(f"filter(array({found}), p -> p.errors > 0) AS by_field"))


def errors_by_field(df: DataFrame, bounds: Bounds = Bounds(), now: Instant = None) -> DataFrame:
    """``field, errors`` for the fields that have any."""
    return _counts(df, bounds, now).select(F.expr("inline(by_field)"))


def report(df: DataFrame, bounds: Bounds = Bounds(), now: Instant = None) -> DataFrame:
    """One row: total, valid, invalid, valid_pct (0 when empty), errors_by_field (map)."""
    return _counts(df, bounds, now).selectExpr(
        "total", "valid", "total - valid AS invalid",
        "coalesce(valid / nullif(total, 0) * 100, 0D) AS valid_pct",
        "map_from_entries(by_field) AS errors_by_field")


def reduced_mask(df: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Rows that pass the reduced rule set (ranges and non-empty city only)."""
    return df.where(within_ranges(bounds))
