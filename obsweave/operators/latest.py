"""One row per key: the latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tie_break(df: DataFrame, used: Sequence[str]) -> list[str]:
    """Order by the remaining columns, largest first, so that equal times give one certain row."""
    return [f"{c} DESC" for c in df.columns if c not in set(used)]


def latest_per_key(df: DataFrame, key: str | Sequence[str] = "city", by: str = "window_end",
                   ties: Sequence[str] | None = None) -> DataFrame:
    """The row with the largest ``by`` for every key.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so a
    task sends at most one row per key however large that key is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = ", ".join([f"{by} DESC", *(tie_break(df, [*keys, by]) if ties is None else ties)])
    return (df.selectExpr("*", f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS __rank")
            .where("__rank = 1").drop("__rank"))


def latest_per_key_agg(df: DataFrame, key: str = "city", by: str = "window_end") -> DataFrame:
    """The same rows as an aggregate, the form a stream can keep as state."""
    rest = [c for c in df.columns if c not in (key, by)]
    return (df.groupBy(key).agg(F.max(F.struct(by, *rest)).alias("r"))
            .selectExpr(*[c if c == key else f"r.{c} AS {c}" for c in df.columns]))


def dedup_latest(df: DataFrame, keys: Sequence[str] = ("city", "window_start"),
                 by: str = "window_end", ties: Sequence[str] | None = None) -> DataFrame:
    """Copies of a key reduced to the one with the latest ``by``."""
    return latest_per_key(df, keys, by, ties)
