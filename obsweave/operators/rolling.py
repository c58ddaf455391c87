"""Rolling mean over the last N rows of a key, without putting a key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rolling_avg, round_sql
from ..session import spool


def rolling_mean(df: DataFrame, n: int = 5, key: str = "city", order: str = "window_end",
                 value: str = "avg_temp", ties: Sequence[str] = ("window_start",),
                 chunk: str | None = None, ranges: int | None = None) -> DataFrame:
    """Add ``rolling_{value}_{n}w``: mean of the last ``n`` rows (fewer at the start).

    Rows are dealt by range over key and order, so a chunk has about the same number of rows whatever they are, and a hot
    key fills many chunks.  The first rows of a chunk also need up to n-1 rows
    from earlier chunks; these are looked up among the last n-1 rows of every chunk and
    added to it as carried rows, which are dropped again after the window.  The result is
    sorted by key and time.

    The input is read once and kept in the work folder when this is called.  There are ``ranges`` chunks (as many as
    shuffle partitions by default).  With ``chunk``, a ``date_trunc`` unit, rows are cut by time instead and nothing is stored.
    """
    ties = [t for t in ties if t in df.columns]
    by = ", ".join([order, *ties])
    if chunk:
        rows = chunked = df.withColumn("__chunk", F.date_trunc(chunk, order))
    else:
        spark = df.sparkSession
        wanted = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        once = spool(df, "rolling-input")   # the boundaries are sampled from it
        rows = chunked = spool(once.repartitionByRange(wanted, key, order, *ties)
                               .withColumn("__chunk", F.spark_partition_id()), "rolling-ranges")
    rows = rows.withColumn("__carried", F.lit(False))
    if n > 1:
        rows = rows.unionByName(_carried(chunked, n, key, order, value, ties), allowMissingColumns=True)
    frame = (f"OVER (PARTITION BY {key}, __chunk ORDER BY {by}"
             f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")
    # One range shuffle serves the window (equal key and chunk stay together) and the final
    # order: a later chunk holds only later times, so ordering by chunk changes nothing.
    rolled = rolling_avg(rows.repartitionByRange(key, "__chunk"), value, frame, "__mean").where("NOT __carried")
    out = rolled.selectExpr(*df.columns, "__chunk", f"{round_sql('__mean', 2)} AS rolling_{value}_{n}w")
    return out.orderBy(key, "__chunk", order, *ties).drop("__chunk")


def _carried(chunked: DataFrame, n: int, key: str, order: str, value: str,
             ties: Sequence[str]) -> DataFrame:
    """For every chunk, the up to n-1 rows of its key that come right before it."""
    by = ", ".join([order, *ties])
    newest = ", ".join(f"{c} DESC" for c in [order, *ties])
    tails = (chunked.select(key, "__chunk", order, *ties, value)
             .selectExpr("*", f"row_number() OVER (PARTITION BY {key}, __chunk ORDER BY {newest}) AS r")
             .where(f"r <= {n - 1}").drop("r"))
    # n-1 rows per chunk: numbering them within a key is small work
    tails = tails.selectExpr("*", f"row_number() OVER (PARTITION BY {key} ORDER BY __chunk, {by}) AS pos")
    needed = (tails.groupBy(key, "__chunk").agg(F.expr("min(pos) AS start")).where("start > 1")
              .selectExpr(f"{key} AS k", "__chunk AS for_chunk",
                          f"explode(sequence(greatest(start - {n - 1}, 1), start - 1)) AS p"))
    return (tails.join(needed, F.expr(f"{key} <=> k AND pos = p"))
            .selectExpr(key, "for_chunk AS __chunk", order, *ties, value, "true AS __carried"))
