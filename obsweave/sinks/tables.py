"""The stored aggregate table: date-partitioned Parquet with latest-wins upserts."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import dedup_latest, tie_break
from ..operators.select import by_city, retain_last_n
from ..schemas import AGGREGATE

DATE_PARTITION = ("window_date", "to_date(window_start)")


def _laid_out(df: DataFrame, partition: str, order: Sequence[str]) -> DataFrame:
    """Even-sized files per partition value: AQE splits a partition that is too large."""
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *order)


def save_parquet(df: DataFrame, path: str, partition: tuple[str, str] = DATE_PARTITION,
                 order: Sequence[str] = ("city", "window_start")) -> None:
    """Replace the table.  Rows are sorted inside files so that row-group statistics prune."""
    name, how = partition
    (_laid_out(df.withColumn(name, F.expr(how)), name, order)
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(name).parquet(path))


def upsert_parquet(new: DataFrame, path: str, keys: Sequence[str] = ("city", "window_start"),
                   by: str = "window_end", partition: tuple[str, str] = DATE_PARTITION) -> None:
    """Merge rows into the table, keeping per key the row with the latest ``by``.

    On equal ``by`` the newly arrived row wins, and among new rows the largest in the
    remaining columns, so running the same batch again changes nothing.  Either side may lack columns of the
    other; its rows have NULL there.  The partition value must follow from
    the keys.  Only partitions that ``new`` touches are read and rewritten; their files are
    swapped when the job commits, so the job may read what it replaces.
    """
    name, how = partition
    spark = new.sparkSession
    fresh = new.withColumn(name, F.expr(how)).persist()
    try:
        # partition values only; a driver lists the partitions of a table in any case
        touched = [r[0] for r in fresh.select(name).distinct().collect()]
        if not touched:
            return
        stored = _stored(spark, path, fresh, name)
        merged = dedup_latest(
            _touched_part(stored, name, touched).withColumn("__fresh", F.lit(0))
            .unionByName(fresh.withColumn("__fresh", F.lit(1)), allowMissingColumns=True),
            keys, by, ties=_prefer_fresh(new, keys, by)).drop("__fresh")
        (_laid_out(merged, name, keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path))
    finally:
        fresh.unpersist()


def _stored(spark: SparkSession, path: str, fresh: DataFrame, name: str) -> DataFrame:
    """The table with all columns that any of its files has; empty if there is none yet."""
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], fresh.schema)
    return found.withColumn(name, F.col(name).cast(fresh.schema[name].dataType))


def _touched_part(stored: DataFrame, name: str, touched: list) -> DataFrame:
    wanted = F.col(name).isin([v for v in touched if v is not None])
    return stored.where(wanted | F.col(name).isNull() if None in touched else wanted)


def _prefer_fresh(new: DataFrame, keys: Sequence[str], by: str) -> list[str]:
    return ["__fresh DESC", *tie_break(new, [*keys, by])]


def append_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per row, NULL fields written too."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def arrow_columns(df: DataFrame) -> DataFrame:
    """Columns as the Arrow exchange wants them: 32-bit count, no sub-second times."""
    return df.select(*[
        F.col(f.name).cast("int").alias(f.name) if f.name == "count"
        else F.date_trunc("second", f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name) for f in AGGREGATE.fields])


def to_arrow(df: DataFrame, sequence: str, city: str | None = None, *, rows: int) -> pa.Table:
    """The recent history (of one city, or all) as an Arrow table: its last ``rows`` rows, a size the caller has to state."""
    # retention first, city second: the history is kept over all cities
    recent = by_city(retain_last_n(df, rows, sequence), city)
    out = arrow_columns(recent).toArrow()
    seconds = [pa.field(f.name, pa.timestamp("s", tz="UTC")) if pa.types.is_timestamp(f.type) else f
               for f in out.schema]
    return out.cast(pa.schema(seconds))


def from_epoch(df: DataFrame, columns: Sequence[str] = ("window_start", "window_end")) -> DataFrame:
    """Times that arrive as unix seconds become timestamps."""
    return df.withColumns({c: F.timestamp_seconds(F.col(c)) for c in columns})


def to_epoch(df: DataFrame, columns: Sequence[str] = ("window_start", "window_end")) -> DataFrame:
    return df.withColumns({c: F.unix_seconds(F.col(c)) for c in columns})
