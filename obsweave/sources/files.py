"""File scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AGGREGATE, RUN_RESULT, conform, empty_frame
from ..sinks.versions import is_versioned, load_table

PARTITION_DATE = T.StructField("window_date", T.DateType())


def load_parquet(spark: SparkSession, path: str, schema: T.StructType = AGGREGATE,
                 partition: T.StructField | None = None) -> DataFrame:
    """Scan a Parquet table with a fixed schema; a missing path is an empty table.

    ``partition`` names the directory column, which then can be filtered on.  An unreadable
    file is an error, not an empty table.  Of a table with versions it is the newest one.
    """
    full = T.StructType([*schema.fields, partition]) if partition else schema
    if is_versioned(spark, path):
        return conform(load_table(spark, path), full)
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return empty_frame(spark, full)
        raise


def newest_results(spark: SparkSession, directory: str, pattern: str = "bench_*.json") -> DataFrame:
    """One row per run from the newest result file (its name carries the time).

    Only names are listed to find it; only that file is read.
    """
    names = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
             .agg(F.max("path")).first()[0])
    if names is None:
        raise FileNotFoundError(f"no {pattern} in {directory}")
    return results_file(spark, names)


def results_file(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.schema(f"results ARRAY<STRUCT<{_as_struct(RUN_RESULT)}>>").json(path, multiLine=True)
    return whole.select(F.inline("results"))


def _as_struct(columns: str) -> str:
    return ", ".join(": ".join(c.split()) for c in columns.split(","))
