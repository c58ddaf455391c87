"""Streaming sources chosen by configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("kafka", "parquet", "json", "text")


def kafka_options(brokers: Sequence[str], topic: str, group: str | None = None,
                  max_offsets: int | None = None, start: str = "latest") -> dict[str, str]:
    """Reader options.  Positions live in the checkpoint, so nothing is committed to the group."""
    options = {
        "kafka.bootstrap.servers": ",".join(brokers),
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def open_stream(spark: SparkSession, kind: str, *, path: str | None = None,
                schema: T.StructType | str | None = None, brokers: Sequence[str] = (), topic: str = "",
                group: str | None = None, max_offsets: int | None = None,
                max_files: int | None = None, files: str | None = None, start: str = "latest") -> DataFrame:
    """A streaming DataFrame.

    ``start`` is where a broker source without a checkpoint begins: ``latest``, ``earliest``, or offsets as JSON.

    ``max_offsets`` and ``max_files`` bound a micro-batch; backlog waits at the source and
    nothing is dropped.  ``files`` is a name pattern for a folder that holds other files too.
    """
    if kind not in FORMATS:
        raise ValueError(f"unknown source {kind!r}; one of {', '.join(FORMATS)}")
    reader = spark.readStream.format(kind)
    if kind == "kafka":
        return (reader.options(**kafka_options(brokers, topic, group, max_offsets, start)).load()
                .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                            "topic", "partition", "offset", "timestamp"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def merge_streams(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several sources as one stream; copies that arrive over both are settled at the table."""
    out = first
    for o in others:
        out = out.unionByName(o, allowMissingColumns=True)
    return out
