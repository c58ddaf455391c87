"""Streaming jobs put together from the operators."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.quality import Bounds
from ..operators.latest import latest_per_key_agg
from ..operators.select import retain_last_n
from ..functions.times import Instant
from ..operators.validate import clean, quarantine, tag
from ..schemas import empty_frame
from ..sinks.fanout import Sink, fan_out
from ..sinks.versions import DATE_PARTITION, Conflict, create_file, read_text, upsert_table
from ..sources.files import load_parquet
from ..sources.message_log import append_log, register as register_log
from ..sources.messages import decode_aggregates, key_value
from .windows import windowed

def trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` is a processing-time interval; None takes what is there and stops."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def upsert_sink(path: str, partition: tuple[str, str] = DATE_PARTITION,
                keys: tuple[str, ...] = ("city", "window_start")) -> Sink:
    """Idempotent: repeating a batch after a failure leaves the table as it is.  Readers see whole batches."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, path, keys, partition=partition)
    return write


def broker_sink(brokers: str, topic: str) -> Sink:
    """JSON value, city as key, so that a city stays in one broker partition."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (key_value(batch).write.format("kafka").option("kafka.bootstrap.servers", brokers)
         .option("kafka.acks", "all").option("topic", topic).save())
    return write


def log_sink(path: str, writer: str = "writer") -> Sink:
    """A broker's topic kept as files: JSON value, city as key; a batch that is repeated is not written twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_log(key_value(batch), path, writer, batch_id)
    return write


def start_log(aggregates: DataFrame, path: str, checkpoint: str, *, writer: str = "writer",
              every: str | None = None) -> StreamingQuery:
    """Aggregates as messages appended to a log."""
    register_log(aggregates.sparkSession)
    return (trigger(key_value(aggregates).writeStream.format("message_log").outputMode("append"), every)
            .options(path=path, writer=writer, checkpointLocation=checkpoint).start())


def run_until_idle(query: StreamingQuery) -> None:
    """Let a stream with an admission limit take, batch by batch, all that is there, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def start_windows(readings: DataFrame, table: str, checkpoint: str, *, size: str = "60 seconds",
                  delay: str = "120 seconds", bounds: Bounds | None = Bounds(), now: Instant = None,
                  every: str | None = None, more_sinks: Mapping[str, Sink | None] | None = None,
                  failed_path: str | None = None, mode: str = "append",
                  shards: Sequence[str] | None = None) -> StreamingQuery:
    """Readings, checked, windowed and upserted into the table; optionally to more sinks.

    Validation is here, on readings.  Rejected rows are the business of
    :func:`start_quarantine`, which reads the same source but judges ages by its own clock;
    where each reading must reach one of both, use :func:`start_intake` first.
    """
    checked = readings if bounds is None else clean(readings, bounds, now)
    sink = upsert_sink(table)
    if more_sinks:
        sink = _table_then(sink, fan_out(more_sinks, failed_path or f"{table}_failed"))
    out = windowed(checked, size, delay, shards=shards)
    return (trigger(out.writeStream.outputMode(mode).foreachBatch(sink), every)
            .option("checkpointLocation", checkpoint).start())


def _table_then(table: Sink, others: Sink) -> Sink:
    """The table must succeed (else the batch repeats); the other sinks may fail singly."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            table(batch, batch_id)
            others(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def start_intake(readings: DataFrame, good_path: str, bad_path: str, checkpoint: str, *,
                 bounds: Bounds = Bounds(), now: Instant = None, every: str | None = None,
                 late_path: str | None = None, size: str = "60 seconds", delay: str = "120 seconds",
                 time_col: str = "collected_at") -> StreamingQuery:
    """Every reading goes to exactly one table: valid ones, or rejected ones with their reasons.

    A batch is judged by one clock, its own time, which the checkpoint keeps; so a batch
    that is repeated after a failure is split alike, and replaces what it wrote.  Windows
    over the valid readings are another stream, from ``good_path`` with ``bounds=None``.

    With ``late_path``, valid readings whose window of ``size`` ended at or before the watermark go to a third table instead
    of being dropped later.  The watermark is the latest valid time of all earlier batches less ``delay``, kept with the
    table; a stream of windows with the same delay reads on-time readings no earlier than they came, so it drops none.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parts = {good_path: "is_valid", bad_path: "NOT is_valid"}
        seen = Observation()
        if late_path:
            mark = _mark_before(spark, late_path, batch_id)
            end = f"unix_micros(window({time_col}, '{size}').end)"
            batch = batch.withColumn("__late", F.expr("false" if mark is None else f"coalesce({end} <= {mark}L, false)"))
            parts = {good_path: "is_valid AND NOT __late", late_path: "is_valid AND __late", bad_path: "NOT is_valid"}
        for path, kind in parts.items():
            rows = batch.where(kind)
            rows = rows.drop("is_valid", "__late") if path == bad_path else rows.drop("is_valid", "__late", "errors")
            if late_path and path == good_path:
                behind = f"unix_micros(timestamp_micros(0L) + INTERVAL {delay})"
                rows = rows.observe(seen, F.expr(f"max(unix_micros({time_col})) - {behind}").alias("mark"))
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if late_path:
            reached = [m for m in (mark, seen.get["mark"]) if m is not None]
            _keep_mark(spark, late_path, batch_id, max(reached, default=None))
    return (trigger(tag(readings, bounds, now).writeStream.foreachBatch(write), every)
            .option("checkpointLocation", checkpoint).start())


def _mark_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The watermark in microseconds that the batches before this one reached."""
    fs, folder = _files(spark, f"{path}/_marks")
    known = [int(s.getPath().getName()) for s in fs.listStatus(folder)
             if s.getPath().getName().isdigit()] if fs.exists(folder) else []
    before = [n for n in known if n < batch_id]
    return json.loads(read_text(spark, f"{path}/_marks/{max(before)}")) if before else None


def _keep_mark(spark: SparkSession, path: str, batch_id: int, mark: int | None) -> None:
    try:
        create_file(spark, f"{path}/_marks/{batch_id}", json.dumps(mark))
    except Conflict:
        pass    # a repeated batch reaches the same


def start_quarantine(readings: DataFrame, path: str, checkpoint: str, *, bounds: Bounds = Bounds(),
                     now: Instant = None, every: str | None = None) -> StreamingQuery:
    return (trigger(quarantine(readings, bounds, now).writeStream.format("parquet"), every)
            .option("checkpointLocation", checkpoint).start(path))


def start_messages(messages: DataFrame, table: str, dead_path: str, checkpoint: str, *,
                   value: str = "value", every: str | None = None) -> StreamingQuery:
    """Aggregate messages decoded and upserted; undecodable ones kept as dead letters."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(value).persist()
        try:
            good, dead = decode_aggregates(batch, value)
            upsert_table(good, table)
            dead.write.mode("overwrite").parquet(f"{dead_path}/batch={batch_id}")
        finally:
            batch.unpersist()
    return (trigger(messages.writeStream.foreachBatch(write), every)
            .option("checkpointLocation", checkpoint).start())


def start_latest(aggregates: DataFrame, table: str, checkpoint: str, *,
                 every: str | None = None, buckets: int = 16) -> StreamingQuery:
    """Keep a table with the latest row of every city.

    A batch rewrites the buckets its cities fall into: choose as many as leave one bucket
    small, and the same number for the whole life of a table.
    """
    partition = ("bucket", f"CAST(pmod(xxhash64(city), {buckets}) AS INT)")
    return (trigger(latest_per_key_agg(aggregates).writeStream.outputMode("update")
                    .foreachBatch(upsert_sink(table, partition, ("city",))), every)
            .option("checkpointLocation", checkpoint).start())


def start_history(stream: DataFrame, path: str, checkpoint: str, *, n: int, sequence: str,
                  every: str | None = None) -> StreamingQuery:
    """Keep the last ``n`` rows; ``n`` is small, as this is what a screen shows.

    Every batch writes the whole history as a new version and reads the one before, so a
    repeated batch gives the same.  The version before is kept for readers at work, older ones go.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        before = history(batch.sparkSession, path, batch.schema, below=batch_id)
        kept = retain_last_n(before.unionByName(batch), n, sequence)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        earlier = [v for v in _versions(batch.sparkSession, path) if v < batch_id]
        _drop_versions(batch.sparkSession, path, earlier[:-1])
    return (trigger(stream.writeStream.foreachBatch(write), every)
            .option("checkpointLocation", checkpoint).start())


def history(spark: SparkSession, path: str, schema: T.StructType, below: int | None = None) -> DataFrame:
    """The newest stored version (before version ``below``); only names are listed to find it."""
    found = [v for v in _versions(spark, path) if below is None or v < below]
    return load_parquet(spark, f"{path}/version={found[-1]}", schema) if found else empty_frame(spark, schema)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions, oldest first."""
    fs, folder = _files(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=")
                  and fs.exists(_files(spark, f"{path}/{n}/_SUCCESS")[1]))


def _drop_versions(spark: SparkSession, path: str, versions: Sequence[int]) -> None:
    for v in versions:
        fs, folder = _files(spark, f"{path}/version={v}")
        fs.delete(folder, True)
