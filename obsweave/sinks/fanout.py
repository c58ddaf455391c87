"""One micro-batch to several sinks, each on its own."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


def fan_out(sinks: Mapping[str, Sink | None], failed_path: str) -> Sink:
    """A ``foreachBatch`` function that feeds every sink; an absent sink (None) is skipped.

    A sink that fails does not stop the others.  Its rows are kept under
    ``failed_path/sink=<name>/batch=<id>`` with the error, to be replayed; if even that
    write fails the batch fails, and the stream repeats it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, sink in sinks.items():
                if sink is None:
                    continue
                try:
                    sink(batch, batch_id)
                except Exception as problem:
                    log.warning("sink %s failed on batch %d: %s", name, batch_id, problem)
                    (batch.withColumn("error", F.lit(str(problem))).write.mode("overwrite")
                     .parquet(f"{failed_path}/sink={name}/batch={batch_id}"))
        finally:
            batch.unpersist()
    return write


def replay(batch: DataFrame, sink: Sink, batch_id: int) -> None:
    """Feed kept rows to a sink again."""
    sink(batch.drop("error", "sink", "batch"), batch_id)
