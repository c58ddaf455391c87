"""A table as Arrow files, written and read by the executors; the driver keeps the list of files.

For tables of any size, where :func:`~obsweave.sinks.tables.to_arrow` brings a bounded number of rows to the driver.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

LIST = "files.json"


def open_folder(path: str):
    """File system and folder of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def export_arrow(df: DataFrame, path: str, order: str, files: int | None = None) -> list[dict]:
    """One Arrow file per range of ``order``; returns the list of files, which is written last.

    A file of a task that was repeated is not on the list, and so not in the table.
    """
    spark = df.sparkSession
    ship_package(spark)
    ranged = df.repartitionByRange(files, order) if files else df.repartitionByRange(order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, rows = TaskContext.get().partitionId(), None, 0
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        where, folder = open_folder(path)
        for batch in batches:
            if out is None:
                where.create_dir(folder, recursive=True)
                stream = where.open_output_stream(f"{folder}/{name}")
                out = pa.ipc.new_file(stream, batch.schema)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is not None:
            out.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "rows": [rows]})

    listed = [r.asDict() for r in
              ranged.mapInArrow(write, "part INT, name STRING, rows LONG").orderBy("part").collect()]  # one row per file
    where, folder = open_folder(path)
    where.create_dir(folder, recursive=True)
    draft = f"{folder}/.{LIST}.{uuid.uuid4().hex}"
    with where.open_output_stream(draft) as f:
        f.write(json.dumps({"schema": df.schema.jsonValue(), "files": listed}).encode())
    where.move(draft, f"{folder}/{LIST}")
    return listed


def load_arrow(spark: SparkSession, path: str) -> DataFrame:
    """The table of :func:`export_arrow`; one task per file."""
    ship_package(spark)
    where, folder = open_folder(path)
    with where.open_input_stream(f"{folder}/{LIST}") as f:
        listed = json.loads(f.read())
    schema, names = T.StructType.fromJson(listed["schema"]), [x["name"] for x in listed["files"]]
    if not names:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_folder(path)[0].open_input_file(f"{folder}/{name}") as f:
                    file = pa.ipc.open_file(f)
                    for i in range(file.num_record_batches):
                        yield file.get_batch(i)

    files = spark.createDataFrame([(n,) for n in names], "name STRING").repartition(len(names), F.col("name"))
    return files.mapInArrow(read, schema)
