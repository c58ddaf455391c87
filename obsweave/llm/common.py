"""What the text operators share: reading texts in bounded slices, row numbers, hashing."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import spool

#: Bytes of text that a task works on at once; a longer text is one slice of its own.
SLICE_BYTES = 2_000_000
#: Words are runs of anything but space and the control characters 9 to 13.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

U64 = np.uint64


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spark.sparkContext.addPyFile(shutil.make_archive(
            os.path.join(tempfile.mkdtemp(), "package"), "zip", os.path.dirname(package), os.path.basename(package)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; NULL for a NULL key."""
    return F.crc32(key.cast("string")) % F.lit(folds)


def rows_with_number(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``row``, a number that tells repeated and NULL keys apart.

    The number follows from the partition and the place in it; what several jobs use has to be stored with it
    (``stored_rows``).
    """
    return df.select(*[F.col(f"`{c}`") for c in columns]).withColumn("row", F.monotonically_increasing_id())


def stored_rows(df: DataFrame, label: str, *columns: str) -> DataFrame:
    """``rows_with_number``, stored: for use in several jobs, between which the input may be split anew.

    Spark splits files by the cores that are alive, so numbers taken twice need not agree.
    """
    return spool(rows_with_number(df, *columns), label, "zstd")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def over_texts(df: DataFrame, column: str, fn: Callable[[dict[str, list]], dict | None], schema: str | T.StructType,
               limit: int = SLICE_BYTES, finish: Callable[[], dict | None] | None = None,
               setup: Callable[[], tuple[Callable, Callable | None]] | None = None) -> DataFrame:
    """``fn`` over slices of the rows: lists by column name in, columns by name out.

    ``setup``, if given, is called once per task and returns fn and finish, which may share state.
    """
    ship_code(df.sparkSession)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        each, last = setup() if setup else (fn, finish)
        for batch in batches:
            for part in slices(batch, column, limit):
                out = each({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if out is not None:
                    yield as_batch(out, arrow)
        if last is not None and (out := last()) is not None:
            yield as_batch(out, arrow)

    return df.mapInArrow(run, schema)


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type)
              for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing (the finalizer of splitmix64)."""
    x = np.asarray(x, dtype=U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys."""
    return ((mix(x) >> U64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def byte_text(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one line feed after each text, and the start of each text (plus the end of all)."""
    raw = [(t or "").encode("utf-8") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    return np.frombuffer(b"\n".join(raw) + b"\n", np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a byte text, and where each word starts."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts = np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, U64), starts
    inside = np.flatnonzero(~blank)
    lengths = np.diff(np.concatenate([starts, [0]]))
    ends = np.flatnonzero(edge == 1)
    lengths = (ends[-len(starts):] if len(ends) >= len(starts) else np.append(ends, len(data))) - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(inside), dtype=np.int64) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        terms = mix((data[inside].astype(U64) << U64(40)) + place.astype(U64) + U64(0x9E3779B97F4A7C15))
        return mix(np.add.reduceat(terms, first) + lengths.astype(U64)), starts


def texts_of_words(word_starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First word of each text, and the number of words at the end."""
    return np.searchsorted(word_starts, bounds)
