"""A partitioned log of messages in files: a source with offsets and a sink that takes each epoch once.

For deployments without a broker, and to replay what one delivered.  A log is a folder: data files under ``data``, and one
commit file per written batch, which names its data files with the offsets they got.  A message goes to
the log partition of its key (crc32 modulo the number of partitions; NULL keys together), so a key keeps its order, and offsets
count the messages of a partition without gaps.

``format("message_log")`` reads ``key, value, partition, offset, timestamp`` (batch and stream) and writes ``key, value``.
Options: ``path``; ``partitions`` (when the log is begun, 4 by default); reading: ``startingOffsets`` (``earliest``, ``latest``,
``lastPerKey`` or JSON of offsets per partition), ``endingOffsets`` (batch; ``latest`` or JSON), ``maxOffsetsPerTrigger`` with
``group``; writing: ``writer`` and, in batch, ``epoch``.

* Positions of a stream live in its checkpoint.  Python sources are not told where a stream stands when they are asked for more, so
  an admission limit needs the name of a ``group``, under which the log keeps the position planned last.
* ``lastPerKey`` gives the newest message of every key, and then what arrives; one task per log partition remembers its keys.
* A batch is visible when its commit file is, which appears by one rename; files of tasks that failed are never named.
  An epoch that a writer committed already is not written again.  A log has one writer at a time.

Files are reached with pyarrow, so the path has to be one that driver and executors can open.
"""

from __future__ import annotations

import json
import os
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

from ..session import ship_package

SCHEMA = "key STRING, value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
_ARROW = pa.schema([("key", pa.string()), ("value", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                    ("timestamp", pa.timestamp("us", tz="UTC"))])
_STORED = pa.schema([("key", pa.string()), ("value", pa.string()), ("at", pa.int64())])
PARTITIONS = 4
LAST_PER_KEY = "lastPerKey"


class _Folder:
    """A folder of any file system that pyarrow knows."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))

    def names(self, sub: str) -> list[str]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/{sub}", allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.startswith("."))

    def read(self, name: str) -> dict:
        with self.files.open_input_stream(f"{self.root}/{name}") as f:
            return json.loads(f.read())

    def publish(self, name: str, content: dict) -> None:
        """The whole file or none."""
        sub, base = name.rsplit("/", 1)
        self.files.create_dir(f"{self.root}/{sub}", recursive=True)
        draft = f"{self.root}/{sub}/.{base}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as f:
            f.write(json.dumps(content).encode())
        self.files.move(draft, f"{self.root}/{name}")


class Log:
    """The commits of a log: ``ends`` per partition, and the pieces of files that hold a range of offsets."""

    def __init__(self, path: str) -> None:
        self.folder = _Folder(path)
        self._known: dict[str, dict] = {}

    def commits(self) -> list[dict]:
        """All commits in order; each is read once."""
        names = [n for n in self.folder.names("commits") if n.endswith(".json")]
        for n in names:
            if n not in self._known:
                self._known[n] = self.folder.read(f"commits/{n}")
        return [self._known[n] for n in names]

    def ends(self) -> dict[str, int]:
        found = self.commits()
        return dict(found[-1]["ends"]) if found else {}

    def pieces(self, start: dict[str, int], end: dict[str, int]) -> list[_Piece]:
        out = []
        for c in self.commits():
            for name, part, first, count in c["files"]:
                a, b = max(first, start.get(part, 0)), min(first + count, end.get(part, 0))
                if a < b:
                    out.append(_Piece(name, int(part), first, a, b))
        return out


@dataclass
class _Piece(InputPartition):
    """Offsets ``start`` to ``end`` - 1 of one file, whose first message has offset ``first``."""

    name: str
    part: int
    first: int
    start: int
    end: int


@dataclass
class _Newest(InputPartition):
    """All pieces of a log partition, of which the newest message of every key is wanted."""

    pieces: list[_Piece]


def _read(path: str, what: InputPartition) -> Iterator[pa.RecordBatch]:
    folder = _Folder(path)
    if isinstance(what, _Newest):
        yield from _newest(folder, what.pieces)
        return
    for batch in _batches(folder, what):
        yield batch


def _batches(folder: _Folder, p: _Piece) -> Iterator[pa.RecordBatch]:
    offset = p.first
    with folder.files.open_input_file(f"{folder.root}/data/{p.name}") as f:
        file = pq.ParquetFile(f)
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            if offset + rows > p.start and offset < p.end:
                at = offset
                for batch in file.iter_batches(8192, [group]):
                    a, b = max(p.start - at, 0), min(p.end - at, batch.num_rows)
                    if a < b:
                        yield _numbered(batch.slice(a, b - a), p.part, at + a)
                    at += batch.num_rows
            offset += rows


def _numbered(batch: pa.RecordBatch, part: int, offset: int) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays([
        batch.column(0), batch.column(1), pa.array([part] * n, pa.int32()), pa.array(range(offset, offset + n), pa.int64()),
        batch.column(2).cast(pa.timestamp("us", tz="UTC"))], schema=_ARROW)


def _newest(folder: _Folder, pieces: list[_Piece]) -> Iterator[pa.RecordBatch]:
    seen: set[str | None] = set()
    for p in reversed(pieces):
        batches = list(_batches(folder, p))
        for batch in reversed(batches):
            keys, take = batch.column(0).to_pylist(), []
            for i in range(len(keys) - 1, -1, -1):
                if keys[i] not in seen:
                    seen.add(keys[i])
                    take.append(i)
            if take:
                yield batch.take(pa.array(take[::-1]))


def _offsets(text: str, ends: dict[str, int]) -> dict:
    """Offsets per partition from an option."""
    if text == "latest":
        return dict(ends)
    if text == "earliest":
        return dict.fromkeys(ends, 0)
    if text == LAST_PER_KEY:
        return {**dict.fromkeys(ends, 0), LAST_PER_KEY: dict(ends)}
    given = {str(k): int(v) for k, v in json.loads(text).items()}
    return {**dict.fromkeys(ends, 0), **given}


def admit(start: dict[str, int], ends: dict[str, int], limit: int) -> dict[str, int]:
    """At most ``limit`` messages after ``start``, shared out evenly among the partitions that have some."""
    left = {p: e - start.get(p, 0) for p, e in ends.items()}
    out, room = {p: start.get(p, 0) for p in ends}, max(1, limit)
    waiting = sorted((p for p in left if left[p] > 0), key=lambda p: (left[p], p))
    for i, p in enumerate(waiting):
        share = min(left[p], -(-room // (len(waiting) - i)))
        out[p] += share
        room -= share
    return out


class _Planner:
    """What batch and stream readers share: the partitions of a range."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.options = options["path"], dict(options)
        self.log = Log(self.path)

    def plan(self, start: dict, end: dict) -> list[InputPartition]:
        newest = start.get(LAST_PER_KEY)
        if not newest:
            return list(self.log.pieces(start, end))
        by_part: dict[int, list[_Piece]] = {}
        for p in self.log.pieces({}, newest):
            by_part.setdefault(p.part, []).append(p)
        return [*map(_Newest, by_part.values()), *self.log.pieces(newest, end)]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.options = options["path"], dict(options)

    def partitions(self) -> list[InputPartition]:
        planner = _Planner(self.options)
        ends = planner.log.ends()
        start = _offsets(self.options.get("startingoffsets", "earliest"), ends)
        end = _offsets(self.options.get("endingoffsets", "latest"), ends)
        return planner.plan(start, {p: min(n, ends.get(p, 0)) for p, n in end.items()}) or [_Newest([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are the ends per partition; ``lastPerKey`` is in the first one only."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.options = options["path"], dict(options)
        self.limit = int(options.get("maxoffsetspertrigger", 0))
        self.group = options.get("group")
        if self.limit and not self.group:
            raise ValueError("maxOffsetsPerTrigger needs the name of a group")
        self.planner, self.position, self.first = _Planner(options), None, None
        if self.group:
            self.position = self._kept()

    def _kept(self) -> dict | None:
        name = f"{self.group}.json"
        return self.planner.log.folder.read(f"groups/{name}") if name in self.planner.log.folder.names("groups") else None

    def initialOffset(self) -> dict:
        if self.first is None:
            self.first = _offsets(self.options.get("startingoffsets", "latest"), self.planner.log.ends())
        return self.first

    def latestOffset(self) -> dict:
        start = self.position if self.position is not None else self.initialOffset()
        ends = self.planner.log.ends()
        if not self.limit:
            return ends
        return admit(start.get(LAST_PER_KEY, start), ends, self.limit)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.position = end
        if self.group:
            self.planner.log.folder.publish(f"groups/{self.group}.json", end)
        return self.planner.plan(start, end) or [_Newest([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        pass    # the checkpoint has it


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str, int]]       # name, log partition, messages


class _Appending:
    """Writes the messages of a task, one file per log partition, and commits those of all tasks under one epoch."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.options = options["path"], dict(options)
        self.writer = options.get("writer", "writer")
        if "/" in self.writer:
            raise ValueError("the name of a writer is part of a file name")
        known = Log(self.path).ends()
        self.partitions = len(known) or int(options.get("partitions", PARTITIONS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        folder = _Folder(self.path)
        folder.files.create_dir(f"{folder.root}/data", recursive=True)
        task, open_, counts = uuid.uuid4().hex, {}, {}
        try:
            for batch in iterator:
                keys = batch.column(batch.schema.get_field_index("key")).cast(pa.string())
                values = batch.column(batch.schema.get_field_index("value")).cast(pa.string())
                parts = pa.array([zlib.crc32(k.encode()) % self.partitions if k is not None else 0 for k in keys.to_pylist()])
                rows = pa.record_batch([keys, values, pa.array([time.time_ns() // 1000] * len(keys), pa.int64())], _STORED)
                for part in parts.unique().to_pylist():
                    mine = rows.filter(pc.equal(parts, part))
                    if part not in open_:
                        open_[part] = pq.ParquetWriter(f"{folder.root}/data/{task}-{part}.parquet", _STORED,
                                                       filesystem=folder.files, compression="zstd")
                    open_[part].write_batch(mine)
                    counts[part] = counts.get(part, 0) + mine.num_rows
        finally:
            for w in open_.values():
                w.close()
        return _Written([(f"{task}-{part}.parquet", str(part), n) for part, n in sorted(counts.items())])

    def _commit(self, messages: list[_Written | None], epoch: int) -> None:
        log = Log(self.path)
        done = log.commits()
        if any(c["writer"] == self.writer and c["epoch"] == epoch for c in done):
            self._drop(messages)
            return
        ends = {str(p): 0 for p in range(self.partitions)} | log.ends()
        files = []
        for m in messages:
            for name, part, n in m.files if m else ():
                files.append((name, part, ends[part], n))
                ends[part] += n
        log.folder.publish(f"commits/{len(done):012d}.json",
                           {"writer": self.writer, "epoch": epoch, "files": files, "ends": ends})

    def _drop(self, messages: list[_Written | None]) -> None:
        folder = _Folder(self.path)
        for m in messages:
            for name, _, _ in m.files if m else ():
                folder.files.delete_file(f"{folder.root}/data/{name}")


class _BatchWriter(_Appending, DataSourceArrowWriter):
    def commit(self, messages: list[_Written | None]) -> None:
        self._commit(messages, int(self.options.get("epoch", time.time_ns())))

    def abort(self, messages: list[_Written | None]) -> None:
        self._drop(messages)


class _StreamWriter(_Appending, DataSourceStreamArrowWriter):
    def commit(self, messages: list[_Written | None], batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages: list[_Written | None], batchId: int) -> None:
        self._drop(messages)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_lower(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_lower(self.options))

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("a log is only appended to")
        return _BatchWriter(_lower(self.options))

    def streamWriter(self, schema, overwrite: bool):
        return _StreamWriter(_lower(self.options))


def _lower(options) -> dict[str, str]:
    out = {k.lower(): v for k, v in dict(options).items()}
    if "path" not in out:
        raise ValueError("the path of the log is missing")
    return out


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(MessageLog)


def read_log(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The messages of a log as a table."""
    register(spark)
    return spark.read.format("message_log").options(path=path, **options).load()


def stream_log(spark: SparkSession, path: str, start: str = "latest", group: str | None = None,
               max_offsets: int | None = None) -> DataFrame:
    register(spark)
    reader = spark.readStream.format("message_log").options(path=path, startingOffsets=start)
    if max_offsets:
        reader = reader.options(maxOffsetsPerTrigger=str(max_offsets), group=group or "")
    return reader.load()


def append_log(messages: DataFrame, path: str, writer: str = "writer", epoch: int | None = None,
               partitions: int = PARTITIONS) -> None:
    """Append ``key, value``; an epoch of this writer that is in the log already is left out."""
    register(messages.sparkSession)
    out = messages.select("key", "value").write.format("message_log").mode("append").options(
        path=path, writer=writer, partitions=str(partitions))
    (out if epoch is None else out.option("epoch", str(epoch))).save()
