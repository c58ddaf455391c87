"""Tables whose changes are seen whole or not at all.

A write puts its files into a folder of its own, ``v=<number>/<partition>/``, and then names all live folders in a manifest,
``_versions/<number>.json``.  The manifest appears by one rename, so a reader has the table before the write or
after it; a write that stops half-way leaves files nobody reads.  The manifest also keeps the schema (no file is opened to
find it), and the longest window stored, from which queries on recent rows know which dates they can skip.

A writer that finds the next number taken fails and may be repeated.  What the version before still names is
kept for readers at work; what only older versions name is deleted.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import dedup_latest, tie_break
from ..session import spool

DATE_PARTITION = ("window_date", "to_date(window_start)")
SPAN = ("window_start", "window_end")
VERSION = "v"
_WIDER = {"tinyint": ("smallint", "int", "bigint"), "smallint": ("int", "bigint"), "int": ("bigint", "double"),
          "float": ("double",), "date": ("timestamp",), "void": ("string",)}


class Manifest(NamedTuple):
    version: int
    schema: T.StructType            # without the partition column
    partition: T.StructField
    folders: dict[str, int]         # name of a partition folder -> version it was last written in
    written: dict[int, int]         # version -> partition folders written then
    longest_us: int | None          # longest window, in microseconds


class Conflict(RuntimeError):
    """Another writer was faster; nothing was changed."""


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _drop(spark: SparkSession, path: str) -> None:
    fs, folder = _hadoop(spark, path)
    fs.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _hadoop(spark, path)
    stream = fs.open(file)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A whole file or none; an existing one is a :class:`Conflict`."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    whole = path if "://" in path or path.startswith("file:") else str(_hadoop(spark, path)[0].makeQualified(_hadoop(spark, path)[1]))
    parent, name = whole.rsplit("/", 1)
    fs, draft = _hadoop(spark, f"{parent}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    never_replace = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, jvm.org.apache.hadoop.fs.Path(whole), never_replace)
    except Exception as problem:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(problem):
            raise Conflict(f"{path} is there already") from None
        raise


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{path}/_versions")
                  if n.endswith(".json") and not n.startswith("."))


def is_versioned(spark: SparkSession, path: str) -> bool:
    fs, folder = _hadoop(spark, f"{path}/_versions")
    return fs.exists(folder)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The newest version (or a certain one); None if there is no table."""
    if version is None:
        found = _numbers(spark, path)
        if not found:
            return None
        version = found[-1]
    raw = json.loads(read_text(spark, f"{path}/_versions/{version:012d}.json"))
    return Manifest(version, T.StructType.fromJson(raw["schema"]), T.StructField.fromJson(raw["partition"]),
                    raw["folders"], {int(v): n for v, n in raw["written"].items()}, raw["longest_us"])


def _publish(spark: SparkSession, path: str, m: Manifest) -> None:
    create_file(spark, f"{path}/_versions/{m.version:012d}.json", json.dumps({
        "schema": m.schema.jsonValue(), "partition": m.partition.jsonValue(), "folders": m.folders,
        "written": m.written, "longest_us": m.longest_us}))


def _frame(spark: SparkSession, path: str, m: Manifest) -> DataFrame:
    full = T.StructType([*m.schema.fields, T.StructField(VERSION, T.LongType()), m.partition])
    if not m.folders:
        return spark.createDataFrame([], full).drop(VERSION)
    live = Counter(m.folders.values())
    whole = [v for v, n in live.items() if n == m.written[v]]   # named by one path each
    paths = [f"{path}/{VERSION}={v}" for v in whole]
    paths += [f"{path}/{VERSION}={v}/{folder}" for folder, v in m.folders.items() if v not in set(whole)]
    return spark.read.schema(full).option("basePath", path).parquet(*paths).drop(VERSION)


def load_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table with its partition column; one version of it, whatever is written meanwhile."""
    m = manifest(spark, path, version)
    if m is None:
        raise FileNotFoundError(f"no table in {path}")
    return _frame(spark, path, m)


def longest_window(spark: SparkSession, path: str) -> str | None:
    """The longest window stored, as an SQL interval without the word INTERVAL."""
    m = manifest(spark, path)
    return None if m is None or m.longest_us is None else f"{m.longest_us} MICROSECONDS"


def _merged_schema(stored: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; a stored column keeps its type, and the new one has to fit into it."""
    types = {f.name: f for f in stored.fields}
    for f in new.fields:
        if f.name in types:
            have, want = f.dataType.simpleString(), types[f.name].dataType.simpleString()
            if have != want and want not in _WIDER.get(have, ()):
                raise ValueError(f"column {f.name} is stored as {want} and arrives as {have}")
    return T.StructType([*stored.fields, *[T.StructField(f.name, f.dataType) for f in new.fields if f.name not in types]])


def _conform(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields], *more)


def _write(df: DataFrame, path: str, version: int, name: str, keys: Sequence[str]) -> int | None:
    """The files of one version; returns the longest window among its rows."""
    seen, span = Observation(), set(SPAN) <= set(df.columns)
    rows = df.hint("rebalance", F.col(name)).sortWithinPartitions(name, *keys)
    if span:
        rows = rows.observe(seen, F.expr(f"max(unix_micros({SPAN[1]}) - unix_micros({SPAN[0]}))").alias("longest"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").option(f"parquet.bloom.filter.expected.ndv#{keys[0]}", "10000")
     .partitionBy(name).parquet(f"{path}/{VERSION}={version}"))
    return seen.get["longest"] if span else None


def _clean(spark: SparkSession, path: str, before: Manifest | None, now: Manifest) -> None:
    """Delete what neither this version nor the one before names."""
    older = [n for n in _numbers(spark, path) if before is None or n < before.version]
    if not older:
        return
    kept = {*now.folders.items(), *(before.folders.items() if before else ())}
    for n in older:
        if n != now.version:
            for folder, v in manifest(spark, path, n).folders.items():
                if (folder, v) not in kept:
                    _drop(spark, f"{path}/{VERSION}={v}/{folder}")
            _drop(spark, f"{path}/_versions/{n:012d}.json")


def _next(spark: SparkSession, path: str, before: Manifest | None) -> int:
    """A number whose folder nobody wrote to, also not a write that stopped half-way."""
    used = [int(n.partition("=")[2]) for n in _names(spark, path) if n.startswith(f"{VERSION}=")]
    return max([before.version if before else 0, *used]) + 1


def save_table(df: DataFrame, path: str, partition: tuple[str, str] = DATE_PARTITION,
               keys: Sequence[str] = ("city", "window_start")) -> int:
    """Replace the table; returns the new version.  The version before stays readable."""
    spark, (name, how) = df.sparkSession, partition
    before = manifest(spark, path)
    version = _next(spark, path, before)
    rows = df.withColumn(name, F.expr(how))
    longest = _write(rows, path, version, name, keys)
    return _switch(spark, path, before, version, df.schema, rows.schema[name], {}, longest)


def _switch(spark, path, before, version, schema, field, kept, longest) -> int:
    folders = [n for n in _names(spark, f"{path}/{VERSION}={version}") if "=" in n]
    live = {**kept, **dict.fromkeys(folders, version)}
    written = {version: len(folders), **(before.written if before else {})}
    now = Manifest(version, T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]),
                   T.StructField(field.name, field.dataType), live,
                   {v: n for v, n in written.items() if v in set(live.values())}, longest)
    _publish(spark, path, now)
    _clean(spark, path, before, now)
    return version


def upsert_table(new: DataFrame, path: str, keys: Sequence[str] = ("city", "window_start"), by: str = "window_end",
                 partition: tuple[str, str] = DATE_PARTITION) -> int | None:
    """Merge rows into the table, keeping per key the row with the latest ``by``; returns the new version.

    On equal ``by`` the newly arrived row wins, and among new rows the largest in the remaining columns, so
    repeating a batch changes nothing.  Either side may lack columns of the other (NULL there).  A
    column that arrives in a narrower type is cast to the stored one; in a wider or another type it is an error, before anything is
    written.  The partition must follow from the keys.  Only partitions that ``new`` touches are read and rewritten.
    """
    spark, (name, how) = new.sparkSession, partition
    before = manifest(spark, path)
    schema = _merged_schema(before.schema, new.schema) if before else new.schema
    # computed once; its partitions are then found from one column of the stored rows
    fresh = spool(_conform(new, schema).withColumn(name, F.expr(how)), "batch")
    touched = [r[0] for r in fresh.select(name).distinct().collect()]
    if not touched:
        return None
    rows, kept = fresh.withColumn("__fresh", F.lit(1)), {}
    if before:
        wanted = F.col(name).isin([v for v in touched if v is not None])
        old = _frame(spark, path, before).where(wanted | F.col(name).isNull() if None in touched else wanted)
        rows = rows.unionByName(_conform(old, schema, name).withColumn("__fresh", F.lit(0)))
        kept = before.folders
    ties = ["__fresh DESC", *tie_break(new, [*keys, by])]
    version = _next(spark, path, before)
    longest = _write(dedup_latest(rows, keys, by, ties=ties).drop("__fresh"), path, version, name, keys)
    known = [x for x in (longest, before.longest_us if before else None) if x is not None]
    return _switch(spark, path, before, version, schema, fresh.schema[name], kept, max(known, default=None))
