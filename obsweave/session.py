"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

WORK_DIR_SETTING = "spark.checkpoint.dir"

# What the operators assume.  Cluster sizes (executors, memory, shuffle partitions)
# are left to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # do not record Python call sites for every expression: building a plan gets several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_work_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app_name: str = "obsweave", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Observation times are UTC; every entry point pins the session to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only where none is named."""
    named = spark.sparkContext.getConf().get(WORK_DIR_SETTING) or spark.conf.get(WORK_DIR_SETTING, None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_work_dirs:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {WORK_DIR_SETTING} to a folder all executors can reach")
        _local_work_dirs[app] = tempfile.mkdtemp(prefix="obsweave-")
    return _local_work_dirs[app]


def work_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/obsweave/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def spool(df: DataFrame, label: str, compression: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Write a reduced intermediate result to the work folder and read it back.

    Three uses: its lineage is cut in storage that outlives executors, it is computed
    once however often it is used, and Spark afterwards knows its size from the files.
    A join with it is therefore broadcast only if it measures below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a sort-merge join (with AQE
    splitting hot keys) otherwise; no hint is needed.

    ``group_rows``: rows of a Parquet row group at most, for rows of megabytes.  A reader decodes up to 4096 rows of a
    group at once, a writer holds a group.
    """
    path = work_path(df.sparkSession, label)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for what runs Python there."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = os.path.dirname(os.path.abspath(__file__))
        spark.sparkContext.addPyFile(shutil.make_archive(
            os.path.join(tempfile.mkdtemp(), "package"), "zip", os.path.dirname(package), os.path.basename(package)))
