"""The registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.comfort import register_sql_functions
from ..functions.quality import Bounds
from ..operators import aggregate as agg
from ..operators import assign, latest, requests, reshape, rolling, select, sketches, sqltext, validate
from ..schemas import RUN_RESULT
from ..session import spool, use_utc, work_path
from ..sinks import arrow_files, tables, versions
from ..sources import messages as msg
from ..sources.files import PARTITION_DATE, load_parquet
from ..sources.message_log import append_log, read_log, stream_log
from ..sources.streams import open_stream
from ..streaming import jobs, windows as stream_windows
from . import inputs
from .report import report, write_report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CITIES = ["click", "purchase", "view"]
NOW = "2024-01-25 00:00:00"
BOUNDS = Bounds(timestamp_max_lag_sec=2_000_000)
# the numbers of a run's summary, but for its extremes
METRICS = [n for n in (field.split()[0] for field in RUN_RESULT.split(","))
           if n not in ("name", "timestamp", "min_latency_ms", "max_latency_ms")]
RUNS = ["run-a", "run-b"]


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without zone, as the checking engine has them."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
                           if isinstance(f.dataType, T.TimestampType)})


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(fn(use_utc(spark), sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _on_aggregates(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(inputs.aggregates(spark, sf_dir))
    run.__name__ = name
    query(run)


def _on_stored(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """For operators that read their input more than once: the aggregates stored as a table."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spool(inputs.aggregates(spark, sf_dir), "aggregates"))
    run.__name__ = name
    query(run)


def _on_readings(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(inputs.readings(spark, sf_dir))
    run.__name__ = name
    query(run)


# -- windows, summaries, rankings ------------------------------------------------

_on_aggregates("tumbling_aggregate", lambda a: a)
_on_aggregates("enrich", select.enrich)
_on_aggregates("city_summary", lambda a: agg.city_summary(select.enrich(a)))
_on_aggregates("hourly_stats", agg.hourly_stats)
_on_aggregates("percentiles", agg.temperature_percentiles)
_on_aggregates("anomalies", agg.anomalies)
_on_aggregates("humidity_by_hour", agg.humidity_by_hour)
_on_aggregates("humidity_pivot", reshape.humidity_pivot)
_on_aggregates("comfort_by_city", agg.comfort_by_city)
_on_aggregates("demo_summary", agg.demo_summary)
_on_aggregates("mean_by_city", agg.mean_by_city)
_on_aggregates("kpi_latest", agg.kpi_latest)
_on_aggregates("distinct_cities", agg.distinct_cities)
_on_aggregates("table_counts", agg.table_counts)
_on_aggregates("histogram", agg.histogram)
_on_aggregates("rolling_mean", lambda a: rolling.rolling_mean(a, 5))
_on_aggregates("latest_per_key", latest.latest_per_key)
_on_aggregates("current_temps", select.current_temps)
_on_aggregates("scatter_points", select.scatter_points)
_on_aggregates("comfort_gauges", lambda a: select.comfort_gauges(a, CITIES))
_on_aggregates("latest_records", select.latest_records)
_on_aggregates("timeline", lambda a: select.timeline(a, CITIES, 48, as_of="2024-01-30 00:00:00"))
_on_aggregates("by_city", lambda a: select.by_city(a, "click"))
_on_aggregates("city_timeline_sorted", select.city_timeline_sorted)
_on_stored("union_diagonal", lambda a: reshape.union_diagonal(a, select.enrich(a)))
_on_stored("report_top10", lambda a: report(a)["top10"])


@query
def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings checked, folded into windows, best five cities."""
    good = validate.clean(inputs.readings(spark, sf_dir), BOUNDS, NOW)
    return agg.top_cities_by_temp(inputs.tumbling(good, inputs.WINDOW, shards=inputs.SHARDS), 5)


@query
def sql_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT city, COUNT(*) AS windows, MAX(max_temp) AS hottest
        FROM {src} WHERE count >= :least GROUP BY city ORDER BY city
    """
    return sqltext.sql_over(spark, text, inputs.aggregates(spark, sf_dir), {"least": 2})


@query
def comfort_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comfort score called as a SQL function."""
    register_sql_functions(spark)
    text = """
        SELECT city, window_start, comfort_index(avg_temp, avg_humidity, avg_wind_speed) AS comfort_index
        FROM {src}
    """
    return sqltext.sql_over(spark, text, inputs.aggregates(spark, sf_dir))


# -- validation --------------------------------------------------------------------

_on_readings("clean_rows", lambda r: validate.clean(r, BOUNDS, NOW))
_on_readings("validation_errors", lambda r: validate.error_list(r, "reading_id", BOUNDS, NOW))
_on_readings("errors_by_field", lambda r: validate.errors_by_field(r, BOUNDS, NOW))
_on_readings("validation_report", lambda r: validate.report(r, BOUNDS, NOW).drop("errors_by_field"))
_on_readings("reduced_mask", lambda r: validate.reduced_mask(r))
_on_readings("to_celsius", lambda r: select.to_celsius(r, ["temperature", "wind_speed"])
             .select("reading_id", "city", "temperature", "wind_speed"))


@query
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = validate.tag(inputs.readings(spark, sf_dir), BOUNDS, NOW)
    return tagged.select("reading_id", "is_valid", F.array_join(F.transform(
        "errors", lambda e: F.concat(e["field"], F.lit(": "), e["message"])), "; ").alias("errors"))


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = validate.quarantine(inputs.readings(spark, sf_dir), BOUNDS, NOW)
    return bad.withColumn("errors", F.size("errors").cast("bigint"))


# -- messages ----------------------------------------------------------------------

@query
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.decode_aggregates(inputs.messages(inputs.aggregates(spark, sf_dir))).good


@query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = msg.decode_aggregates(inputs.messages(inputs.aggregates(spark, sf_dir))).dead
    return dead.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = inputs.aggregates(spark, sf_dir)
    return aggs.select("city", "window_start", msg.encode_aggregates(aggs.columns).alias("value"))


_on_aggregates("kv_projection", msg.key_value)


@query
def flatten_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.split_payloads(inputs.payloads(inputs.table(spark, sf_dir, "events"))).good


@query
def payload_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads cut short or with a word where a number belongs."""
    dead = msg.split_payloads(inputs.payloads(inputs.table(spark, sf_dir, "events"))).dead
    return dead.select("event_id", "reason")


@query
def epoch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = tables.to_epoch(inputs.aggregates(spark, sf_dir))
    return tables.from_epoch(seconds.withColumn("start_s", F.col("window_start"))).select(
        "city", "start_s", "window_start", "window_end", F.col("count").cast("int").alias("count"))


# -- tables ------------------------------------------------------------------------

_AGG_COLUMNS = [f.name for f in tables.AGGREGATE.fields]


@query
def scan_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table written by date and scanned back."""
    path = work_path(spark, "aggregates")
    tables.save_parquet(inputs.aggregates(spark, sf_dir), path)
    return load_parquet(spark, path, partition=PARTITION_DATE).select(*_AGG_COLUMNS)


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with a second delivery for some cities: later window end, more readings."""
    path = work_path(spark, "aggregates")
    versions.save_table(inputs.aggregates(spark, sf_dir).select(*_AGG_COLUMNS), path)
    first = versions.load_table(spark, path).select(*_AGG_COLUMNS)
    second = select.in_cities(first, CITIES).withColumns({
        "window_end": F.col("window_end") + F.expr("INTERVAL 10 MINUTES"),
        "count": F.col("count") + 100})
    versions.upsert_table(second, path)
    return load_parquet(spark, path, partition=PARTITION_DATE).select(*_AGG_COLUMNS)


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.dedup_latest(inputs.table(spark, sf_dir, "lineitem"),
                               ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def retain_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.retain_last_n(inputs.table(spark, sf_dir, "events"), 1000, "event_id")


@query
def retain_last_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than a heap should hold, by a sequence of times."""
    return select.retain_last_n(inputs.table(spark, sf_dir, "lineitem"), 12_000, "l_shipdate",
                                ["l_orderkey DESC", "l_linenumber DESC"])


@query
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return select.sample_n(events, 500, "event_id", seed=42)


# -- assignment and lookup -----------------------------------------------------------

@query
def assign_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dealt out over the regions."""
    items = inputs.table(spark, sf_dir, "events").select("event_id", "event_type")
    return assign.assign_round_robin(items, inputs.table(spark, sf_dir, "region"), "event_id", "r_name")


@query
def dim_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations asked for in changed case, with spaces, some of them unknown."""
    asked = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit(" Nation_"), (F.col("user_id") % 30).cast("string"), F.lit(" ")).alias("asked"))
    return assign.dim_lookup(asked, inputs.table(spark, sf_dir, "nation"), "asked", "n_name",
                             {"n_nationkey": 0, "n_name": ""})


# -- request logs --------------------------------------------------------------------

def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.request_log(inputs.table(spark, sf_dir, "events"))
    return requests.latency_summary(log)


@query
def request_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_stats(inputs.request_log(inputs.table(spark, sf_dir, "events")))


@query
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


@query
def latency_wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Throughput by the time from a run's first request to its last."""
    log = inputs.request_log(inputs.table(spark, sf_dir, "events"))
    return requests.latency_summary(log, "(unix_micros(max(sent_at)) - unix_micros(min(sent_at))) / 1000000D")


@query
def throughput_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.throughput_ratio(_summary(spark, sf_dir))


@query
def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.success_rate(_summary(spark, sf_dir))


@query
def metric_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = reshape.metric_matrix(_summary(spark, sf_dir), METRICS, RUNS)
    return wide.select("metric", *[F.col(r).alias(r.replace("-", "_")) for r in RUNS])


# -- streams -------------------------------------------------------------------------

def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_stream(spark, "parquet", path=sf_dir, schema=inputs.EVENTS, files="events.parquet")


@query
def stream_windows_drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream, upserted into the table, plus those still open when it stops."""
    table, checkpoint = work_path(spark, "stream-table"), work_path(spark, "stream-checkpoint")
    live = inputs.readings_of(_event_stream(spark, sf_dir))
    jobs.start_windows(live, table, checkpoint, size=inputs.WINDOW, delay="2 hours", bounds=None,
                       shards=inputs.SHARDS).awaitTermination()
    still_open = stream_windows.drain_state(spark, checkpoint, live, shards=inputs.SHARDS)
    versions.upsert_table(still_open.select(*_AGG_COLUMNS), table)
    return load_parquet(spark, table, partition=PARTITION_DATE).select(*_AGG_COLUMNS)


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings split by a stream: the rejected ones with the number of their errors, the others marked by 0."""
    good, bad = work_path(spark, "good"), work_path(spark, "bad")
    live = inputs.readings_of(_event_stream(spark, sf_dir))
    jobs.start_intake(live, good, bad, work_path(spark, "intake-checkpoint"), bounds=BOUNDS, now=NOW).awaitTermination()
    kept = load_parquet(spark, good, live.schema).select("reading_id", F.lit(0).cast("bigint").alias("errors"))
    return kept.unionByName(spark.read.parquet(bad).select("reading_id", F.size("errors").cast("bigint").alias("errors")))


@query
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 300 events, kept by a stream."""
    path = work_path(spark, "history")
    live = _event_stream(spark, sf_dir)
    jobs.start_history(live, path, work_path(spark, "history-checkpoint"), n=300, sequence="event_id").awaitTermination()
    return jobs.history(spark, path, live.schema)


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of every type, kept by a stream."""
    table, checkpoint = work_path(spark, "latest"), work_path(spark, "latest-checkpoint")
    live = _event_stream(spark, sf_dir).select(
        F.col("event_type").alias("city"), F.col("ts").cast("timestamp").alias("window_end"),
        "event_id", "value")
    jobs.start_latest(live, table, checkpoint).awaitTermination()
    return load_parquet(spark, table, live.schema).select("city", "window_end", "event_id", "value")


@query
def log_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates as messages of a log, one part sent twice; a stream with an admission limit brings them into the table."""
    log, table = work_path(spark, "log"), work_path(spark, "replayed")
    sent = spool(inputs.aggregates(spark, sf_dir), "aggregates")
    for epoch in (0, 1, 1):
        append_log(msg.key_value(sent.where(f"hour(window_start) % 2 = {epoch}")), log, "collector", epoch)
    live = stream_log(spark, log, "earliest", "table", max_offsets=20_000)
    jobs.run_until_idle(jobs.start_messages(live, table, work_path(spark, "dead"), work_path(spark, "replay-checkpoint"),
                                            every="0 seconds"))
    return load_parquet(spark, table, partition=PARTITION_DATE).select(*_AGG_COLUMNS)


@query
def log_last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest message of every key of a log."""
    log = work_path(spark, "log")
    events = inputs.table(spark, sf_dir, "events").orderBy("event_id")
    append_log(events.selectExpr("event_type AS key", "CAST(event_id AS STRING) AS value"), log)
    return read_log(spark, log, startingOffsets="lastPerKey").selectExpr("key", "CAST(value AS BIGINT) AS event_id")


@query
def log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per key, and whether the offsets of their log partition have no gap."""
    log = work_path(spark, "log")
    events = inputs.table(spark, sf_dir, "events")
    append_log(events.selectExpr("event_type AS key", "props AS value"), log)
    read = read_log(spark, log)
    parts = read.groupBy("partition").agg(F.expr(
        "min(offset) = 0 AND max(offset) = count(1) - 1 AND count(DISTINCT offset) = count(1) AS gapless"))
    return (read.groupBy("partition", "key").agg(F.count(F.lit(1)).alias("n")).join(parts, "partition")
            .select("key", "n", "gapless"))


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that arrive in two deliveries, sorted by a stream into on time, late and rejected."""
    src, good, late, bad = (work_path(spark, n) for n in ("deliveries", "good", "late", "bad"))
    for odd in (0, 1):
        (inputs.table(spark, sf_dir, "events").where(f"event_id % 2 = {odd}").coalesce(1)
         .write.mode("append").parquet(src))
    live = inputs.readings_of(open_stream(spark, "parquet", path=src, schema=inputs.EVENTS, max_files=1))
    jobs.start_intake(live, good, bad, work_path(spark, "late-checkpoint"), bounds=BOUNDS, now=NOW, late_path=late,
                      size=inputs.WINDOW, delay="2 hours").awaitTermination()
    out = None
    for kind, path in (("on time", good), ("late", late), ("rejected", bad)):
        part = load_parquet(spark, path, live.schema).select("reading_id", F.lit(kind).alias("kind"))
        out = part if out is None else out.unionByName(part)
    return out


# -- stored tables --------------------------------------------------------------------

@query
def timeline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline of the last two days from the stored table, which knows the dates that can be skipped."""
    path = work_path(spark, "timeline")
    versions.save_table(inputs.aggregates(spark, sf_dir), path)
    return select.timeline(versions.load_table(spark, path), CITIES, 48, as_of="2024-01-30 00:00:00",
                           longest_window=versions.longest_window(spark, path))


@query
def mean_by_city_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the path of a stored table."""
    path = work_path(spark, "sql-table")
    inputs.aggregates(spark, sf_dir).write.parquet(path)
    return sqltext.mean_by_city_sql(spark, path)


@query
def percentile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles merged from sketches stored per day: is the rank of each within the stated error?"""
    aggs = spool(inputs.aggregates(spark, sf_dir), "aggregates")
    stored = spool(sketches.daily_sketches(aggs), "sketches")
    found = sketches.merged_quantiles(stored)
    # twice the error of 99 in 100 cases
    return (sketches.rank_errors(found, aggs)
            .selectExpr("city", "name", f"error <= {2 * sketches.RANK_ERROR} AS within"))


@query
def arrow_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregates exported as Arrow files by the executors and read back."""
    path = work_path(spark, "arrow")
    arrow_files.export_arrow(tables.arrow_columns(inputs.aggregates(spark, sf_dir)), path, "window_start")
    return arrow_files.load_arrow(spark, path)


@query
def report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six tables of the closing report as they were written, one below the other."""
    path = work_path(spark, "report")
    write_report(inputs.aggregates(spark, sf_dir), path)
    shapes = {"top10": ("''", "mean_temp"), "timeline": ("date_format(window_end, 'yyyy-MM-dd HH:mm')", "avg_temp"),
              "histogram": ("CAST(bin AS STRING)", "CAST(n AS DOUBLE)"), "humidity_by_hour": ("CAST(hour AS STRING)", "humidity"),
              "comfort": ("''", "avg_comfort"), "mean_by_city": ("''", "mean_temp")}
    out = None
    for part, (place, value) in shapes.items():
        rows = spark.read.parquet(f"{path}/{part}").selectExpr(f"'{part}' AS part", "city", f"{place} AS place", f"{value} AS value")
        out = rows if out is None else out.unionByName(rows)
    return out
