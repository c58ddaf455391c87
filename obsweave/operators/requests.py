"""Summaries of request logs: latency, errors and comparisons of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_sql, summarize
from .ranks import values_at

PERCENTS = (50, 95, 99)      # fixed values: the reported percentiles


def request_stats(log: DataFrame, round_col: str = "round", latency: str = "response_time_ms",
                  error: str = "error") -> DataFrame:
    """Per poll round: total, success, errors, mean latency of the successes (0 if none)."""
    ok = log.selectExpr(round_col, error, f"CASE WHEN {error} IS NULL THEN {latency} END AS ok_ms")
    found = summarize(ok, [round_col], {"ms": ("ok_ms", 2)}, {
        "total": "count(1)", "success": f"count_if({error} IS NULL)", "errors": f"count_if({error} IS NOT NULL)"})
    return found.selectExpr(round_col, "total", "success", "errors", "coalesce(ms, 0D) AS avg_response_ms")


def indexed_percentiles(log: DataFrame, keys: Sequence[str], value: str,
                        percents: Sequence[int] = PERCENTS) -> DataFrame:
    """Per group the value at position ``min(floor(n*p/100), n-1)`` of the sorted values."""
    def place(p: float) -> str:
        return f"least(floor(total * {p} / 100), total - 1)"

    at = values_at(log, keys, value, f"array({', '.join(map(place, percents))})")
    return at.groupBy(*keys).agg(*[
        F.expr(f"{round_sql(f'max(CASE WHEN pos = {place(p)} THEN v END)', 2)} AS p{p}_latency_ms")
        for p in percents])


def latency_summary(log: DataFrame, elapsed: str | None = None, name_col: str = "name",
                    latency: str = "response_time_ms", error: str = "error") -> DataFrame:
    """One row per run: counts, throughput, mean/min/max and index-based p50/p95/p99.

    ``elapsed`` is SQL for an aggregate that gives a run's duration in seconds; None means
    the requests were sent one after the other.  Failed requests count towards the
    latencies.  Throughput of a run without duration is NULL.
    """
    base = summarize(log, [name_col], {"mean_ms": (latency, None)}, {
        "total_requests": "count(1)", "successful": f"count_if({error} IS NULL)",
        "failed": f"count_if({error} IS NOT NULL)", "timed": f"count({latency})",
        "min_ms": f"min({latency})", "max_ms": f"max({latency})",
        **({"elapsed": f"CAST({elapsed} AS DOUBLE)"} if elapsed else {})})
    if not elapsed:
        base = base.selectExpr("*", "mean_ms * timed / 1000D AS elapsed")
    ranks = indexed_percentiles(log, [name_col], latency).withColumnRenamed(name_col, "r_name")
    return (base.join(ranks, F.expr(f"{name_col} <=> r_name"), "left").selectExpr(
        name_col, "total_requests", "successful", "failed",
        f"{round_sql('elapsed', 3)} AS total_time_sec",
        f"{round_sql('(total_requests / nullif(elapsed, 0D))', 2)} AS throughput_rps",
        f"coalesce({round_sql('mean_ms', 2)}, 0D) AS avg_latency_ms",
        *[f"coalesce(p{p}_latency_ms, 0D) AS p{p}_latency_ms" for p in PERCENTS],
        f"coalesce({round_sql('min_ms', 2)}, 0D) AS min_latency_ms",
        f"coalesce({round_sql('max_ms', 2)}, 0D) AS max_latency_ms"))


def throughput_ratio(results: DataFrame, name_col: str = "name", rps: str = "throughput_rps") -> DataFrame:
    """Fastest run and how many times faster it is than the slowest; empty unless both are above 0."""
    return (results.agg(F.expr("count(1) AS runs"), F.expr(f"min({rps}) AS slowest"),
                        F.expr(f"max(struct({rps} AS rps, {name_col} AS name)) AS best"))
            .where("runs >= 2 AND slowest > 0")
            .selectExpr("best.name AS winner", f"{round_sql('(best.rps / slowest)', 1)} AS ratio"))


def success_rate(results: DataFrame, name_col: str = "name") -> DataFrame:
    """Success and failure shares in percent; runs without requests are left out."""
    def share(c: str) -> str:
        return round_sql(f"({c} * 100D / nullif(total, 0))", 1)

    return (results.selectExpr(name_col, "successful", "failed", "successful + failed AS total")
            .where("total > 0")
            .selectExpr(name_col, "total", f"{share('successful')} AS success_pct",
                        f"{share('failed')} AS failure_pct"))
