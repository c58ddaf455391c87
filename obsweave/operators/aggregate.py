"""Grouped summaries of the window-aggregate table.

City means are plain means of the window means, not weighted by ``count``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.comfort import comfort_index
from ..functions.numeric import round_sql, stddev_sql, summarize
from .latest import latest_per_key
from .ranks import percentiles


def city_summary(df: DataFrame) -> DataFrame:
    """All-time summary per city, warmest first; ``avg_comfort`` is NULL on a table not enriched."""
    means = {"overall_avg_temp": ("avg_temp", 2), "overall_avg_humidity": ("avg_humidity", 1),
             "overall_avg_pressure": ("avg_pressure", 1), "overall_avg_wind": ("avg_wind_speed", 2)}
    if "comfort_index" in df.columns:
        means["avg_comfort"] = ("comfort_index", 1)
    out = summarize(df, ["city"], means, {
        "overall_min_temp": "min(min_temp)", "overall_max_temp": "max(max_temp)",
        "total_readings": "sum(count)", "window_count": "count(1)"})
    return out.selectExpr(
        "city", "overall_avg_temp", "overall_min_temp", "overall_max_temp", "overall_avg_humidity",
        "overall_avg_pressure", "overall_avg_wind", "total_readings", "window_count",
        "avg_comfort" if "avg_comfort" in means else "CAST(NULL AS DOUBLE) AS avg_comfort",
    ).orderBy(F.col("overall_avg_temp").desc(), "city")


def top_cities_by_temp(df: DataFrame, top_n: int = 5) -> DataFrame:
    found = summarize(df, ["city"], {"mean_temp": ("avg_temp", 2)}, {
        "coldest": "min(min_temp)", "hottest": "max(max_temp)",
        "total_readings": "sum(count)", "window_count": "count(1)"})
    return found.selectExpr(
        "city", "mean_temp", f"{round_sql('coldest')} AS abs_min_temp", f"{round_sql('hottest')} AS abs_max_temp",
        "total_readings", "window_count").orderBy(F.col("mean_temp").desc(), "city").limit(top_n)


def hourly_stats(df: DataFrame, time_col: str = "window_start") -> DataFrame:
    """Means per hour of day over all cities."""
    return summarize(df, [f"CAST(hour({time_col}) AS BIGINT) AS hour_of_day"], {
        "avg_temp": ("avg_temp", 2), "avg_humidity": ("avg_humidity", 1), "avg_wind": ("avg_wind_speed", 2),
    }, {"samples": "count(1)"}).orderBy("hour_of_day")


# The reported percentiles.
PERCENTILES = {"p05": 0.05, "p25": 0.25, "median": 0.50, "p75": 0.75, "p95": 0.95}


def temperature_percentiles(df: DataFrame, approximate: bool = False) -> DataFrame:
    """p05 to p95 of ``avg_temp`` per city, interpolated, highest median first.

    ``approximate`` trades exactness for one pass with a bounded sketch per city.
    """
    if approximate:
        found = df.groupBy("city").agg(
            F.percentile_approx("avg_temp", list(PERCENTILES.values()), 10_000).alias("p"))
        found = found.selectExpr("city", *[f"p[{i}] AS {n}" for i, n in enumerate(PERCENTILES)])
    else:
        found = percentiles(df, ["city"], "avg_temp", PERCENTILES)
    return (found.selectExpr("city", *[f"{round_sql(n, 2)} AS {n}" for n in PERCENTILES])
            .orderBy(F.col("median").desc(), "city"))


def anomalies(df: DataFrame, z_threshold: float = 2.0) -> DataFrame:
    """Windows whose temperature is more than ``z_threshold`` deviations off their city's mean.

    Statistics and table are one plan: what both need is computed once, and the statistics
    are broadcast only if they measure small enough when they are there.  Mean and deviation do not depend on
    how rows are partitioned.
    """
    stats = summarize(df.select("city", "avg_temp"), ["city"], {"mean_t": ("avg_temp", None)},
                      {"std_t": stddev_sql("avg_temp")})
    scored = df.select("city", "window_start", "avg_temp").join(stats, "city").selectExpr(
        "city", "window_start", "avg_temp", "abs(avg_temp - mean_t) / nullif(std_t, 0D) AS score")
    return (scored.where(F.col("score") > float(z_threshold))
            .selectExpr("city", "window_start", "avg_temp", f"{round_sql('score', 2)} AS z_score")
            .orderBy(F.col("z_score").desc(), "city", "window_start"))


def humidity_by_hour(df: DataFrame) -> DataFrame:
    """Mean humidity per city and hour of ``window_end``."""
    return summarize(df, ["city", "CAST(hour(window_end) AS BIGINT) AS hour"],
                     {"humidity": ("avg_humidity", 1)}).orderBy("city", "hour")


def comfort_by_city(df: DataFrame) -> DataFrame:
    if "comfort_index" not in df.columns:
        df = df.withColumn("comfort_index", comfort_index())
    return (summarize(df, ["city"], {"avg_comfort": ("comfort_index", 1)})
            .orderBy(F.col("avg_comfort").desc(), "city"))


def demo_summary(df: DataFrame) -> DataFrame:
    return (summarize(df, ["city"], {"mean_temp": ("avg_temp", 2)}, {"total_readings": "sum(count)"})
            .orderBy(F.col("mean_temp").desc(), "city"))


def mean_by_city(df: DataFrame) -> DataFrame:
    return (summarize(df, ["city"], {"mean_temp": ("avg_temp", 2)})
            .orderBy(F.col("mean_temp").desc(), "city"))


def kpi_latest(df: DataFrame) -> DataFrame:
    """One row: means over the latest row of every city."""
    return summarize(latest_per_key(df), [], {
        "avg_temp": ("avg_temp", None), "avg_humidity": ("avg_humidity", None),
        "avg_pressure": ("avg_pressure", None), "avg_wind": ("avg_wind_speed", None)})


def distinct_cities(df: DataFrame) -> DataFrame:
    return df.select("city").distinct().orderBy("city")


def table_counts(df: DataFrame) -> DataFrame:
    """Row count and number of cities in one pass (cities are counted from their groups)."""
    per_city = df.groupBy("city").agg(F.expr("count(1) AS n"))
    return per_city.selectExpr("coalesce(sum(n), 0L) AS row_count", "count(city) AS cities")


def histogram(df: DataFrame, key: str = "city", value: str = "avg_temp", bins: int = 15) -> DataFrame:
    """Equal-width bins over every key's own range; the last bin includes its upper end.

    Empty bins are present with 0.  If all values of a key are equal the range is widened
    by 0.5 on both sides.  Edges are ``low + i * step``; a value that floating point puts
    on the wrong side of an edge is moved to the bin whose edges hold it.  NULL and NaN have
    no bin; a NULL key is a key.
    """
    found = df.where(f"{value} IS NOT NULL AND NOT isnan({value})").select(key, F.col(value).alias("v"))
    ends = found.groupBy(key).agg(F.expr("min(v) AS a"), F.expr("max(v) AS z"))
    ranges = ends.selectExpr(key, "IF(a = z, a - 0.5D, a) AS low", "IF(a = z, z + 0.5D, z) AS high")
    step = f"((high - low) / {float(bins)!r}D)"

    def edge(i: str) -> str:
        return f"(low + ({i}) * {step})"

    last = bins - 1
    known = ranges.withColumnRenamed(key, "__key")
    counts = (found.join(known, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
              .selectExpr("*", f"least(floor((v - low) / {step}), {last}L) AS g")
              .selectExpr(key, f"CASE WHEN v < {edge('g')} THEN g - 1"
                               f" WHEN g < {last} AND v >= {edge('g + 1')} THEN g + 1 ELSE g END AS bin")
              .groupBy(F.col(key).alias("__key"), F.col("bin").alias("__bin")).agg(F.expr("count(1) AS n")))
    frame = ranges.selectExpr("*", f"explode(sequence(0L, {last}L)) AS bin")
    return (frame.join(counts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("bin") == F.col("__bin")), "left")
            .selectExpr(key, "bin", f"{edge('bin')} AS bin_start",
                        f"IF(bin = {last}, high, {edge('bin + 1')}) AS bin_end", "coalesce(n, 0L) AS n")
            .orderBy(key, "bin"))
