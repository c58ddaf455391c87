"""Projections, filters, orderings and row limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.comfort import comfort_band, comfort_index, temp_range, whole_seconds
from ..functions.numeric import clip, round_sql
from ..functions.times import Instant, instant_sql
from ..session import spool
from .latest import latest_per_key, tie_break
from .ranks import largest_n

KELVIN_OFFSET = 273.15         # fixed value


def _ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Order by SQL terms such as ``window_end DESC``."""
    return df.orderBy(*[F.col(c.removesuffix(" DESC")).desc() if c.endswith(" DESC") else F.col(c)
                        for c in order])


def enrich(df: DataFrame) -> DataFrame:
    """Add temp_range, window_duration_sec and comfort_index."""
    return df.withColumns({
        "temp_range": temp_range(),
        "window_duration_sec": whole_seconds(),
        "comfort_index": comfort_index(),
    })


def in_cities(df: DataFrame, cities: Sequence[str], key: str = "city") -> DataFrame:
    return df.where(F.col(key).isin(list(cities)))


def by_city(df: DataFrame, city: str | None, key: str = "city") -> DataFrame:
    """Rows of one city; ``"all"``, empty or None means every row."""
    return df if city in (None, "", "all") else df.where(F.col(key) == city)


def since(df: DataFrame, hours: float, as_of: Instant = None,
          longest_window: str | None = None) -> DataFrame:
    """Rows with ``window_end`` in the last ``hours`` before ``as_of``.

    If the table is partitioned by ``window_date`` (the date of ``window_start``) and the
    caller states the longest window it holds, whole partitions are skipped as well.
    """
    cutoff = f"({instant_sql(as_of)} - make_dt_interval(0, 0, 0, {round(hours * 3600)}))"
    out = df.where(f"window_end >= {cutoff}")
    if longest_window and "window_date" in df.columns:
        out = out.where(f"window_date >= to_date({cutoff} - INTERVAL {longest_window})")
    return out


def timeline(df: DataFrame, cities: Sequence[str] | None = None, hours: float | None = 1,
             as_of: Instant = None, longest_window: str | None = None) -> DataFrame:
    """Temperature over time for the chosen cities, oldest first."""
    out = df if cities is None else in_cities(df, cities)
    if hours is not None:
        out = since(out, hours, as_of, longest_window)
    return out.select("city", "window_end", "avg_temp").orderBy("window_end", "city")


def city_timeline_sorted(df: DataFrame) -> DataFrame:
    """Whole table ordered by city, then window start (range-partitioned sort)."""
    return df.orderBy("city", "window_start")


def to_celsius(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c) - F.lit(KELVIN_OFFSET) for c in columns})


def latest_records(df: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` rows, rounded for display."""
    top = _ordered(df, ["window_end DESC", *tie_break(df, ["window_end"])]).limit(n)
    return top.selectExpr(
        "city", "window_end",
        *[f"{round_sql(c, 1)} AS {c}" for c in ("avg_temp", "min_temp", "max_temp")],
        *[f"CAST({round_sql(c, 0)} AS BIGINT) AS {c}" for c in ("avg_humidity", "avg_pressure")],
        f"{round_sql('avg_wind_speed', 1)} AS avg_wind_speed", "count")


def current_temps(df: DataFrame) -> DataFrame:
    return latest_per_key(df).orderBy(F.col("avg_temp").desc(), "city")


def scatter_points(df: DataFrame) -> DataFrame:
    """Latest row per city with a marker size that is never below 1."""
    return latest_per_key(df).select(
        "city", "avg_humidity", "avg_wind_speed", "avg_temp",
        clip("(avg_temp + 50D)", low=1.0).alias("size"))


def comfort_gauges(df: DataFrame, cities: Sequence[str], show: int = 4) -> DataFrame:
    """The most comfortable of the chosen cities, by their latest row."""
    return (latest_per_key(in_cities(df, cities))
            .select("city", comfort_index().alias("comfort"))
            .withColumn("band", comfort_band("comfort"))
            .orderBy(F.col("comfort").desc(), "city").limit(show))


def retain_last_n(df: DataFrame, n: int, sequence: str, ties: Sequence[str] | None = None) -> DataFrame:
    """Only the ``n`` rows with the highest arrival sequence, oldest first.

    ``sequence`` is a column of any type that sorts; ties go by the other columns, largest first.
    """
    rest = tie_break(df, [sequence]) if ties is None else list(ties)
    return largest_n(df, n, sequence, rest).orderBy(sequence)


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same for any partitioning.

    The order is a hash of id and seed, then the other columns that sort, largest first; a NULL id has a hash too.
    Nothing is sorted globally: rows are counted by the first 16 bits of the hash, prefixes that fit wholly are
    kept wholly, and the one prefix in which the n-th row falls is dealt by range (``largest_n``), however
    many rows share an id.
    """
    hashed = df.withColumn("__hash", F.expr(
        f"md5(concat(coalesce(CAST({id_col} AS STRING), 'no id'), '-{seed}'))"))
    hashed = hashed.withColumn("__prefix", F.substring("__hash", 1, 4))
    # at most 65536 rows, whatever the table size
    room = spool(hashed.groupBy("__prefix").agg(F.expr("count(1) AS __c"))
                 .selectExpr("__prefix", "__c", f"{n} - sum(__c) OVER (ORDER BY __prefix) + __c AS __room")
                 .where("__room > 0"), "room")
    whole = hashed.join(F.broadcast(room.where("__room >= __c").select("__prefix")), "__prefix", "left_semi")
    edge = room.where("__room < __c").first()
    if edge is None:
        return whole.drop("__hash", "__prefix")
    # the least hashes are the largest of their complements
    cut = hashed.where(F.col("__prefix") == edge["__prefix"]).withColumn(
        "__hash", F.translate("__hash", "0123456789abcdef", "fedcba9876543210"))
    rest = [f"`{c}` DESC" for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return whole.unionByName(largest_n(cut, edge["__room"], "__hash", rest)).drop("__hash", "__prefix")
