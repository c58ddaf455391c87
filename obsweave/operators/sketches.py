"""Quantiles of long periods from sketches stored per day.

A day's values are read once, into one KLL sketch per key; any period is then the merge of its days' sketches, a few
kilobytes each, however many rows they stand for.  With the default size the rank of a reported quantile is
off by no more than ``RANK_ERROR`` in 99 of 100 cases; a key with fewer values than the size is exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import PERCENTILES

SIZE = 800
RANK_ERROR = 0.005


def daily_sketches(df: DataFrame, key: str = "city", value: str = "avg_temp", time_col: str = "window_start",
                   size: int = SIZE) -> DataFrame:
    """``key``, ``day``, ``sketch``; NULL and NaN are left out."""
    return (df.where(f"NOT isnan({value}) AND {value} IS NOT NULL")
            .groupBy(key, F.to_date(time_col).alias("day")).agg(F.kll_sketch_agg_double(value, size).alias("sketch")))


def merged_quantiles(sketches: DataFrame, key: str = "city", wanted: Mapping[str, float] = PERCENTILES,
                     size: int = SIZE) -> DataFrame:
    """Quantiles per key over the days that ``sketches`` has; one column each."""
    merged = sketches.groupBy(key).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return merged.select(key, *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name)
                                for name, p in wanted.items()])


def rank_errors(found: DataFrame, df: DataFrame, key: str = "city", value: str = "avg_temp",
                wanted: Mapping[str, float] = PERCENTILES) -> DataFrame:
    """How far the rank of each quantile is from the one wanted: ``key, name, error`` as a share of the key's rows."""
    long = found.select(key, F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p"), F.col(n).alias("q")) for n, p in wanted.items()]
        )).alias("x")).select(F.col(key).alias("k"), "x.*")
    values = df.where(f"NOT isnan({value}) AND {value} IS NOT NULL").select(key, F.col(value).alias("v"))
    ranks = (values.join(long, F.col(key).eqNullSafe(F.col("k"))).groupBy("k", "name", "p")
             .agg(F.expr("count_if(v < q) / count(1)").alias("below"), F.expr("count_if(v <= q) / count(1)").alias("upto")))
    return ranks.selectExpr(f"k AS {key}", "name", "greatest(below - p, p - upto, 0D) AS error")
