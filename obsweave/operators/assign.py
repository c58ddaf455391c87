"""Work assignment and dimension lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import spool


def _ranked(shards: DataFrame, shard_col: str) -> DataFrame:
    """Shard ids with their rank.  A registry of live workers: one window over it is small."""
    ids = shards.select(F.col(shard_col).alias("shard")).where("shard IS NOT NULL").distinct()
    one = Window.orderBy("shard")
    return ids.select("shard", (F.row_number().over(one) - 1).alias("rank"),
                      F.count(F.lit(1)).over(Window.partitionBy()).alias("shards"))


def assign_round_robin(items: DataFrame, shards: DataFrame, pos: str = "pos",
                       shard_col: str = "shard") -> DataFrame:
    """Give item ``pos`` to the shard with rank ``pos mod n`` (ids sorted).

    Adds ``shard``; it is NULL for an item without a position.  Without shards every item keeps NULL, meaning everyone takes it.
    The position is the item's place in the agreed order, counted from 0.  Runs one small
    job over the shard registry.
    """
    ranked = spool(_ranked(shards, shard_col), "shards")
    n = ranked.agg(F.max("shards")).first()[0]
    if n is None:
        return items.withColumn("shard", F.lit(None).cast("string"))
    return (items.withColumn("__slot", F.pmod(F.col(pos), F.lit(n)).cast("int"))
            .join(ranked.select(F.col("rank").alias("__slot"), "shard"), "__slot", "left").drop("__slot"))


def assigned_to(items: DataFrame, shards: DataFrame, my_id: str, pos: str = "pos",
                shard_col: str = "shard") -> DataFrame:
    """The items of one shard; all of them if there are no shards or it is not listed.

    A filter, not a join: only the caller's rank and the number of shards are needed.
    """
    ids = shards.select(F.col(shard_col).alias("s")).where("s IS NOT NULL").distinct()
    found = ids.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("s") < my_id).alias("rank"),
                    F.count_if(F.col("s") == my_id).alias("listed")).first()
    if not found["listed"]:
        return items
    return items.where(F.pmod(F.col(pos), F.lit(found["n"])) == found["rank"])


def dim_lookup(requests: DataFrame, dimension: DataFrame, key: str, dim_key: str,
               defaults: Mapping[str, object]) -> DataFrame:
    """Look up keys whatever their case and outer white space.

    Every request row is kept.  ``found`` tells whether the key is known; the columns named
    in ``defaults`` come from the dimension, or are the default for an unknown key.  Of
    dimension rows whose keys differ in case or white space only, the first in the order of
    (key, looked-up columns) counts.
    """
    def norm(c: str):
        return F.lower(F.regexp_replace(F.col(c), r"^\s+|\s+$", ""))

    first = F.min(F.struct(F.col(dim_key).alias("__key"), *[F.col(c) for c in defaults]))
    dim = (dimension.groupBy(norm(dim_key).alias("__k")).agg(first.alias("__d"))
           .select("__k", *[F.col(f"__d.{c}").alias(c) for c in defaults], F.lit(True).alias("__hit")))
    joined = requests.withColumn("__k", norm(key)).join(dim, "__k", "left")
    return joined.select(
        *requests.columns, F.coalesce("__hit", F.lit(False)).alias("found"),
        *[F.when(F.col("__hit"), F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in defaults.items()])


def lookup_one(dimension: DataFrame, dim_key: str, value: str) -> DataFrame:
    """The dimension row of one key in any case; no row if unknown."""
    return dimension.where(F.lower(F.col(dim_key)) == value.lower())
