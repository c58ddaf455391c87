"""Exact order statistics of groups of any size.

``percentile`` keeps every distinct value of a group in one task.  Here equal values are
counted first (combined before the shuffle), and the counts are dealt by range over keys
and value together.  A hot group, or one whose values lie close together, therefore fills
many ranges; the sums of the ranges before it tell in which one a wanted position lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spool


def _in_ranges(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` dealt by range and stored, each row with the number of its range as ``part``."""
    return spool(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), label)


def _same(keys: Sequence[str]) -> str:
    return " AND ".join([*[f"{k} <=> t_{k}" for k in keys], "part = t_part"])


def _located(ranged: DataFrame, keys: Sequence[str], order: str, wanted: str) -> DataFrame:
    """The rows (each standing for ``n`` rows) that hold the wanted positions of their group.

    Adds ``total, pos`` and ``before``, the number of the group's rows ahead of this row.
    """
    by = f"PARTITION BY {', '.join(keys)} " if keys else ""
    # one row per key and range: never more than keys + ranges
    sums = ranged.groupBy(*keys, "part").agg(F.expr("sum(n) AS held"))
    targets = (sums.selectExpr(*keys, "part", "held", f"sum(held) OVER ({by}ORDER BY part) AS upto",
                               f"sum(held) OVER ({by.strip()}) AS total")
               .select("*", F.expr(f"explode(array_distinct({wanted})) AS pos"))
               .where("pos >= upto - held AND pos < upto")
               .selectExpr(*[f"{k} AS t_{k}" for k in keys], "part AS t_part", "total", "pos", "upto - held AS ahead"))
    hit = targets.select(*[f"t_{k}" for k in keys], "t_part").distinct()
    placed = ranged.join(hit, F.expr(_same(keys)), "left_semi").selectExpr(
        "*", f"sum(n) OVER (PARTITION BY {', '.join([*keys, 'part'])} ORDER BY {order}) - n AS inside")
    return (placed.join(targets, F.expr(_same(keys)))
            .withColumn("before", F.expr("ahead + inside"))
            .where("pos >= before AND pos < before + n"))


def values_at(df: DataFrame, keys: Sequence[str], value: str, wanted: str) -> DataFrame:
    """The values at given 0-based positions of every group's sorted non-NULL values.

    ``wanted`` is SQL for an array of bigint positions computed from the group size, which
    it may call ``total``.  Returns ``keys, total, pos, v``.  NaN is the largest value, a
    NULL key is a key.  One narrow pass over ``df``; its counts are kept in the work folder.
    """
    counted = (df.where(f"{value} IS NOT NULL").selectExpr(*keys, f"{value} AS v")
               .groupBy(*keys, "v").agg(F.expr("count(1) AS n")))
    ranged = _in_ranges(counted, [F.col(c) for c in (*keys, "v")], "value-counts")
    return _located(ranged, keys, "v", wanted).select(*keys, "total", "pos", "v")


def percentiles(df: DataFrame, keys: Sequence[str], value: str,
                wanted: dict[str, float]) -> DataFrame:
    """Continuous percentiles (linear interpolation) of every group, one column each.

    Between equal values, infinities included, the percentile is that value.
    """
    def place(p: float) -> str:
        return f"({float(p)!r}D * (total - 1))"

    ends = ", ".join(f"floor({place(p)}), ceil({place(p)})" for p in wanted.values())
    at = values_at(df, keys, value, f"array({ends})")
    # at most two values per percentile and group
    found = at.groupBy(*keys).agg(F.expr("first(total) AS total"),
                                  F.expr("map_from_entries(collect_list(struct(pos, v))) AS m"))

    def between(p: float) -> str:
        low, high = f"m[floor({place(p)})]", f"m[ceil({place(p)})]"
        share = f"({place(p)} - floor({place(p)}))"
        return f"IF({low} = {high}, {low}, {low} * (1D - {share}) + {high} * {share})"

    return found.selectExpr(*keys, *[f"{between(p)} AS {name}" for name, p in wanted.items()])


def largest_n(df: DataFrame, n: int, column: str, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``column`` (any type that sorts; NULL is the smallest).

    A narrow pass finds the value at which the n-th row lies.  Rows above it are kept as
    they are; only rows equal to it are ordered, by ``ties`` (``name`` or ``name DESC``),
    dealt by range as well.  Nothing is sorted in one task, however large ``n`` is.
    """
    if n <= 0:
        return df.limit(0)
    last = f"array(least({int(n)}L, total) - 1)"
    counted = df.select(F.col(column).alias("v")).groupBy("v").agg(F.expr("count(1) AS n"))
    ranged = _in_ranges(counted, [F.col("v").desc()], "sequence-counts")
    # a single row: the value, and how many of its rows still belong to the result
    cut = spool(_located(ranged, [], "v DESC", last).selectExpr("v AS edge", "pos - before + 1 AS room"), "edge")
    edge, room = cut.select("edge").scalar(), cut.select("room").scalar()
    above = df.where((F.col(column) > edge) | (edge.isNull() & F.col(column).isNotNull()))
    terms = list(ties) or [column]
    level = df.where(F.col(column).eqNullSafe(edge)).select(
        F.struct("*").alias("row"), *[F.col(t.removesuffix(" DESC")).alias(f"o{i}") for i, t in enumerate(terms)])
    down = [t.endswith(" DESC") for t in terms]
    dealt = _in_ranges(level, [F.col(f"o{i}").desc() if d else F.col(f"o{i}").asc() for i, d in enumerate(down)],
                       "edge-rows")
    order = ", ".join(f"o{i} DESC" if d else f"o{i}" for i, d in enumerate(down))
    ahead = (dealt.groupBy("part").agg(F.expr("count(1) AS held"))
             .selectExpr("part AS t_part", "sum(held) OVER (ORDER BY part) - held AS ahead"))
    chosen = (dealt.join(ahead, F.expr("part = t_part")).where(F.col("ahead") < room)
              .selectExpr("row", f"ahead + row_number() OVER (PARTITION BY part ORDER BY {order}) AS place")
              .where(F.col("place") <= room))
    return above.unionByName(chosen.select("row.*"))
