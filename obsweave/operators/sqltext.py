"""SQL text with a ``{src}`` placeholder, over a DataFrame or a Parquet path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.numeric import Means, round_sql


def sql_over(spark: SparkSession, text: str, src: DataFrame | str, args: dict | None = None) -> DataFrame:
    """Run ``text`` with ``{src}`` bound to the source; values go in as ``:name`` parameters."""
    frame = spark.read.parquet(src) if isinstance(src, str) else src
    return spark.sql(text, args=args or {}, src=frame)


def summary_sql(source: str, columns: DataFrame, by: Sequence[str], means: Mapping[str, tuple[str, int | None]],
                others: Mapping[str, str] | None = None) -> str:
    """SQL text of :func:`~obsweave.functions.numeric.summarize` over ``source``, a table name or a path.

    ``columns`` tells the types only.  Text and DataFrame form give the same optimized plan.
    """
    source = f"parquet.`{source}`" if "/" in source else source
    m = Means(columns, [c for c, _ in means.values()])
    others = dict(others or {})
    prepared = ", ".join(["*", *[f"{sql} AS {name}" for name, sql in m.prepared().items()]])
    pieces = ", ".join([*by, *[f"{sql} AS {name}" for name, sql in {**others, **m.pieces()}.items()]])
    keep = [b.rsplit(" AS ", 1)[-1] for b in by] + list(others)
    valued = ", ".join([*keep, *[f"{m.value(c)} AS {out}" for out, (c, _) in means.items()]])
    rounded = ", ".join([*keep, *[out if places is None else f"{round_sql(out, places)} AS {out}"
                                  for out, (_, places) in means.items()]])
    group = f" GROUP BY {', '.join(b.rsplit(' AS ', 1)[0] for b in by)}" if by else ""
    return (f"SELECT {rounded} FROM (SELECT {valued} FROM (SELECT {pieces} FROM (SELECT {prepared} FROM {source}){group}))")


def mean_by_city_sql(spark: SparkSession, path: str) -> DataFrame:
    """The mean temperature per city by SQL text over a stored table."""
    text = summary_sql(path, spark.read.parquet(path), ["city"], {"mean_temp": ("avg_temp", 2)})
    return spark.sql(f"{text} ORDER BY mean_temp DESC, city")
