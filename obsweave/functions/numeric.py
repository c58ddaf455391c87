"""Rounding and means whose result does not depend on how rows are partitioned.

``avg(double)`` adds in arrival order, so its last bit changes with the partitioning, and
a mean of two-decimal numbers often sits exactly on a rounding boundary.  Both are dealt
with here: sums are taken over integers, and rounding is half away from zero.

The ``*_sql`` functions return SQL expression text; ``x`` is a column name or any SQL
expression.  The others return the same as a Column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 9           # decimals kept by the integer sums, unless the caller wants others
_LIMB = 22           # a value is summed as three bigints of 22, 22 and 20 bits: safe for 2e12 rows a group
_LARGE = "1.0e18D"   # below it, what does not fit the integer sums is summed as decimals
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def round_sql(x: str, digits: int = 2) -> str:
    """Half away from zero; NULL, NaN, infinity and doubles too large for a fraction pass through."""
    p = f"{10 ** digits}D"
    return (f"(CASE WHEN abs({x}) < {1e15 / 10 ** digits!r}D"
            f" THEN (CASE WHEN ({x}) < 0 THEN ceil(({x}) * {p} - 0.5D) ELSE floor(({x}) * {p} + 0.5D) END) / {p}"
            f" ELSE CAST({x} AS DOUBLE) END)")


def round_half_away(x: str, digits: int = 2) -> Column:
    return F.expr(round_sql(x, digits))


def clip_sql(x: str, low: float | None = None, high: float | None = None) -> str:
    """Bound on one or both sides.  NULL stays NULL (``greatest`` would skip it), NaN stays NaN."""
    y = x if low is None else f"greatest({x}, {float(low)!r}D)"
    y = y if high is None else f"least({y}, {float(high)!r}D)"
    return f"(CASE WHEN ({x}) IS NULL OR isnan({x}) THEN {x} ELSE {y} END)"


def clip(x: str, low: float | None = None, high: float | None = None) -> Column:
    return F.expr(clip_sql(x, low, high))


def fixed_point_sql(x: str, digits: int = DIGITS) -> str:
    """The value as a bigint count of 10^-digits; NULL where it does not fit (NaN, huge)."""
    p = f"{10 ** digits}D"
    return (f"(CASE WHEN abs({x}) < {9.0e18 / 10 ** digits!r}D THEN"
            f" CASE WHEN ({x}) < 0 THEN -floor(-({x}) * {p} + 0.5D) ELSE floor(({x}) * {p} + 0.5D) END END)")


def _mean_sql(name: str, digits: int) -> str:
    """Mean from summed pieces."""
    def limb(part: str) -> str:
        return f"CAST({name}__{part} AS DECIMAL(20,0))"

    whole = (f"CAST(({limb('high')} * {1 << _LIMB} + {limb('mid')}) * {1 << _LIMB} + {limb('low')} AS DOUBLE)"
             f" / {10 ** digits}D")
    return (f"(coalesce({whole}, 0D) + coalesce(CAST({name}__large AS DOUBLE), 0D) + coalesce({name}__odd, 0D))"
            f" / nullif({name}__present, 0)")


def stddev_sql(x: str) -> str:
    """Sample standard deviation as an aggregate that does not depend on the order of rows.

    Values below 1e4 are rounded to nine decimals, and they and their squares are added as whole numbers (exact for
    1e12 rows); a group with larger ones, infinities or NaN is added as doubles.  NULL for fewer than two values.
    """
    v = f"(CASE WHEN abs({x}) < 1.0e4D THEN CAST({fixed_point_sql(x)} AS DECIMAL(14, 0)) END)"
    n = f"count({x})"
    total, squares = f"CAST(sum({v}) AS DECIMAL(26, 0))", f"CAST(sum({v} * {v}) AS DECIMAL(38, 0))"
    near = f"CAST({total} div nullif({n}, 0) AS DECIMAL(14, 0))"        # the mean but for a fraction
    count = f"CAST({n} AS DECIMAL(13, 0))"
    rest = f"CAST({total} - {count} * {near} AS DOUBLE)"
    around = f"CAST({squares} - CAST({near} * (2 * {total} - {count} * {near}) AS DECIMAL(38, 0)) AS DOUBLE)"
    return (f"(CASE WHEN {n} = count({v}) THEN sqrt(({around} - {rest} * {rest} / nullif({n}, 0)) / nullif({n} - 1, 0)) / 1.0e9D"
            f" ELSE stddev_samp({x}) END)")


class Means:
    """Exact means of some columns: what to add before, in and after an aggregate.

    Doubles are rounded to ``digits`` decimals and added as integers; those too large for
    that (9e9 and more at 9 decimals) as decimals of six places.  Neither depends on the
    order of rows.  Only values of 1e18 and more, infinities and NaN are added as doubles.

    Each step is its own projection over named columns, so that no expression is repeated.
    """

    def __init__(self, df: DataFrame, columns: Iterable[str], digits: int = DIGITS) -> None:
        self.digits = digits
        types = dict(df.dtypes)
        self.columns = list(dict.fromkeys(columns))
        # whole numbers are added as they are
        self.whole = {c for c in self.columns if types[c] in _INTEGRAL}
        self.wide = {c for c in self.whole if types[c] == "bigint"}

    def prepared(self) -> dict[str, str]:
        """Columns to add before the aggregate."""
        return {f"{c}__v": fixed_point_sql(c, self.digits) for c in self.columns if c not in self.whole}

    def prepare(self, df: DataFrame) -> DataFrame:
        return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in self.prepared().items()])

    def pieces(self) -> dict[str, str]:
        """Aggregates over prepared rows, all with fixed-width buffers."""
        out = {}
        for c in self.columns:
            out[f"{c}__present"] = f"count({c})"
            if c in self.whole:
                # up to 32 bits a bigint holds the sum; beyond, a decimal
                out[f"{c}__sum"] = f"sum({f'CAST({c} AS DECIMAL(20,0))' if c in self.wide else c})"
            else:
                mask = f"{(1 << _LIMB) - 1}L"
                out[f"{c}__high"] = f"sum(shiftright({c}__v, {2 * _LIMB}))"
                out[f"{c}__mid"] = f"sum(shiftright({c}__v, {_LIMB}) & {mask})"
                out[f"{c}__low"] = f"sum({c}__v & {mask})"
                out[f"{c}__large"] = (f"sum(CASE WHEN {c}__v IS NULL AND abs({c}) < {_LARGE}"
                                      f" THEN CAST({c} AS DECIMAL(38,6)) END)")
                out[f"{c}__odd"] = (f"sum(CASE WHEN {c}__v IS NULL AND NOT abs({c}) < {_LARGE}"
                                    f" THEN CAST({c} AS DOUBLE) END)")
        return out

    def value(self, column: str) -> str:
        """The mean from the pieces."""
        if column in self.whole:
            return f"CAST({column}__sum AS DOUBLE) / nullif({column}__present, 0)"
        return _mean_sql(column, self.digits)


def summarize(df: DataFrame, by: Sequence[str], means: Mapping[str, tuple[str, int | None]],
              others: Mapping[str, str] | None = None, digits: int = DIGITS) -> DataFrame:
    """Group and compute exact means (output name -> column, decimals or None) and other aggregates.

    ``by`` holds column names or ``expression AS name``; without it there is one row.
    """
    others = others or {}
    m = Means(df, [c for c, _ in means.values()], digits)
    grouped = m.prepare(df).groupBy(*[F.expr(b) for b in by]).agg(
        *[F.expr(f"{sql} AS {name}") for name, sql in {**others, **m.pieces()}.items()])
    keep = [b.rsplit(" AS ", 1)[-1] for b in by] + list(others)
    valued = grouped.selectExpr(*keep, *[f"{m.value(c)} AS {out}" for out, (c, _) in means.items()])
    return valued.selectExpr(*keep, *[out if places is None else f"{round_sql(out, places)} AS {out}"
                                      for out, (_, places) in means.items()])


def rolling_avg(df: DataFrame, column: str, frame: str, out: str) -> DataFrame:
    """Add the exact mean of ``column`` over a window frame (``OVER (...)``)."""
    m = Means(df, [column])
    over = m.prepare(df).selectExpr("*", *[f"{sql} {frame} AS {name}" for name, sql in m.pieces().items()])
    return over.selectExpr(*df.columns, f"{m.value(column)} AS {out}")
