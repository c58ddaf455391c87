"""Row ranges, sketches, SQL spelling, Arrow files."""

from __future__ import annotations

import glob
import random
import re

import pytest
from helpers import agg_row, aggs, optimized
from pyspark.sql import functions as F

from obsweave.functions.numeric import stddev_sql
from obsweave.operators import aggregate, rolling, sketches, sqltext
from obsweave.sinks import arrow_files


@pytest.mark.parametrize("n,ranges", [(1, 8), (3, 8), (40, 8), (5, 1), (3, 60)])
def test_rolling_over_row_ranges_equals_plain_window(spark, n, ranges):
    random.seed(n)
    rows = [agg_row(c, start=random.choice([i, i * 17]), temp=random.choice([None, i * 1.5, -i / 3]))
            for i in range(60) for c in ("A", "B", None)]
    df = aggs(spark, *rows).dropDuplicates(["city", "window_end"])
    plain = df.selectExpr("city", "window_end", f"avg(avg_temp) OVER (PARTITION BY city ORDER BY window_end "
                          f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS m")
    want = {(r.city, r.window_end): r.m for r in plain.collect()}
    out = rolling.rolling_mean(df, n, ranges=ranges).collect()
    got = {(r.city, r.window_end): r[f"rolling_avg_temp_{n}w"] for r in out}
    assert got.keys() == want.keys() and len(out) == len(want)
    for k, v in want.items():
        assert (got[k] is None and v is None) or got[k] == pytest.approx(v, abs=0.0051)
    order = [(r.city or "", r.window_end) for r in out]
    assert order == sorted(order)


def test_a_hot_key_fills_many_ranges_and_the_input_is_read_once(spark, folder):
    spark.range(20_000).selectExpr("IF(id % 50 = 0, 'cold', 'hot') AS city", "timestamp_seconds(id * 60) AS window_end",
                                   "CAST(id % 17 AS DOUBLE) AS avg_temp").write.parquet(folder + "/in")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.read.parquet(folder + "/in")
    out = rolling.rolling_mean(df.mapInArrow(count, df.schema), 5, ranges=16)
    sizes = [r.n for r in _ranges(spark, out).collect()]
    assert len(sizes) >= 14 and max(sizes) < 3 * 20_000 / 16
    assert out.count() == 20_000 and seen.value == 20_000


def _ranges(spark, out):
    """Rows of the hot key per stored range."""
    folder = max({f.rsplit("/", 1)[0] for f in out.inputFiles()}, key=lambda p: "rolling-ranges" in p)
    return spark.read.parquet(folder).where("city = 'hot'").groupBy("__chunk").agg(F.count("*").alias("n"))


def test_sketches_of_days_merge_within_the_error(spark):
    df = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('c', id % 5)) AS city", "timestamp_seconds(id * 41) AS window_start",
        "CAST((id * 7919 % 9973) / 10 AS DOUBLE) AS avg_temp").union(
        spark.sql("SELECT 'odd', timestamp_seconds(0), x FROM VALUES (double('NaN')), (NULL), (1D) AS t(x)"))
    stored = sketches.daily_sketches(df)
    assert stored.select("day").distinct().count() > 20
    found = sketches.merged_quantiles(stored)
    errors = sketches.rank_errors(found, df).collect()
    assert len(errors) == 5 * 7 and max(r.error for r in errors) <= 2 * sketches.RANK_ERROR
    assert {r.median for r in found.where("city = 'odd'").collect()} == {1.0}
    some = sketches.merged_quantiles(stored.where("day < '1970-01-08'"))
    assert max(r.error for r in sketches.rank_errors(some, df.where("window_start < '1970-01-08'")).collect()) <= 0.01


def test_sql_spelling_has_the_same_plan(spark, folder):
    path = folder + "/t"
    aggs(spark, agg_row("A", 0, temp=1.0), agg_row("A", 5, temp=2.005), agg_row("B", 0, temp=None)).write.parquet(path)
    text, frame = sqltext.mean_by_city_sql(spark, path), aggregate.mean_by_city(spark.read.parquet(path))
    plans = [re.sub(r"#\d+L?", "", optimized(d)) for d in (text, frame)]     # but for the numbers of expressions
    assert plans[0] == plans[1] and "Aggregate" in plans[0]
    assert text.collect() == frame.collect()
    spark.read.parquet(path).createOrReplaceTempView("stored_aggs")
    sql = sqltext.summary_sql("stored_aggs", spark.table("stored_aggs"), ["hour(window_end) AS h", "city"],
                              {"m": ("avg_humidity", 1)}, {"n": "count(1)"})
    assert {(r.city, r.m, r.n) for r in spark.sql(sql).collect()} == {("A", 58.0, 2), ("B", 58.0, 1)}


def test_arrow_files_hold_the_table(spark, folder):
    df = spark.range(0, 50_000, 1, 7).selectExpr("id", "repeat('x', 2000) AS filling", "IF(id % 3 = 0, NULL, id / 7) AS v",
                                                 "array(id, NULL) AS a")
    listed = arrow_files.export_arrow(df, folder + "/out", "id", files=6)
    assert 1 < len(listed) <= 6 and sum(x["rows"] for x in listed) == 50_000
    back = arrow_files.load_arrow(spark, folder + "/out")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.selectExpr("sum(id)", "count(v)", "sum(length(filling))", "sum(a[0])").collect() == df.selectExpr(
        "sum(id)", "count(v)", "sum(length(filling))", "sum(a[0])").collect()
    # a file that is not listed, as of a repeated task, is no part of the table
    name = glob.glob(folder + "/out/*.arrow")[0]
    with open(name, "rb") as f, open(name.replace(".arrow", "-again.arrow"), "wb") as g:
        g.write(f.read())
    assert arrow_files.load_arrow(spark, folder + "/out").count() == 50_000
    arrow_files.export_arrow(df.limit(0), folder + "/none", "id")
    assert arrow_files.load_arrow(spark, folder + "/none").count() == 0


def test_deviation_is_the_same_for_any_partitioning(spark):
    df = spark.range(30_000).selectExpr("id % 3 AS k", "(id * 7919 % 9973) / 7 - 500 AS v").union(
        spark.sql("SELECT 9, x FROM VALUES (double('NaN')), (1D), (2D) AS t(x)")).union(
        spark.sql("SELECT 8, 5D")).union(spark.sql("SELECT 7, x FROM VALUES (1.0e12D), (3.0e12D) AS t(x)")).union(
        spark.sql("SELECT 6, x FROM VALUES (20.123456789D), (20.123456789D), (NULL) AS t(x)"))
    got = [{r.k: r.s for r in df.repartition(n).groupBy("k").agg(F.expr(f"{stddev_sql('v')} AS s")).collect()} for n in (1, 4, 13)]
    want = {r.k: r.s for r in df.groupBy("k").agg(F.expr("stddev_samp(v) AS s")).collect()}
    for one in got:
        for k in (0, 1, 2):
            assert one[k] == got[0][k] == pytest.approx(want[k], rel=1e-9)
        assert one[9] != one[9] and one[8] is None and one[7] == pytest.approx(want[7]) and one[6] == 0.0
