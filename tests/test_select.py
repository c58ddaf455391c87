"""Row limits."""

from __future__ import annotations


def test_sample_of_rows_that_share_an_id_is_fixed(spark):
    from obsweave.operators import select

    df = spark.range(3000).selectExpr("IF(id % 3 = 0, NULL, 7L) AS k", "id AS v", "map('a', id) AS m")
    for n in (500, 1500, 2500, 3000, 9000):
        a, b = ({r.v for r in select.sample_n(d.repartition(p, "v"), n, "k").collect()} for d, p in ((df, 3), (df.orderBy(df.v.desc()), 13)))
        assert len(a) == min(n, 3000) and a == b
