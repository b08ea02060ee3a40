"""Ranges from quantile sketches against plain bisection."""

import bisect
import random

from pyspark.sql import functions as F

from busframes.operators import ranges as R


def test_range_numbers(spark):
    rng = random.Random(2)
    values = [rng.choice([5, 5, rng.randrange(-1000, 1000), 2**62]) for _ in range(2000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long").repartition(5)
    cuts = R.quantile_cuts(df, F.col("v"), 16)
    assert len(cuts) == 15 and cuts == sorted(cuts) and len(set(cuts)) < 15  # the hot value is cut more than once
    rows = df.select("v", R.range_number(F.col("v"), cuts).alias("r")).collect()
    assert all(r.r == bisect.bisect_right(cuts, r.v) for r in rows)
    tie = F.xxhash64("i")
    rows = df.select("v", tie.alias("t"), R.range_number(F.col("v"), cuts, tie).alias("r")).collect()
    ordered = sorted(rows, key=lambda r: (r.v, r.t))
    assert [r.r for r in ordered] == sorted(r.r for r in rows)
    most = max(sum(r.r == k for r in rows) for k in range(16))
    assert most < 2000 / 16 * 3


def test_edges(spark):
    one = spark.createDataFrame([(1,), (None,)], "v long")
    assert R.quantile_cuts(one.filter("v > 5"), F.col("v"), 4) == []
    assert [r[0] for r in one.select(R.range_number(F.col("v"), [])).collect()] == [0, 0]
    assert R.quantile_cuts(one, F.col("v"), 3) == [1, 1]
    many = spark.range(5000)
    cuts = R.quantile_cuts(many, F.col("id"), 1000)
    sizes = many.groupBy(R.range_number(F.col("id"), cuts)).count().collect()
    assert len(sizes) > 900 and max(r[1] for r in sizes) <= 12


def test_compiled_halving_is_cuts_below(spark):
    """the same range for every value, in compiled code."""
    from busframes.operators.ranges import cuts_below, with_cuts_below

    for cuts in ([], [3], [1, 1, 4, 9, 9, 9, 20], list(range(0, 60, 3))):
        df = spark.createDataFrame([(v, cuts) for v in [None, *range(-2, 64)]], "v bigint, cuts array<bigint>")
        got = with_cuts_below(df, "n", F.col("v"), F.col("cuts"), len(cuts)).withColumn("m", cuts_below(F.col("v"), F.col("cuts"), max(len(cuts), 1)))
        assert all(r.n == r.m == sum(c <= r.v for c in cuts if r.v is not None) for r in got.collect())
        assert "lambda" not in with_cuts_below(df, "n", F.col("v"), F.col("cuts"), len(cuts))._jdf.queryExecution().executedPlan().toString()
