"""Binned density, one-pass counts of the EDA bundle, sketched medians."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bramble.operators import missing as N
from bramble.operators import stats as A


def exact_density(v, grid):
    bw = v.std(ddof=1) * len(v) ** -0.2
    return np.exp(-0.5 * ((grid[:, None] - v[None]) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi)), bw


@pytest.mark.parametrize("resolution", [4, 50])
def test_density_stays_within_its_error(spark, resolution):
    """Continuous columns of different shapes: never further from the sum of all kernels than stated."""
    rng = np.random.default_rng(resolution)
    for v in (rng.normal(size=700), rng.exponential(size=500) * 1000, np.concatenate([rng.normal(size=200), [50.0, -50.0]])):
        df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double")
        rows = A.kde(df, "v", resolution=resolution).orderBy("point").collect()
        want, bw = exact_density(v, np.array([r.x for r in rows]))
        gap = np.abs(np.array([r.density for r in rows]) - want).max()
        assert gap <= A.kde_error(resolution, bw) and len(rows) == 200
        assert gap > 0 or resolution == 50


def test_density_of_counted_rows(spark):
    v = [1.0, 1.0, 1.0, 2.0, 5.0, 5.0, 9.5]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    counted = df.groupBy("v").agg(F.count("*").alias("n"))
    for resolution in (None, 50):
        a = [r.density for r in A.kde(df, "v", resolution=resolution).orderBy("point").collect()]
        b = [r.density for r in A.kde(counted, "v", resolution=resolution, weight="n").orderBy("point").collect()]
        assert a == pytest.approx(b)
    assert sorted(A.histogram(df, "v", 4).collect()) == sorted(A.histogram(counted, "v", 4, weight="n").collect())
    assert {r.density for r in A.kde(df.filter("v = 1"), "v").collect()} == {None}
    assert A.kde(df.limit(0), "v").filter("density is not null").count() == 0


def test_counted_sets(spark):
    rows = [("a", 1, None), ("a", 1, "x"), (None, 2, "x"), (None, None, None), ("a", 2, "x")]
    df = spark.createDataFrame(rows, "g string, v int, c string")
    got = sorted(map(tuple, A.counted_sets(df, [["g", "v"], ["v"], ["c"]]).collect()), key=repr)
    want = [(0, "a", 1, None, 2), (0, None, 2, None, 1), (0, None, None, None, 1), (0, "a", 2, None, 1), (1, None, 1, None, 2), (1, None, 2, None, 2), (1, None, None, None, 1), (2, None, None, "x", 3), (2, None, None, None, 2)]
    assert got == sorted(want, key=repr)


def test_sketched_medians_and_their_ranks(spark):
    df = spark.range(0, 20001).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("b"), F.lit(None).cast("int").alias("c"))
    got = {r.column: r for r in N.approx_medians(df, ["a", "b", "c"], rel_err=0.01).collect()}
    assert got["a"].n == 20001 and got["a"].rank_error <= 0.01 and abs(got["a"].median - 10000) <= 200
    assert got["b"].n == 6667 and got["b"].rank_lo <= 0.51 and got["b"].rank_hi >= 0.49
    assert got["c"].n == 0 and got["c"].median is None
