import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from bramble.operators import stats as A
from bramble.operators.ranks import count_percentiles


def test_histogram_matches_numpy_auto_and_fixed(spark):
    rng = np.random.default_rng(7)
    xs = [float(v) for v in rng.integers(18, 71, size=3000)]
    df = spark.createDataFrame([(x,) for x in xs], "age double")
    for bins in ("auto", 10, 7):
        h = sorted(A.histogram(df, "age", bins).collect(), key=lambda r: r.bin)
        counts, edges = np.histogram(np.array(xs), bins=bins)
        assert [r["count"] for r in h] == counts.tolist()
        assert [r.bin_lo for r in h] == pytest.approx(edges[:-1].tolist())


def test_histogram_integral_and_constant_columns(spark):
    xs = [3, 3, 4, 9, 9, 9, 12, 15, 15, 20] * 5
    df = spark.createDataFrame([(x,) for x in xs], "v int")
    h = sorted(A.histogram(df, "v", "auto").collect(), key=lambda r: r.bin)
    counts, _ = np.histogram(np.array(xs), bins="auto")
    assert [r["count"] for r in h] == counts.tolist()
    const = spark.createDataFrame([(5.0,)] * 4, "v double")
    h = A.histogram(const, "v", "auto").collect()
    assert [(r.bin_lo, r.bin_hi, r["count"]) for r in h] == [(4.5, 5.5, 4)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=2, max_size=60))
def test_histogram_counts_sum_to_n(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v int")
    assert sum(r["count"] for r in A.histogram(df, "v", 5).collect()) == len(xs)


def test_kde_matches_direct_sum_and_integrates(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 7.0, 7.5, 8.0]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    out = sorted(A.kde(df, "v", grid=50, cut=3, resolution=None).collect(), key=lambda r: r.point)
    a = np.array(xs)
    bw = a.std(ddof=1) * len(a) ** (-0.2)
    grid = np.linspace(a.min() - 3 * bw, a.max() + 3 * bw, 50)
    dens = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / bw) ** 2).sum(1) / (len(a) * bw * math.sqrt(2 * math.pi))
    assert [r.x for r in out] == pytest.approx(grid.tolist())
    assert [r.density for r in out] == pytest.approx(dens.tolist())
    assert np.trapezoid(dens, grid) == pytest.approx(1.0, abs=0.02)


def test_box_stats_match_numpy_rule(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(v)) for v in rng.integers(0, 30, 200)] + [("a", 100.0), ("b", 1.0), ("b", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, y double")
    got = {r.g: r for r in A.box_stats(df, "g", "y").collect()}
    for g in ("a", "b"):
        y = np.array([v for k, v in rows if k == g])
        q1, med, q3 = np.percentile(y, [25, 50, 75])
        iqr = q3 - q1
        lo = y[y >= q1 - 1.5 * iqr].min()
        hi = y[y <= q3 + 1.5 * iqr].max()
        r = got[g]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert r.whisker_lo == pytest.approx(min(lo, q1)) and r.whisker_hi == pytest.approx(max(hi, q3))
        assert r.n_outliers == int(((y < q1 - 1.5 * iqr) | (y > q3 + 1.5 * iqr)).sum())
        assert r.n == len(y)


def test_crosstab_fills_zero_and_sums_to_rows(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (None, 1), (3, None)], "r int, c int")
    ct = {r.r: (r["0"], r["1"]) for r in A.crosstab(df, "r", "c", [0, 1]).collect()}
    assert ct == {1: (2, 0), 2: (0, 1)}


def test_pivot_counts_leaves_absent_pairs_null(spark):
    df = spark.createDataFrame([("x", "A"), ("y", "B")], "r string, c string")
    out = {r.r: (r.A, r.B) for r in A.pivot_counts(df, "r", "c", ["A", "B"]).collect()}
    assert out == {"x": (1, None), "y": (None, 1)}


def test_summarize_matches_pandas_describe(spark):
    import pandas as pd

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.integers(0, 100, 500).astype(float), "b": rng.normal(size=500)})
    df = spark.createDataFrame(pdf)
    got = {r.column: r for r in A.summarize(df, ["a", "b"]).collect()}
    ref = pdf.describe()
    for c in ("a", "b"):
        r = got[c]
        want = ref[c]
        assert [r["count"], r.mean, r.std, r.min, r.p25, r.p50, r.p75, r.max] == pytest.approx(
            [want["count"], want["mean"], want["std"], want["min"], want["25%"], want["50%"], want["75%"], want["max"]]
        )


def test_describe_all_types(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (None, None)], "n int, s string")
    got = {r.column: r for r in A.describe_all(df).collect()}
    assert (got["n"]["count"], got["n"].mean, got["n"]["min"], got["n"]["max"]) == (2, 2.0, "1", "3")
    assert (got["s"]["count"], got["s"].mean, got["s"]["min"]) == (2, None, "a")


def test_value_counts_orders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "v string")
    assert [r.v for r in A.value_counts(df, "v").collect()] == ["a", "b", "c"]
    assert [r.v for r in A.value_counts(df, "v", order="value").collect()] == ["a", "b", "c"]
    assert sum(r["count"] for r in A.value_counts(df, "v").collect()) == 5


def test_shape_and_preview(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "v int")
    assert A.shape(df).collect()[0].asDict() == {"n_rows": 3, "n_cols": 1}
    assert [r.v for r in A.preview(df, 2).collect()] == [1, 2]


def test_value_counts_many_equals_single_column_counts(spark):
    df = spark.createDataFrame(
        [(1, "a"), (2, "b"), (1, None), (3, "a"), (None, "a")], "r int, s string"
    )
    long = A.value_counts_many(df, ["r", "s"])
    for c in ("r", "s"):
        one = sorted(map(tuple, A.value_counts(df, c).collect()), key=repr)
        many = sorted(map(tuple, A.split_value_counts(long, df, c).collect()), key=repr)
        assert one == many
    assert dict(A.split_value_counts(long, df, "r").dtypes)["r"] == "int"


def test_exact_percentiles_of_a_continuous_column(spark):
    """A million distinct values, one group with half of all rows, against NumPy."""
    df = spark.range(1_000_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        (F.xxhash64("id") / F.lit(2.0**40)).alias("v"),
    )
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r["g"]: r["q"] for r in count_percentiles(counts, "v", "n", probs, ["g"]).collect()}
    pdf = df.toPandas()
    assert set(got) == set(pdf["g"])
    for g, own in pdf.groupby("g"):
        assert np.allclose(got[g], np.quantile(own["v"], probs), rtol=1e-12)
    whole = count_percentiles(counts, "v", "n", probs).first()["q"]
    assert np.allclose(whole, np.quantile(pdf["v"], probs), rtol=1e-12)


def test_exact_percentiles_weights_ties_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("b", 5.0, 1)], "g string, v double, n bigint")
    got = {r["g"]: r["q"] for r in count_percentiles(df, "v", "n", (0.5, 0.75), ["g"]).collect()}
    assert got == {"a": [1.0, 1.25], "b": [5.0, 5.0]}
    assert count_percentiles(df.limit(0), "v", "n", (0.5,), ["g"]).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "x double, y int")
    rows = {r["column"]: r["p50"] for r in A.summarize(nulls, ["x", "y"]).collect()}
    assert rows == {"x": None, "y": 1.5}


def test_kde_resolution_is_close_to_every_value(spark):
    df = spark.range(20_000).select((F.xxhash64("id") / F.lit(2.0**60)).alias("v"))
    a, b = (np.array([r["density"] for r in A.kde(df, "v", resolution=n).orderBy("point").collect()]) for n in (100, None))
    assert np.allclose(a, b, rtol=1e-3, atol=1e-6 * b.max())


def test_histogram_of_a_far_outlier_keeps_its_bins_as_rows(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("v")).union(spark.range(1).select(F.lit(1e8)))
    out = A.histogram(df, "v", "auto")
    assert out.agg(F.sum("count")).first()[0] == 2001
