from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bramble.functions import random_cols as RC
from bramble.operators import features as FE

N = 20_000


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(N).persist()


def _values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_uniform_in_unit_interval_and_depends_on_tag_and_seed(ids):
    a = _values(ids, RC.uniform("id", "x", 1))
    assert min(a) >= 0.0 and max(a) < 1.0
    assert abs(sum(a) / N - 0.5) < 0.01
    assert a != _values(ids, RC.uniform("id", "y", 1))
    assert a != _values(ids, RC.uniform("id", "x", 2))
    by_id = dict(ids.select("id", RC.uniform("id", "x", 1)).collect())
    again = dict(ids.repartition(7).select("id", RC.uniform("id", "x", 1)).collect())
    assert by_id == again  # a draw depends on the row id only, not on the partitioning


def test_rand_int_bounds_inclusive(ids):
    v = Counter(_values(ids, RC.rand_int(RC.uniform("id", "i", 0), 18, 20)))
    assert set(v) == {18, 19, 20}
    assert all(abs(c / N - 1 / 3) < 0.02 for c in v.values())


def test_rand_choice_uniform(ids):
    v = Counter(_values(ids, RC.rand_choice(RC.uniform("id", "c", 0), ["a", "b", "c", "d"])))
    assert set(v) == {"a", "b", "c", "d"} and all(abs(c / N - 0.25) < 0.02 for c in v.values())


def test_weighted_choice_shares(ids):
    v = Counter(_values(ids, RC.weighted_choice(RC.uniform("id", "w", 0), [1, 2, 3], [0.2, 0.3, 0.5])))
    for k, w in {1: 0.2, 2: 0.3, 3: 0.5}.items():
        assert abs(v[k] / N - w) < 0.02


def test_conditional_bernoulli(ids):
    df = ids.withColumn("g", (F.col("id") % 2).cast("int"))
    out = df.select("g", RC.conditional_bernoulli(RC.uniform("id", "b", 0), [(F.col("g") == 1, 0.9)], 0.1).alias("b"))
    rates = {r.g: r.p for r in out.groupBy("g").agg(F.avg("b").alias("p")).collect()}
    assert abs(rates[1] - 0.9) < 0.02 and abs(rates[0] - 0.1) < 0.02


def test_dependent_choice_respects_table(ids):
    df = ids.withColumn("parent", F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 3 == 1, "B").otherwise("C"))
    expr = RC.dependent_choice(F.col("parent"), RC.uniform("id", "d", 0), {"A": ["x"], "B": ["y", "z"]}, ["q"])
    pairs = {(r.parent, r.v) for r in df.select("parent", expr.alias("v")).distinct().collect()}
    assert pairs == {("A", "x"), ("B", "y"), ("B", "z"), ("C", "q")}


def test_fill_template_and_null_rate(ids):
    df = ids.select(RC.fill_template(F.lit("Love this {product}!"), product=F.lit("dress")).alias("t"))
    assert {r.t for r in df.distinct().collect()} == {"Love this dress!"}
    nulls = ids.select(RC.null_with_rate(F.col("id"), RC.uniform("id", "n", 0), 0.05).alias("v")).filter("v IS NULL").count()
    assert abs(nulls / N - 0.05) < 0.01


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None]), st.floats(0, 10, allow_nan=False)), min_size=1, max_size=40))
def test_hash_split_partition_of_rows(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, x double")
    train, test = FE.hash_split(df, (0.7, 0.3), seed=3)
    a, b = train.collect(), test.collect()
    assert len(a) + len(b) == len(rows)
    assert not {tuple(r) for r in a} & {tuple(r) for r in b}
    again, _ = FE.hash_split(df.repartition(3), (0.7, 0.3), seed=3)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, a), key=repr)
