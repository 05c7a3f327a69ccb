"""Least squares, k-means and forests: against numpy, and the same under any layout."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bramble.operators import features as FE
from bramble.operators import forest as FO
from bramble.operators import kmeans as KM
from bramble.operators import linear as LN
from bramble.operators import metrics as M
from bramble.operators import models as MO


def sample(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        c = "abcd"[int(rng.integers(0, 4))]
        e = {"a": "x", "b": "x"}.get(c, c)  # determined by c: collinear one-hot columns
        p, q = int(rng.integers(0, 40)), int(rng.integers(0, 5))
        rows.append((float(p), q, c, e, 2.0 * p - q + (3.0 if c == "a" else 0.0) + float(rng.normal()), int(q + (c == "b") + rng.normal() > 2)))
    return spark.createDataFrame(rows, "p double, q int, c string, e string, y double, label int")


def test_least_norm_solution(spark):
    """Equal to numpy's pseudo-inverse on the centred columns, rank and predictions included."""
    df = sample(spark)
    res = MO.fit_regression(df, df, ["p", "q"], ["c", "e"], label="y")
    rows = res.predictions.select(vector_to_array("features").alias("x"), "y", "prediction").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    centred = x - x.mean(0)
    want = np.linalg.pinv(centred, rcond=1e-10) @ (y - y.mean())
    coefs = {r.slot: r.coefficient for r in res.coefficients.collect()}
    assert [coefs[i] for i in range(len(want))] == pytest.approx(want.tolist(), abs=1e-8)
    assert res.intercept == pytest.approx(y.mean() - x.mean(0) @ want)
    assert [r.prediction for r in rows] == pytest.approx((x @ want + res.intercept).tolist(), abs=1e-8)
    assert res.model.rank == np.linalg.matrix_rank(centred)


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_solve_ranks_and_scales(scale):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4)) * np.array([scale, 1, 10, 1])
    x = np.column_stack([x, x[:, 1] + x[:, 2], np.full(50, 7.0), np.zeros(50)])
    y = x @ np.array([1 / scale, 2, 3, 4, 0, 0, 0]) + 5
    z = np.column_stack([np.ones(50), x, y])
    beta, icpt, rank = LN.solve(z.T @ z)
    assert rank == 4 and x @ beta + icpt == pytest.approx(y, abs=1e-6)
    assert beta[4] == pytest.approx((beta[1] + beta[2]) / 1.0, abs=1e-5) and beta[5] == beta[6] == 0  # least norm: beta is orthogonal to (1, 1, -1)


def test_regression_without_rows(spark):
    df = sample(spark, 10)
    with pytest.raises(ValueError):
        MO.fit_regression(df.limit(0), df, ["p"], [], label="y")


def forest_of(df, parts, compress, **more):
    res = MO.fit_classifier(df.repartition(parts), df, ["p", "q"], ["c", "e"], label="label", compress=compress, **more)
    return [(t.splits, t.counts) for t in res.model.trees], res


def test_forest_does_not_depend_on_layout_or_grouping(spark):
    """The same trees from 1, 3 and 8 partitions, from rows and from counted rows."""
    df = sample(spark)
    df = df.unionByName(df.limit(150))
    want, res = forest_of(df, 1, True, num_trees=4, max_depth=4)
    assert any(s for s, _ in want) and sum(len(s) for s, _ in want) > 8
    for parts, compress in ((3, True), (8, False)):
        assert forest_of(df, parts, compress, num_trees=4, max_depth=4)[0] == want
    assert forest_of(df, 1, True, num_trees=4, max_depth=4, seed=7)[0] != want
    got = {r.feature: r.importance for r in res.importances.collect()}
    by_hand = np.zeros(len(res.model.names))
    for tree in res.model.trees:
        own = np.zeros(len(by_hand))
        for slot, _, gain, n in tree.splits.values():
            own[slot] += gain * n
        by_hand += own / own.sum()
    assert [got[n] for n in res.model.names] == pytest.approx((by_hand / len(res.model.trees)).tolist())


def test_forest_splits_are_the_best(spark):
    """One tree without draws: every split has the largest gain of all features and cuts."""
    df = sample(spark, 200)
    res = MO.fit_classifier(df, df, ["p", "q"], ["c"], label="label", num_trees=1, bootstrap=False, max_depth=3)
    rows = res.predictions.select(vector_to_array("features").alias("x"), "label", vector_to_array("probability").alias("p"), "prediction").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows])
    tree = res.model.trees[0]
    gini = lambda v: 1 - sum((np.mean(v == c)) ** 2 for c in (0, 1))
    at = {1: np.arange(len(y))}
    for node in sorted(tree.splits):
        mine, (slot, cut, gain, n) = at[node], tree.splits[node]
        assert n == len(mine)
        gains = []
        for s in range(x.shape[1]):
            vs = np.unique(x[:, s])
            for c in ((vs[1:] + vs[:-1]) / 2 if len(vs) <= 32 else []):
                left = x[mine, s] <= c
                if left.any() and not left.all():
                    gains.append(gini(y[mine]) - left.mean() * gini(y[mine][left]) - (~left).mean() * gini(y[mine][~left]))
        left = x[mine, slot] <= cut
        own = gini(y[mine]) - left.mean() * gini(y[mine][left]) - (~left).mean() * gini(y[mine][~left])
        assert own == pytest.approx(gain, abs=1e-9) and (slot == 0 or gain >= max(gains) - 1e-9)
        at[2 * node], at[2 * node + 1] = mine[left], mine[~left]
    for r, p in zip(rows, tree.route(x)):
        assert r.p == pytest.approx([c / sum(tree.counts[p]) for c in tree.counts[p]]) and r.prediction == float(np.argmax(tree.counts[p]))


def test_forest_of_one_class_and_of_nothing(spark):
    df = sample(spark, 30).withColumn("label", F.lit(0))
    res = MO.fit_classifier(df, df, ["p"], ["c"], label="label", num_trees=2)
    assert {r.prediction for r in res.predictions.collect()} == {0.0} and res.splits.count() == 0
    with pytest.raises(ValueError):
        MO.fit_classifier(df.limit(0), df, ["p"], [], label="label")


def test_looked_at_is_fixed():
    assert FO.looked_at(42, 0, 1, 9, 3) == FO.looked_at(42, 0, 1, 9, 3) and len(FO.looked_at(1, 2, 3, 9, 9)) == 9


def test_sweep_against_numpy_and_layouts(spark):
    """The shared passes give each k what Lloyd's steps from the same start give alone, under any layout and grouping."""
    df = sample(spark)
    df = df.unionByName(df.limit(100))
    fits = [MO.kmeans_sweep(d, ["p", "q"], ["c"], ks=(2, 3, 5), compress=c) for d, c in ((df, True), (df.repartition(7), True), (df.repartition(3), False))]
    for other in fits[1:]:
        assert all(np.array_equal(fits[0].centres[k], other.centres[k]) for k in (2, 3, 5))
        assert [(r.k, r.sizes) for r in fits[0].table.collect()] == [(r.k, r.sizes) for r in other.table.collect()]
    x = np.array([r.x for r in fits[0].prepared.select(vector_to_array("features").alias("x")).collect()])
    for r in fits[0].table.collect():
        c = fits[0].centres[r.k]
        far = ((x[:, None] - c[None]) ** 2).sum(2)
        own = far.argmin(1)
        assert r.wssse == pytest.approx(far.min(1).sum()) and r.sizes == np.bincount(own, minlength=r.k).tolist()
        for i in range(r.k):  # converged: every centre is the mean of its points
            assert c[i] == pytest.approx(x[own == i].mean(0), abs=1e-3)


def test_sweep_of_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "p double")
    fit = MO.kmeans_sweep(df, ["p"], [], ks=(2, 4))
    assert [(r.k, sorted(r.sizes)) for r in fit.table.collect()] == [(2, [1, 2]), (4, [0, 0, 1, 2])]
    assert {r.wssse for r in fit.table.collect()} == {0.0}


def test_elbow_curves_and_ties(spark):
    rows = [("one", 2, 100.0), ("one", 3, 40.0), ("one", 4, 36.0), ("one", 5, 30.0), ("short", 2, 5.0), ("short", 3, 1.0), ("flat", 1, 8.0), ("flat", 2, 8.0), ("flat", 3, 8.0), ("flat", 4, 8.0)]
    got = {r.curve: r.k for r in KM.elbow(spark.createDataFrame(rows, "curve string, k int, wssse double"), ["curve"]).collect()}
    assert got == {"one": 3, "short": 3, "flat": 2}


def test_metrics_from_counts(spark):
    df = spark.createDataFrame([(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 4 + [(1, 0.0)], "y int, p double")
    pairs = M.pair_counts(df, "y", "p")
    assert M.classification_metrics(pairs, "y", "p", "n_rows").collect() == M.classification_metrics(df, "y", "p").collect()
    for labels in (None, [0.0], [0.0, 1.0]):
        assert sorted(map(tuple, M.confusion_matrix(pairs, "y", "p", labels, "n_rows").collect())) == sorted(map(tuple, M.confusion_matrix(df, "y", "p", labels).collect()))


def test_prediction_columns_keep_the_others(spark):
    df = sample(spark, 20)
    prep = FE.fit_weighted_preparation(df.withColumn("weight", F.lit(1.0)), ["p"], ["c"])
    out = prep.transform(df).withColumn("prediction", KM.nearest(np.zeros((1, 5))))
    assert out.count() == 20 and {r.prediction for r in out.collect()} == {0} and set(df.columns) <= set(out.columns)


def test_forest_metrics_score_the_test_rows_once(spark):
    rows = [(float(i % 7), ["a", "b", None][i % 3], i % 2 if i % 5 else 1) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, g string, y int")
    train, test = df.filter("x < 6"), df.filter("x > 2").unionByName(df.limit(3))
    res = MO.fit_classifier(train, test, ["x"], ["g"], "y", num_trees=3, max_depth=2)
    plan = res.metrics._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # not once for the actual and once for the predicted labels
    got = res.predictions.select("y", "prediction").collect()
    per = [(sum(r.y == k == r.prediction for r in got), sum(r.y == k for r in got), sum(r.prediction == k for r in got)) for k in (0, 1)]
    f1 = sum((2 * tp / (n + m) if tp else 0.0) * n for tp, n, m in per) / len(got)
    m = res.metrics.collect()
    assert len(m) == 1 and m[0].n == len(got)
    assert m[0].accuracy == pytest.approx(sum(t[0] for t in per) / len(got)) and m[0].f1 == pytest.approx(f1)
