import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from bramble.operators import features as FE
from bramble.operators import metrics as M
from bramble.operators import models as MO
from bramble.plans import recipes as E
from bramble.sources.reviews_raw import reviews_raw


@pytest.fixture(scope="module")
def prepared(spark, sf_small):
    return E.prepare(reviews_raw(spark, sf_small), median_method="exact").data


def test_hash_split_disjoint_covering_and_layout_free(spark, prepared):
    ml = prepared.select(*E.ML_COLS)
    train, test = FE.hash_split(ml, (0.8, 0.2), seed=42)
    tr = sorted(map(tuple, train.collect()), key=repr)
    te = sorted(map(tuple, test.collect()), key=repr)
    assert len(tr) + len(te) == ml.count()
    assert not set(tr) & set(te)
    assert 0.75 < len(tr) / (len(tr) + len(te)) < 0.85
    train8, _ = FE.hash_split(ml.repartition(8), (0.8, 0.2), seed=42)
    train1, _ = FE.hash_split(ml.coalesce(1), (0.8, 0.2), seed=42)
    assert sorted(map(tuple, train8.collect()), key=repr) == tr == sorted(map(tuple, train1.collect()), key=repr)


def test_string_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("b",)], "s string")
    m = FE.index_strings(["s"]).fit(df)
    assert list(m.labelsArray[0]) == ["b", "c", "a"]


def test_regression_metrics_equal_evaluator(spark):
    rows = [(float(y), float(y) + d) for y, d in zip(range(1, 40), [0.5, -1.0, 0.25, 2.0, -0.75] * 8)]
    df = spark.createDataFrame(rows, "rating double, prediction double")
    got = M.regression_metrics(df).collect()[0]
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="rating", predictionCol="prediction", metricName=name).evaluate(df)
        assert got[name] == pytest.approx(want)


def test_classification_metrics_equal_evaluator(spark):
    rows = [(1.0, 1.0)] * 30 + [(1.0, 0.0)] * 7 + [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 9 + [(2.0, 1.0)] * 2
    df = spark.createDataFrame(rows, "y double, prediction double")
    got = M.classification_metrics(df, "y", "prediction").collect()[0]
    for name in ("accuracy", "f1"):
        want = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName=name).evaluate(df)
        assert got[name] == pytest.approx(want)


def test_confusion_matrix_over_all_rows(spark):
    rows = [(1, 1.0)] * 3 + [(0, 1.0)] * 2 + [(1, 0.0)]
    df = spark.createDataFrame(rows, "y int, prediction double")
    cm = {r.y: (r.pred_0, r.pred_1) for r in M.confusion_matrix(df, "y", "prediction").collect()}
    assert cm == {1: (1, 3), 0: (0, 2)}


def test_regression_recipe(spark, prepared):
    r = E.run_regression(prepared)
    m = r["metrics"].collect()[0]
    assert m.rmse > 0 and m.mae > 0 and m.r2 <= 1.0
    names = [x.feature for x in r["coefficients"].collect()]
    assert "age" in names and "intercept" in names and any(n.startswith("division_name_vec_") for n in names)
    assert r["sample"].count() == 10


def test_segmentation_recipe(spark, prepared):
    r = E.run_segmentation(prepared, ks=(2, 3), k=3)
    sweep = r["sweep"].collect()
    n = prepared.count()
    assert [row.k for row in sweep] == [2, 3]
    assert all(sum(row.sizes) == n for row in sweep)
    prof = r["profile"].collect()
    assert sum(p.size for p in prof) == n
    piv = r["division_by_cluster"].collect()
    assert sum(sum(row[str(i)] for i in range(3)) for row in piv) == n


def test_classification_recipe(spark, prepared):
    r = E.run_classification(prepared)
    imp = r["importance"].collect()
    assert sum(x.importance for x in imp) == pytest.approx(1.0)
    assert {x.feature for x in imp} == {"age", "rating", "positive_feedback_count", "division_name", "department_name", "class_name"}
    met = r["metrics"].collect()[0]
    cm = r["confusion"].collect()
    assert sum(row.pred_0 + row.pred_1 for row in cm) == met.n
    s = r["sample"].collect()
    assert len(s) == 10 and all(x.probability_text.startswith("[") for x in s)


def test_forest_repeatable_with_stable_layout(spark, prepared):
    a = E.run_classification(prepared, layout_partitions=4)["metrics"].collect()[0]
    b = E.run_classification(prepared.repartition(3), layout_partitions=4)["metrics"].collect()[0]
    assert a.accuracy == pytest.approx(b.accuracy) and a.f1 == pytest.approx(b.f1)


def test_choose_k_elbow(spark, prepared):
    sweep = MO.kmeans_sweep(prepared.select(*E.ML_COLS), list(E.REVIEW.numeric), E.CATS, ks=(2, 3, 4))
    assert MO.choose_k(sweep, "elbow") in (2, 3, 4)
    assert MO.choose_k(sweep, 3) == 3


def test_compressed_regression_equals_row_level_fit(spark, prepared):
    _, train, test = E.ml_split(prepared)
    nums = ["age", "recommended_ind", "positive_feedback_count"]
    a = MO.fit_regression(train, test, nums, E.CATS, "rating", compress=True)
    b = MO.fit_regression(train, test, nums, E.CATS, "rating", compress=False)
    ca = {r.feature: r.coefficient for r in a.coefficients.collect()}
    cb = {r.feature: r.coefficient for r in b.coefficients.collect()}
    assert ca.keys() == cb.keys()
    pa = sorted(r.prediction for r in a.predictions.collect())
    pb = sorted(r.prediction for r in b.predictions.collect())
    assert pa == pytest.approx(pb, abs=1e-6)
    ma, mb = a.metrics.collect()[0], b.metrics.collect()[0]
    assert (ma.rmse, ma.mae, ma.r2) == pytest.approx((mb.rmse, mb.mae, mb.r2), abs=1e-9)


def test_lloyd_step_matches_numpy(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(11)
    pts = rng.normal(size=(300, 3))
    df = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in pts], ["features"])
    centres = [pts[0].tolist(), pts[1].tolist(), pts[2].tolist()]
    got = {r.cluster: r for r in MO.lloyd_step(df, centres).collect()}
    d2 = ((pts[:, None, :] - np.array(centres)[None, :, :]) ** 2).sum(-1)
    lab = d2.argmin(1)
    for k in range(3):
        sel = pts[lab == k]
        assert got[k].n == len(sel)
        assert got[k].cost == pytest.approx(d2[lab == k, k].sum())
        assert got[k].centre == pytest.approx(sel.mean(0).tolist())


def test_vector_sums_by_name(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    from pyspark.ml import Pipeline

    out = Pipeline(stages=[FE.index_strings(["c"]), FE.one_hot(["c"]), FE.assemble(["x"], ["c"])]).fit(df).transform(df)
    sums = {r.feature: r.total for r in FE.vector_sums(out).collect()}
    assert sums == {"x": 6.0, "c_vec_a": 2.0, "c_vec_b": 1.0}


def test_weighted_cluster_profile_equals_row_level(spark, prepared):
    sweep = MO.kmeans_sweep(prepared.select(*E.ML_COLS), list(E.REVIEW.numeric), E.CATS, ks=(3,))
    rows = MO.kmeans_assign(sweep, 3)
    pts = MO.assign_points(sweep, 3)
    a = {r.cluster: r for r in MO.cluster_profile(rows, list(E.REVIEW.numeric)).collect()}
    b = {r.cluster: r for r in MO.cluster_profile(pts, list(E.REVIEW.numeric), weight="weight").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k].size == b[k].size
        for c in E.REVIEW.numeric:
            assert a[k][f"avg_{c}"] == pytest.approx(b[k][f"avg_{c}"])
    pa = sorted(map(tuple, MO.cluster_by_group(rows, "division_name", 3).collect()))
    pb = sorted(map(tuple, MO.cluster_by_group(pts, "division_name", 3, weight="weight").collect()))
    assert pa == pb


def test_compressed_forest_is_a_valid_forest(spark, prepared):
    r = E.run_classification(prepared, compress=True)
    imp = r["importance"].collect()
    assert sum(x.importance for x in imp) == pytest.approx(1.0)
    met = r["metrics"].collect()[0]
    row_level = E.run_classification(prepared)["metrics"].collect()[0]
    assert met.n == row_level.n
    assert abs(met.accuracy - row_level.accuracy) < 0.05


def test_explore_bundle_consistent(spark, prepared):
    from bramble.operators import stats as A

    n = prepared.count()
    eda = E.explore(prepared)
    for key in ("rating_counts", "division_counts", "department_counts", "class_counts"):
        assert sum(r["count"] for r in eda[key].collect()) == n
    assert sorted(map(tuple, eda["rating_counts"].collect())) == sorted(
        map(tuple, A.value_counts(prepared, "rating", order="value").collect())
    )
    assert sum(r["count"] for r in eda["age_histogram"].collect()) == n
    assert sum(r.n for r in eda["rating_by_division"].collect()) == n
    ct = eda["rating_vs_recommended"].collect()
    assert sum(r["0"] + r["1"] for r in ct) == n


def test_split_hashes_a_row_once_per_side_and_writes_doubles_as_before(spark):
    from pyspark.sql import functions as F

    odd = [0.0, -0.0, 3.0, -3.0, 41.5, 0.1234565, -1e-9, 1e15, 123456789012345.0, 1e18, 1e300, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, x double")
    same = F.coalesce(F.format_string("%.6f", "x"), F.lit("~"))
    assert [r.t for r in df.select(FE.row_text(df, ["x"]).alias("t")).collect()] == [r.t for r in df.select(same.alias("t")).collect()]
    sides = FE.hash_split(df, (0.5, 0.3, 0.2), seed=1)
    bucket = df.select("i", FE.hash_bucket(df, 1).alias("b")).collect()
    for side, lo, hi in zip(sides, (0, 500, 800), (500, 800, 1000)):
        assert {r.i for r in side.collect()} == {r.i for r in bucket if lo <= r.b < hi}
    for side in FE.hash_split(df, (0.8, 0.2)):
        assert side._jdf.queryExecution().executedPlan().toString().count("md5(") == 1
