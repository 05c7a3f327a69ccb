"""Inputs just off the fixture: every row is counted, every argument is honoured."""

import pytest
from pyspark.sql import functions as F

from bramble.operators import clean as C
from bramble.operators import features as FE
from bramble.operators import metrics as M
from bramble.operators import models as MO
from bramble.operators import stats as A
from bramble.plans import recipes as E
from bramble.sources.reviews_raw import reviews_raw


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    return reviews_raw(spark, sf_small)


@pytest.fixture(scope="module")
def prepared(raw):
    return E.prepare(raw).data


def test_crosstab_of_uncleaned_rows_counts_every_flag(raw):
    prep = E.prepare(raw, steps=("normalize", "dedupe", "age", "rating"))
    table = E.explore(prep.data)["rating_vs_recommended"]
    counted = sum(sum(r[c] for c in table.columns if c != "rating") for r in table.collect())
    assert counted == prep.data.filter("recommended_ind is not null").count() and len(table.columns) > 3


def test_confusion_matrix_counts_unlisted_predictions(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0), (1.0, None), (1.0, 1.0)], "y double, p double")
    got = {r["y"]: (r["pred_0"], r["pred_1"], r["pred_other"]) for r in M.confusion_matrix(df, "y", "p", [0.0, 1.0]).collect()}
    assert got == {0.0: (1, 0, 1), 1.0: (0, 1, 1)}
    assert set(M.confusion_matrix(df.filter("p is not null"), "y", "p").columns) == {"y", "pred_0", "pred_1", "pred_2"}


def test_custom_rules_apply_in_clean_and_report(raw):
    rules = [C.Rule("feedback", F.col("positive_feedback_count") >= 3)]
    out = C.clean(raw, rules=rules)
    assert out.filter("positive_feedback_count < 3").count() == 0
    report = {r["step"]: r["rows_out"] for r in C.clean_report(raw, rules).collect()}
    assert report["feedback"] == out.count()
    assert C.clean(raw, steps=("normalize", "feedback"), rules=rules).count() > 0
    with pytest.raises(ValueError):
        C.clean(raw, steps=("feedback",))


def test_report_follows_the_steps(raw):
    prep = E.prepare(raw, steps=("normalize", "age"))
    rows = prep.clean_report.collect()
    assert [r["step"] for r in rows] == ["age"] and rows[-1]["rows_out"] == prep.data.count()


def test_prepare_without_renaming(raw):
    prep = E.prepare(raw, steps=("dedupe", "age", "rating", "recommended"))
    assert prep.data.columns == raw.columns
    assert prep.data.count() == E.prepare(raw).data.count()


def test_split_is_by_row(prepared):
    _, train, test = E.ml_split(prepared)
    both = train.distinct().intersect(test.distinct()).count()
    assert both > 0  # equal model rows fall on either side
    share = train.count() / prepared.count()
    assert abs(share - 0.8) < 0.02


def test_scaled_clusters_do_not_depend_on_compression(spark):
    rows = [(1.0, 10.0, "a")] * 98 + [(50.0, 11.0, "b"), (3.0, 12.0, "c")]
    df = spark.createDataFrame(rows, "x double, y double, c string")
    a, b = (MO.kmeans_sweep(df, ["x", "y"], ["c"], ks=(2,), scale=True, compress=x) for x in (True, False))
    scaled = lambda s: sorted(map(str, s.prepared.select("features").distinct().collect()))
    assert scaled(a) == scaled(b)
    assert a.table.first()["wssse"] == pytest.approx(b.table.first()["wssse"])


def test_zero_spread(spark):
    df = spark.createDataFrame([(2.0, 2.5), (2.0, 1.5)], "y double, p double")
    row = M.regression_metrics(df, "y", "p").first()
    assert row["r2"] is None and row["rmse"] == 0.5
    assert {r["density"] for r in A.kde(df, "y", grid=5).collect()} == {None}


def test_segmentation_fits_the_chosen_k(prepared):
    assert E.run_segmentation(prepared, ks=(2,), k=3)["k"] == 3


def test_recipes_release_what_they_persist(spark, raw):
    prep = E.prepare(raw)
    start = len(spark.sparkContext._jsc.getPersistentRDDs())
    E.run_regression(prep.data)["metrics"].collect()
    E.run_segmentation(prep.data, ks=(2, 3))["profile"].collect()
    E.run_classification(prep.data, num_trees=2)["metrics"].collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= start


def test_hash_split_with_keys_covers_rows(prepared):
    parts = FE.hash_split(prepared, (0.5, 0.5), seed=1)
    assert sum(p.count() for p in parts) == prepared.count()
