import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from bramble.operators import clean as C
from bramble.sources.generator import REVIEW_SCHEMA, reviews_frame
from bramble.sources.reviews_raw import reviews_raw


def test_normalize_columns_renames_all(spark):
    df = spark.createDataFrame([(1, 2)], "`Recommended IND` int, `Class Name` int")
    assert C.normalize_columns(df).columns == ["recommended_ind", "class_name"]


def test_normalize_columns_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError, match="both normalise"):
        C.normalize_columns(df)


def test_drop_duplicates_is_null_safe(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), (1, None)], "a int, b string")
    assert C.drop_exact_duplicates(df).count() == 2


def test_range_bounds_open_and_closed(spark):
    df = spark.createDataFrame([(v,) for v in [None, -1, 0, 1, 5, 99, 100, 6]], "age int")
    assert sorted(r.age for r in C.filter_range(df, "age", 0, 100, (False, False)).collect()) == [1, 5, 6, 99]
    assert sorted(r.age for r in C.filter_range(df, "age", 1, 5).collect()) == [1, 5]
    assert sorted(r.age for r in C.filter_in(df, "age", [0, 1]).collect()) == [0, 1]


def test_clean_reference_rules_and_step_choice(spark):
    rows = [
        (30, "t", "x", 5, 1, 3, "General", "Tops", "Blouses"),
        (30, "t", "x", 5, 1, 3, "General", "Tops", "Blouses"),
        (None, "t", "x", 5, 1, 3, "General", "Tops", "Blouses"),
        (100, "t", "x", 5, 1, 3, "General", "Tops", "Blouses"),
        (40, "t", "x", 0, 1, 3, "General", "Tops", "Blouses"),
        (40, "t", "x", 4, 2, 3, "General", "Tops", "Blouses"),
    ]
    df = reviews_frame(spark, rows)
    out = C.clean(df)
    assert out.count() == 1
    assert out.columns[0] == "age"
    # Only duplicate removal selected: invalid rows stay.
    assert C.clean(df, steps=["normalize", "dedupe"]).count() == 5
    with pytest.raises(ValueError):
        C.clean(df, steps=["bogus"])


def test_clean_report_counts_match_sequential_steps(spark, sf_small):
    raw = reviews_raw(spark, sf_small)
    rep = {r.step: (r.rows_in, r.rows_out) for r in C.clean_report(raw).collect()}
    n = C.normalize_columns(raw)
    d = C.drop_exact_duplicates(n)
    assert rep["dedupe"] == (n.count(), d.count())
    assert rep["recommended"][1] == C.clean(raw).count() == 5199


def test_clean_idempotent(spark, sf_small):
    once = C.clean(reviews_raw(spark, sf_small))
    twice = C.clean(once)
    assert once.count() == twice.count()


def test_clean_without_renaming_uses_original_names(spark, sf_small):
    raw = reviews_raw(spark, sf_small)
    kept = C.clean(raw, steps=["dedupe", "age", "rating", "recommended"])
    assert "Recommended IND" in kept.columns
    assert kept.count() == C.clean(raw).count() == 5199
