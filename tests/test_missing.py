import math

import pytest

from bramble.operators import missing as N


def test_profile_counts_nan_only_in_floating_columns(spark):
    df = spark.createDataFrame([(float("nan"), "NaN"), (None, None), (1.0, "a")], "x double, s string")
    prof = {r.column: (r.missing_count, r.missing_pct) for r in N.missing_profile(df).collect()}
    assert prof["x"][0] == 2
    assert prof["s"][0] == 1  # the text "NaN" is a value, not a missing one
    assert math.isclose(prof["x"][1], 200.0 / 3)


def test_profile_on_empty_frame_has_null_pct(spark):
    df = spark.createDataFrame([], "x int, s string")
    rows = N.missing_profile(df).collect()
    assert [r.missing_count for r in rows] == [0, 0]
    assert all(r.missing_pct is None for r in rows)


def test_mode_excludes_nulls_and_breaks_ties_low(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("b",), ("a",), ("b",), ("a",)], "v string")
    out = N.impute_mode(df, "v")
    assert sorted(r.v for r in out.collect()) == ["a"] * 5 + ["b"] * 2


def test_mode_of_all_null_column_is_noop(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "v string, k int")
    assert [r.v for r in N.impute_mode(df, "v").collect()] == [None, None]


def test_median_exact_interpolates_and_widens(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, None]], "age int")
    out = N.impute_median(df, "age", method="exact")
    assert dict(out.dtypes)["age"] == "double"
    assert sorted(r.age for r in out.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]
    kept = N.impute_median(df, "age", method="exact", keep_type=True)
    assert dict(kept.dtypes)["age"] == "int"


def test_median_approx_returns_an_element(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)] + [(None,)], "x double")
    filled = [r.x for r in N.impute_median(df, "x", method="approx").collect()]
    assert filled.count(5.0) == 2


def test_constant_fill(spark):
    df = spark.createDataFrame([(None,), ("t",)], "title string")
    assert sorted(r.title for r in N.impute_constant(df, "title", "No Title").collect()) == ["No Title", "t"]


def test_group_mode_fills_within_group_only(spark):
    rows = [("A", "x"), ("A", "x"), ("A", "y"), ("A", None), ("B", "y"), ("B", None), ("C", None), (None, None)]
    df = spark.createDataFrame(rows, "div string, dept string")
    out = sorted(N.impute_group_mode(df, "dept", "div").collect(), key=lambda r: (r.div or "~", r.dept or "~"))
    got = [(r.div, r.dept) for r in out]
    assert ("A", "x") in got and got.count(("A", "x")) == 3
    assert got.count(("B", "y")) == 2
    assert ("C", None) in got and (None, None) in got  # no value in group / no group


def test_group_mode_shuffle_path_equals_broadcast_path(spark):
    rows = [(f"g{i % 7}", f"v{(i * 3) % 4}" if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, v string")
    a = sorted(map(tuple, N.impute_group_mode(df, "v", "g").collect()), key=repr)
    b = sorted(map(tuple, N.impute_group_mode(df, "v", "g", max_broadcast_rows=0).collect()), key=repr)
    assert a == b


def test_impute_recipe_leaves_no_nulls_and_is_idempotent(spark, sf_small):
    from bramble.operators import clean as C
    from bramble.sources.reviews_raw import reviews_raw

    cleaned = C.clean(reviews_raw(spark, sf_small))
    res = N.impute(cleaned, N.review_plan(median_method="exact"))
    after = {r.column: r.missing_count for r in res.profile_after.collect()}
    for c in ["age", "title", "rating", "division_name", "department_name"]:
        assert after[c] == 0
    again = N.impute(res.imputed, N.review_plan(median_method="exact")).imputed
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, res.imputed.collect()), key=repr)


def test_impute_recipe_on_empty_frame(spark):
    from bramble.operators import clean as C
    from bramble.sources.generator import reviews_frame

    empty = C.normalize_columns(reviews_frame(spark, []))
    res = N.impute(empty, N.review_plan(median_method="approx"))
    assert res.imputed.count() == 0
    assert dict(res.imputed.dtypes)["age"] == "double"
    assert all(r.missing_pct is None for r in res.profile_after.collect())


def test_null_can_not_become_the_mode(spark):
    # Null is the most frequent "value"; the reference would fill null with null.
    rows = [(None,)] * 5 + [("x",), ("y",), ("y",)]
    df = spark.createDataFrame(rows, "v string")
    assert [r.v for r in N.impute_mode(df, "v").collect()].count("y") == 7


def test_batched_fills_equal_one_by_one(spark):
    # 9 and 10 tie for the mode: the typed smallest (9) must win, not the text smallest ("10").
    rows = [(9, "b", 1.0), (9, "a", None), (10, "a", 3.0), (10, None, 5.0), (None, "b", 2.0), (None, None, None)]
    df = spark.createDataFrame(rows, "r int, s string, x double")
    plan = [N.Step("median", "x", "exact"), N.Step("mode", "r"), N.Step("constant", "s", "zz"), N.Step("mode", "s")]
    batched = N.impute(df, plan).imputed
    one = df
    for st in plan:
        one = N.apply_step(one, st)
    assert sorted(map(tuple, batched.collect()), key=repr) == sorted(map(tuple, one.collect()), key=repr)
    assert [r.r for r in batched.collect()].count(9) == 4


def test_group_then_global_mode_equals_one_by_one(spark):
    rows = [("A", "x"), ("A", "x"), ("A", None), ("A", None), ("A", None), ("B", "y"), ("B", "y"), ("B", "y"),
            ("B", None), ("C", None), (None, None), (None, "z")]
    df = spark.createDataFrame(rows, "div string, dept string")
    plan = [N.Step("group_mode", "dept", by=("div",)), N.Step("mode", "dept")]
    fused = N.impute(df, plan).imputed
    one = df
    for st in plan:
        one = N.apply_step(one, st)
    got = sorted(map(tuple, fused.collect()), key=repr)
    assert got == sorted(map(tuple, one.collect()), key=repr)
    # after the group fill: x = 2 + 3 nulls of A = 5, y = 3 + 1 = 4, so C's and the null group's rows get x
    assert ("C", "x") in got and (None, "x") in got


@pytest.mark.parametrize("name,plain", [("i3_impute_mode_division", lambda df: N.impute_mode(df, "division_name")), ("i4_impute_group_mode", lambda df: N.impute_group_mode(df, "department_name", "division_name"))])
def test_fills_read_the_cleaned_rows_once(spark, sf_small, name, plain):
    """The statistic and the filled rows come from one duplicate removal, held between them."""
    from bramble.plans import registry

    out = registry.QUERIES[name](spark, sf_small)
    assert "InMemoryTableScan" in out._jdf.queryExecution().executedPlan().toString()
    want = plain(registry.cleaned(spark, sf_small))
    assert out.count() == want.count() and out.exceptAll(want).count() == 0
