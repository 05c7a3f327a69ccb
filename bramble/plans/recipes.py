"""End-to-end recipes (E1-E5): the reference's five pages as Spark plans.

Each recipe returns small result DataFrames (and fitted models); nothing is
collected here.  The prepared review table is materialised once (a reliable
checkpoint in ``spark.checkpoint.dir`` when configured, otherwise persisted),
because every later recipe reads it several times.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import missing as N
from ..operators import models as MO
from ..operators import stats as A
from ..operators.joins import materialize
from ..operators.ranks import count_percentiles
from ..presets import REVIEW

ML_COLS = list(REVIEW.numeric) + list(REVIEW.categorical)
CATS = list(REVIEW.categorical)


@dataclass
class Prepared:
    data: DataFrame
    clean_report: DataFrame
    profile_before: DataFrame
    profile_after: DataFrame


def prepare(raw: DataFrame, median_method: str = "approx", steps: Sequence[str] = C.ALL_STEPS, cut_lineage: bool = True) -> Prepared:
    """Clean -> impute, materialised once for the recipes that follow.

    The cleaned rows and the cleaning report of the selected steps come from one
    duplicate-removal shuffle, and only that table is persisted (every fill
    statistic reads the cleaned rows, a filter over it), until the output stands.
    Without the normalize step the columns keep their original names.  The imputed output is
    checkpointed to ``spark.checkpoint.dir`` (or persisted when none is set),
    which cuts the lineage the model fits would otherwise replay.
    """
    # One shuffle of the raw rows feeds both the report and the cleaned rows;
    # the cleaned rows are a filter over the persisted counted table.
    cleaned, report, counted = C.clean_with_report(raw, steps=steps)
    if cut_lineage:
        counted.persist()
    names = cleaned.columns
    # The imputation plan addresses columns by their normalised names; others come back as they were.
    res = N.impute(C.normalize_columns(cleaned), N.review_plan(median_method=median_method))
    imputed = res.imputed.select(*[F.col(C.normalized_name(c)).alias(c) for c in names])
    if not cut_lineage:
        return Prepared(imputed, report, res.profile_before, N.missing_profile(imputed))
    data = materialize(imputed)
    report, before = materialize(report), materialize(res.profile_before)  # a few rows each
    counted.unpersist()
    return Prepared(data, report, before, N.missing_profile(data))


def explore(df: DataFrame, cols=REVIEW) -> dict[str, DataFrame]:
    """The EDA bundle (A2-A9) from one pass over the prepared input.

    One aggregate with grouping sets counts every column and pair of columns that a table needs; all ten tables
    are read from these counts, and one ranking of them serves all quartiles (summary, both
    box tables).  Small counts go to one partition, so that the tables need no shuffle of their own.
    """
    numeric = list(cols.numeric)
    single = [c for c in numeric if c not in (cols.rating, cols.feedback, cols.recommended)]
    sets = [[cols.rating, cols.feedback], [cols.division, cols.rating], [cols.rating, cols.recommended], [cols.department], [cols.klass], *[[c] for c in single]]
    counts = materialize(A.counted_sets(df, sets))
    if counts.count() <= 200_000:
        counts = counts.coalesce(1)
    home = {cols.rating: 0, cols.feedback: 0, cols.division: 1, cols.recommended: 2, cols.department: 3, cols.klass: 4, **{c: 5 + i for i, c in enumerate(single)}}

    def one(c: str) -> DataFrame:
        """Rows per value of one column."""
        own = counts.filter((F.col("set_no") == home[c]) & F.col(c).isNotNull())
        return own.groupBy(c).agg(F.sum("n").alias("count"))

    def pair(no: int, a: str, b: str) -> DataFrame:
        return counts.filter((F.col("set_no") == no) & F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b, "n")

    values = None
    for c in numeric:
        part = one(c).select(F.lit("value").alias("kind"), F.lit(c).alias("by"), F.col(c).cast("double").alias("value"), F.col("count").alias("n"))
        values = part if values is None else values.unionByName(part)
    boxes = [(1, cols.division, cols.rating), (0, cols.rating, cols.feedback)]
    ranked = values
    for no, by, y in boxes:
        ranked = ranked.unionByName(pair(no, by, y).select(F.lit(f"box {by}").alias("kind"), F.col(by).cast("string").alias("by"), F.col(y).cast("double").alias("value"), "n"))
    quartiles = materialize(count_percentiles(ranked, "value", "n", (0.25, 0.5, 0.75), ["kind", "by"]))

    def box(no: int, by: str, y: str) -> DataFrame:
        q = quartiles.filter(F.col("kind") == f"box {by}").select(F.col("by").cast(df.schema[by].dataType).alias(by), "q")
        return A.box_from_counts(pair(no, by, y).select(by, F.col(y).cast("double").alias("__y"), F.col("n").alias("__n")), q, by)

    cells = pair(2, cols.rating, cols.recommended).groupBy(cols.rating).pivot(cols.recommended).agg(F.sum("n"))
    return {
        "summary": A.summarize_counts(values.select(F.col("by").alias("column"), "value", "n"), quartiles.filter("kind = 'value'").select(F.col("by").alias("column"), "q")),
        "age_histogram": A.histogram(one(cols.age), cols.age, "auto", weight="count"),
        "age_kde": A.kde(one(cols.age), cols.age, weight="count"),
        "rating_counts": one(cols.rating).orderBy(cols.rating),
        "rating_vs_recommended": cells.fillna(0, subset=[c for c in cells.columns if c != cols.rating]),
        "division_counts": one(cols.division).orderBy(F.desc("count"), cols.division),
        "department_counts": one(cols.department).orderBy(F.desc("count"), cols.department),
        "class_counts": one(cols.klass).orderBy(F.desc("count"), cols.klass),
        "rating_by_division": box(*boxes[0]),
        "feedback_by_rating": box(*boxes[1]),
    }


def ml_split(df: DataFrame, seed: int = 42, layout_partitions: int | None = None):
    """The 80/20 content-hash split of the rows, then the seven model columns of each side.

    The hash covers every column of ``df``, so rows that agree on the model columns
    alone fall on either side, as in a split of rows.
    """
    if layout_partitions:
        df = FE.stable_layout(df, layout_partitions, seed)
    train, test = FE.hash_split(df, (0.8, 0.2), seed=seed)
    return df.select(*ML_COLS), train.select(*ML_COLS), test.select(*ML_COLS)


def run_regression(df: DataFrame, seed: int = 42, layout_partitions: int | None = None) -> dict:
    """Linear regression of rating; metrics, coefficients, a sample of predictions."""
    _, train, test = ml_split(df, seed, layout_partitions)
    train = train.persist()
    res = MO.fit_regression(train, test, ["age", "recommended_ind", "positive_feedback_count"], CATS, "rating")
    train.unpersist()
    first = res.model.transform(A.preview(test, 10, ML_COLS))  # the rows are chosen before they are scored
    sample = M.with_residual(MO.sample_predictions(first, 10, ML_COLS, ["rating", "prediction"]), "rating", "prediction")
    return {"metrics": res.metrics, "coefficients": MO.coefficients(res), "sample": sample, "model": res.model}


def run_segmentation(df: DataFrame, ks: Sequence[int] = (2, 3, 4, 5), k: int | str = 3, seed: int = 42, scale: bool = False, iterations: int = 20, tol: float = 1e-4) -> dict:
    """K-means sweep, labels from the chosen k's model, profiles per cluster.

    The fits, the profile and the division x cluster table all run on the
    weighted distinct feature rows; only the row labels (``assigned``) touch
    every row, lazily.
    """
    ks = tuple(ks) if k == "elbow" else tuple(sorted({*ks, int(k)}))
    sweep = MO.kmeans_sweep(df.select(*ML_COLS), list(REVIEW.numeric), CATS, ks, seed, scale, iterations=iterations, tol=tol)
    kk = MO.choose_k(sweep, k)
    # One pass over the points gives a row per (cluster, division, numeric sums); both tables are read from it.
    points = MO.assign_points(sweep, kk)
    sums = materialize(
        points.groupBy("prediction", REVIEW.division).agg(
            F.sum("weight").alias("weight"), *[F.sum(F.col("weight") * F.col(c).cast("double")).alias(c) for c in REVIEW.numeric]
        )
    )
    means = sums.select("prediction", REVIEW.division, "weight", *[(F.col(c) / F.col("weight")).alias(c) for c in REVIEW.numeric])
    return {
        "sweep": sweep.table,
        "k": kk,
        # From the weighted distinct rows: equal to the row-level result, no pass over the rows.
        "profile": MO.cluster_profile(means, list(REVIEW.numeric), weight="weight"),
        "division_by_cluster": MO.cluster_by_group(means, REVIEW.division, kk, weight="weight"),
        "assigned": MO.kmeans_assign(sweep, kk),  # every row with its label (lazy)
    }


def run_classification(df: DataFrame, seed: int = 42, num_trees: int = 10, layout_partitions: int | None = None, compress: bool = True, max_depth: int = 5) -> dict:
    """E5: random forest for the recommendation flag; metrics, confusion matrix
    over every test row, importances by source column, a probability sample.

    Test rows are scored once: metrics and confusion matrix are read from the counts per (actual, predicted),
    and the sample's ten rows are chosen before they are scored."""
    _, train, test = ml_split(df, seed, layout_partitions)
    train = train.persist()
    nums = ["age", "rating", "positive_feedback_count"]
    res = MO.fit_classifier(train, test, nums, CATS, "recommended_ind", num_trees, seed, compress=compress, max_depth=max_depth)
    train.unpersist()
    pairs = materialize(M.pair_counts(res.predictions, "recommended_ind", "prediction"))
    first = MO.vector_as_text(res.model.transform(A.preview(test, 10, ML_COLS)), "probability")
    return {
        "metrics": M.classification_metrics(pairs, "recommended_ind", "prediction", "n_rows"),
        "confusion": M.confusion_matrix(pairs, "recommended_ind", "prediction", weight="n_rows"),
        "importance": MO.feature_importance(res, nums + [c + FE.VEC for c in CATS]),
        "splits": res.splits,
        "sample": MO.sample_predictions(first, 10, ML_COLS, ["recommended_ind", "prediction", "probability_text"]),
        "model": res.model,
    }
