"""Models (M6, M7, M9-M11, M13, M14, M16, P5): fits on distributed sums, labels and predictions as columns.

Least squares is in :mod:`.linear`, k-means in :mod:`.kmeans`, the forest in :mod:`.forest`; the preparation is
Spark ML's.  The only things that reach the driver are model parameters, whose size is the
number of features, clusters or nodes, never the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features as FE
from . import forest as FO
from . import kmeans as KM
from . import linear as LN
from .joins import materialize
from .metrics import classification_metrics, regression_metrics


def _names_frame(spark: SparkSession, names: Sequence[str], values: Sequence[float], value_col: str) -> DataFrame:
    """A small frame of model parameters (one row per feature slot)."""
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values))]
    schema = T.StructType(
        [
            T.StructField("slot", T.IntegerType(), False),
            T.StructField("feature", T.StringType(), False),
            T.StructField(value_col, T.DoubleType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


# --------------------------------------------------------------------------- M6, M7, M8


@dataclass
class RegressionResult:
    model: LN.LinearFit
    predictions: DataFrame
    metrics: DataFrame
    coefficients: DataFrame
    intercept: float


def fit_regression(
    train: DataFrame,
    test: DataFrame,
    nums: Sequence[str],
    cats: Sequence[str],
    label: str = "rating",
    compress: bool = True,
) -> RegressionResult:
    """M6-M8: linear regression of ``label`` on numeric and one-hot features (:mod:`.linear`).

    The preparation is fitted on the training split only (unseen test labels
    go to the indexer's extra bucket).  With ``compress`` (default) the fit
    runs on the training rows' distinct (features, label) combinations with
    their counts as weights: the same normal equations, so the same
    coefficients, from one pass over the data.
    """
    cols = list(dict.fromkeys([*nums, *cats, label]))
    points = (FE.weighted_distinct(train, cols) if compress else train.select(*cols).withColumn("weight", F.lit(1.0))).persist()
    prep = FE.fit_weighted_preparation(points, nums, cats)
    model = LN.fit(points, prep, label, "weight")
    points.unpersist()
    pred = model.transform(test)
    names = FE.vector_names(pred, "features")
    coefs = _names_frame(train.sparkSession, names, model.coefficients.tolist(), "coefficient")
    return RegressionResult(model, pred, regression_metrics(pred, label, "prediction"), coefs, model.intercept)


def coefficients(result: RegressionResult) -> DataFrame:
    """M7: coefficient per named feature slot (plus the intercept as its own row)."""
    spark = result.coefficients.sparkSession
    icpt = spark.createDataFrame([(-1, "intercept", result.intercept)], result.coefficients.schema)
    return result.coefficients.unionByName(icpt)


# --------------------------------------------------------------------------- M9-M11, M17


@dataclass
class KMeansSweep:
    centres: dict[int, np.ndarray]  # per k
    prepared: DataFrame  # every input row with its feature vector
    table: DataFrame  # k, wssse, sizes
    prep_model: PipelineModel = field(default=None)
    points: DataFrame = field(default=None)  # distinct feature rows with ``weight``, prepared


def kmeans_sweep(
    df: DataFrame,
    nums: Sequence[str],
    cats: Sequence[str],
    ks: Sequence[int] = (2, 3, 4, 5),
    seed: int = 42,
    scale: bool = False,
    compress: bool = True,
    iterations: int = 20,
    tol: float = 1e-4,
) -> KMeansSweep:
    """K-means for every k at once; training cost and cluster sizes per k.

    With ``compress`` (default) the iterations run over the distinct feature
    rows weighted by their counts (the same k-means objective, one pass over
    the data in total) instead of over every row.  See :mod:`.kmeans` for the start and the passes; the
    same rows give the same clusters under any partitioning, compressed or not.  Sizes are
    weighted counts, i.e. rows.
    """
    cols = list(dict.fromkeys([*nums, *cats]))
    out = "raw_features" if scale else "features"
    # The distinct rows are written once: the preparation, the sweep and what reads the clusters later share them.
    points = materialize(FE.weighted_distinct(df, cols)) if compress else df.select(*cols).withColumn("weight", F.lit(1.0))
    prep = FE.fit_weighted_preparation(points, nums, cats, out=out)
    if scale:
        from pyspark.ml.feature import ElementwiseProduct
        from pyspark.ml.linalg import Vectors

        std = [r["std"] for r in slot_std(prep.transform(points), "raw_features", "weight").orderBy("slot").collect()]  # one number per slot
        factors = Vectors.dense([1.0 / s if s else 0.0 for s in std])
        prep = PipelineModel(stages=[*prep.stages, ElementwiseProduct(scalingVec=factors, inputCol="raw_features", outputCol="features")])
    prepared_points = prep.transform(points)
    packed = KM.blocks(prepared_points, cols, max(ks), seed).persist()
    centres, rows = KM.sweep(packed, ks, iterations, tol)
    packed.unpersist()
    table = df.sparkSession.createDataFrame(rows, "k int, wssse double, sizes array<bigint>")
    return KMeansSweep(centres, prep.transform(df), table, prep, prepared_points)


def slot_std(df: DataFrame, vector: str, weight: str) -> DataFrame:
    """``slot, std``: sample standard deviation per vector slot, rows counted ``weight`` times."""
    slots = df.select(F.col(weight).cast("double").alias("w"), F.posexplode(vector_to_array(vector)).alias("slot", "x"))
    sums = slots.groupBy("slot").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("x")).alias("s"), F.sum(F.col("w") * F.col("x") * F.col("x")).alias("q"))
    spread = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
    return sums.select("slot", F.sqrt(F.coalesce(F.try_divide(spread, F.col("n") - 1), F.lit(0.0))).alias("std"))


def choose_k(sweep: KMeansSweep, k: int | str = 3) -> int:
    """A fixed k, or ``"elbow"`` (:func:`.kmeans.elbow` of the sweep table)."""
    return int(k) if k != "elbow" else int(KM.elbow(sweep.table.select("k", "wssse")).first()["k"])


def kmeans_assign(sweep: KMeansSweep, k: int | str = 3) -> DataFrame:
    """Label every row with its cluster, reusing the centres of the sweep."""
    return sweep.prepared.withColumn("prediction", KM.nearest(sweep.centres[choose_k(sweep, k)]))


def assign_points(sweep: KMeansSweep, k: int | str = 3) -> DataFrame:
    """M10 on the weighted distinct feature rows: a cluster per row kind, with its ``weight``.

    Identical rows get identical labels, so any per-cluster statistic of the
    rows can be computed from this (small) table with the weights.
    """
    return sweep.points.withColumn("prediction", KM.nearest(sweep.centres[choose_k(sweep, k)]))


def cluster_profile(assigned: DataFrame, cols: Sequence[str], cluster: str = "prediction", weight: str | None = None) -> DataFrame:
    """Size and mean of each column per cluster, named by column (not by position).

    With ``weight`` the input is a weighted table (see :func:`assign_points`):
    sizes are weight sums and means are weighted, equal to the row-level result.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    size = F.sum(w)
    out = assigned.groupBy(F.col(cluster).alias("cluster")).agg(
        size.alias("__size"), *[(F.sum(w * F.col(c).cast("double")) / size).alias(f"avg_{c}") for c in cols]
    )
    return out.select("cluster", F.col("__size").cast("bigint").alias("size"), *[f"avg_{c}" for c in cols])


def cluster_by_group(assigned: DataFrame, by: str, k: int, cluster: str = "prediction", weight: str | None = None) -> DataFrame:
    """Rows per (group, cluster) as a wide table, zeros for absent pairs."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    piv = assigned.groupBy(by).pivot(cluster, list(range(k))).agg(F.sum(w).cast("bigint"))
    return piv.fillna(0, subset=[str(i) for i in range(k)])


# --------------------------------------------------------------------------- M13-M16, P5


@dataclass
class ClassificationResult:
    model: FO.Forest
    predictions: DataFrame
    metrics: DataFrame
    importances: DataFrame
    splits: DataFrame  # tree, node, slot, feature, threshold, gain, n_rows


def fit_classifier(
    train: DataFrame,
    test: DataFrame,
    nums: Sequence[str],
    cats: Sequence[str],
    label: str = "recommended_ind",
    num_trees: int = 10,
    seed: int = 42,
    compress: bool = True,
    max_depth: int = 5,
    bootstrap: bool = True,
) -> ClassificationResult:
    """Random forest for ``label`` (:mod:`.forest`); accuracy and weighted F1 on the test split.

    ``compress`` (default) grows the trees from the distinct (features, label) rows with their
    counts as weights, one pass over the data; the forest is the same as from the rows themselves.  The metrics
    likewise score each distinct test row once and count it as often as it occurs.
    """
    cols = list(dict.fromkeys([*nums, *cats, label]))
    points = (FE.weighted_distinct(train, cols) if compress else train.select(*cols).withColumn("weight", F.lit(1.0))).persist()
    prep = FE.fit_weighted_preparation(points, nums, cats)
    prepared = prep.transform(points)
    names = FE.vector_names(prepared, "features")
    trees, classes = FO.grow(prepared, cols, label, nums, len(names), num_trees, max_depth, seed, bootstrap)
    points.unpersist()
    model = FO.Forest(prep, trees, classes, names)
    pred = model.transform(test)
    splits = model.splits(train.sparkSession)
    every = _names_frame(train.sparkSession, names, [0.0] * len(names), "none").select("slot", "feature")
    importances = every.join(F.broadcast(FO.importances(splits)), "feature", "left").select("slot", "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
    scored = model.transform(FE.weighted_distinct(test, cols)) if compress else pred.withColumn("weight", F.lit(1.0))
    return ClassificationResult(model, pred, classification_metrics(scored, label, "prediction", "weight"), importances, splits)


def feature_importance(result: ClassificationResult, inputs: Sequence[str], by_source: bool = True) -> DataFrame:
    """Importance per slot, or summed back per source column, largest first.

    Every one-hot slot is named (``division_name_vec_General`` ...) from the
    assembler metadata; ``by_source`` folds slots into their input column.
    """
    imp = result.importances
    if not by_source:
        return imp.orderBy(F.desc("importance"), "feature")
    mapping = [(n, FE.source_of(n, inputs)) for n in result.model.names]
    src = imp.sparkSession.createDataFrame(mapping, "feature string, source string")
    folded = imp.join(F.broadcast(src), "feature").groupBy(F.col("source").alias("feature")).agg(
        F.sum("importance").alias("importance")
    )
    return folded.orderBy(F.desc("importance"), "feature")


def vector_as_text(df: DataFrame, col: str, out: str | None = None, digits: int = 6) -> DataFrame:
    """P5: a vector column as an array of doubles and as printable text."""
    arr = vector_to_array(F.col(col))
    text = F.concat(
        F.lit("["), F.array_join(F.transform(arr, lambda v: F.format_number(v, digits)), ", "), F.lit("]")
    )
    return df.withColumn(out or f"{col}_text", text)


def sample_predictions(pred: DataFrame, n: int, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The first ``n`` predictions in a stated order, all columns from one query."""
    return pred.orderBy(*keys).limit(n).select(*cols)


def lloyd_step(df: DataFrame, centres: Sequence[Sequence[float]], col: str = "features", weight: str | None = None) -> DataFrame:
    """M9 check: one k-means assignment + update step from fixed centres.

    Each row goes to its nearest centre (squared Euclidean distance; ties to
    the lower index, as Spark's k-means); the output has, per cluster, the
    weighted row count, the cost and the new centre.  The k x d centres are
    model-sized literals; the step is one narrow projection and one grouped
    aggregate (partial on the map side).
    Output: ``cluster int, n double, cost double, centre array<double>``.
    """
    k, d = len(centres), len(centres[0])
    x = vector_to_array(F.col(col))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    cand = []
    for i, c in enumerate(centres):
        diff = F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b))
        d2 = F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + v)
        cand.append(F.struct(d2.alias("d2"), F.lit(i).alias("cluster")))
    best = F.array_min(F.array(*cand))
    rows = df.select(x.alias("__x"), w.alias("__w"), best.alias("__b"))
    agg = rows.groupBy(F.col("__b.cluster").alias("cluster")).agg(
        F.sum("__w").alias("n"),
        F.sum(F.col("__w") * F.col("__b.d2")).alias("cost"),
        *[F.sum(F.col("__w") * F.col("__x")[j]).alias(f"s{j}") for j in range(d)],
    )
    return agg.select(
        F.col("cluster").cast("int").alias("cluster"),
        "n",
        "cost",
        F.array(*[F.col(f"s{j}") / F.col("n") for j in range(d)]).alias("centre"),
    )
