"""Least squares on any set of columns, collinear ones too (M6, M7).

The rows are summed into the Gram matrix of intercept, features and label, a
distributed aggregate whose size is the square of the number of features.  The solve on the driver
is rank-revealing: among all coefficients with the least squared error it returns those with the
smallest norm (the intercept aside), which are unique whatever columns determine each other, as one-hot columns
of nested categories do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Directions whose share of the largest eigenvalue (of the correlations) is smaller count as none.
RANK_TOLERANCE = 1e-10


def gram(df: DataFrame, label: str, features: str = "features", weight: str | None = None) -> DataFrame:
    """``i, j, total``: weighted sums of products of (1, features..., label), for ``i <= j``.

    Each task sums its rows to one matrix; the shuffle adds them up entry by entry.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            y, w = b.column(1).to_numpy(), b.column(2).to_numpy()
            z = np.column_stack([np.ones(len(y)), b.column(0).flatten().to_numpy().reshape(len(y), -1), y])
            part = z.T @ (z * w[:, None])
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "total"])

    return rows.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))


def matrix(sums: DataFrame) -> np.ndarray:
    """The Gram matrix on the driver (its side is the number of features + 2)."""
    rows = sums.collect()
    if not rows:
        raise ValueError("no rows to fit")
    side = max(r.j for r in rows) + 1
    out = np.zeros((side, side))
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = r.total
    return out


def solve(g: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Coefficients of least error and, among those, least norm; the intercept; the rank."""
    n, mean = g[0, 0], g[0, 1:] / g[0, 0]
    spread = g[1:, 1:] - n * np.outer(mean, mean)
    xx, xy = spread[:-1, :-1], spread[:-1, -1]
    size = np.sqrt(np.maximum(np.diag(xx), 0.0))
    live = size > 1e-7 * np.sqrt(np.maximum(np.diag(g)[1:-1], 1e-300))  # constant columns say nothing
    out = np.zeros(len(size))
    rank = 0
    if live.any():
        scale = 1.0 / size[live]
        values, vectors = np.linalg.eigh(xx[np.ix_(live, live)] * np.outer(scale, scale))
        kept = values > RANK_TOLERANCE * values.max()
        rank = int(kept.sum())
        some = scale * (vectors[:, kept] @ ((vectors[:, kept].T @ (scale * xy[live])) / values[kept]))
        none = vectors[:, ~kept]
        free = scale[:, None] * np.where(np.abs(none) > 1e-8, none, 0.0)  # adding any of these changes no prediction
        if free.shape[1]:
            some = some - free @ np.linalg.lstsq(free, some, rcond=None)[0]
        out[live] = some
    return out, float(mean[-1] - mean[:-1] @ out), rank


@dataclass
class LinearFit:
    prep: PipelineModel
    coefficients: np.ndarray
    intercept: float
    rank: int

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its features and ``prediction``."""
        return self.prep.transform(df).withColumn("prediction", predicted(self.coefficients, self.intercept))


def predicted(coefficients: np.ndarray | Sequence[float], intercept: float, features: str = "features") -> Column:
    """The linear prediction of a vector column; other columns stay in the JVM."""
    beta = np.asarray(coefficients, float)

    @F.arrow_udf("double")
    def dot(x: pa.Array) -> pa.Array:
        return pa.array(x.flatten().to_numpy().reshape(len(x), len(beta)) @ beta + intercept)

    return dot(vector_to_array(F.col(features)))


def fit(points: DataFrame, prep: PipelineModel, label: str, weight: str | None = None) -> LinearFit:
    """Least squares of ``label`` on the features that ``prep`` makes of ``points``."""
    return LinearFit(prep, *solve(matrix(gram(prep.transform(points), label, weight=weight))))
