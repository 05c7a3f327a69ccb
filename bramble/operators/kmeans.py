"""K-means for several numbers of clusters in shared passes.

All sweeps advance together: one aggregate over the points per iteration gives every
(k, cluster) its weight, cost and sums.  The start is k-means++ with draws from the rows themselves:
centre ``j`` is the point with the smallest ``-ln(u_j) / distance^2``, where ``u_j`` comes from the md5 of
seed, ``j`` and the row's text.  That chooses each distinct point with probability proportional to
``distance^2``, is one more aggregate per centre, and depends neither on partitions nor on whether equal rows are grouped.  A sweep of k
uses the first k centres.  Sums of whole numbers are exact, so centres of unscaled integer features
don't depend on partitions either.

Points sit in the cluster's memory as blocks of numbers (recomputed if an executor is lost); a task
holds one block.  Centres, k times the number of features, are all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import row_text

_KEY = 32  # bytes of an md5 in hexadecimal


def draw(seed: int, j: int, text: Column) -> Column:
    """A number in (0, 1] from the md5 of seed, centre and row text."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(j)), text)), 1, 8)
    return (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(4294967296.0)


def blocks(points: DataFrame, cols: Sequence[str], k: int, seed: int, features: str = "features", weight: str = "weight") -> DataFrame:
    """``x, w, u, key``: the points in blocks of one Arrow batch, as raw numbers."""
    text = row_text(points, cols)
    rows = points.select(
        vector_to_array(features).alias("x"), F.col(weight).cast("double").alias("w"), F.array(*[draw(seed, j, text) for j in range(k)]).alias("u"), F.md5(text).alias("key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                flat = [b.column(i).flatten().to_numpy() for i in (0, 2)]
                raw = [flat[0].tobytes(), b.column(1).to_numpy().tobytes(), flat[1].tobytes(), "".join(b.column(3).to_pylist()).encode()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in raw], names=["x", "w", "u", "key"])

    return rows.mapInArrow(run, "x binary, w binary, u binary, key binary")


def _numbers(b: pa.RecordBatch, names: Sequence[str]) -> Iterator[list[np.ndarray]]:
    for i in range(b.num_rows):
        yield [np.frombuffer(b.column(b.schema.get_field_index(n))[i].as_py(), f"S{_KEY}" if n == "key" else np.float64) for n in names]


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    out = np.empty((len(x), len(centres)))
    step = max(1, 2_000_000 // max(1, centres.size))
    for at in range(0, len(x), step):
        gap = x[at : at + step, None, :] - centres[None]
        out[at : at + step] = (gap * gap).sum(2)
    return out


def start(packed: DataFrame, k: int) -> np.ndarray:
    """Up to ``k`` centres (fewer if there are fewer distinct points), in the order of their choice."""
    centres: list[np.ndarray] = []
    for j in range(k):
        now = np.array(centres)

        def run(batches: Iterator[pa.RecordBatch], j=j, now=now) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for x, u, key in _numbers(b, ("x", "u", "key")):
                    x, u = x.reshape(len(key), -1), u.reshape(len(key), -1)
                    far = distances(x, now).min(1) if j else np.ones(len(key))
                    with np.errstate(divide="ignore", invalid="ignore"):
                        race = np.where(far > 0, -np.log(u[:, j]) / far, np.inf)
                    best = np.lexsort((key, race))[0]
                    if np.isfinite(race[best]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([race[best]]), pa.array([key[best].decode()]), pa.array([x[best].tobytes()], pa.binary())], names=["race", "key", "x"]
                        )

        won = packed.mapInArrow(run, "race double, key string, x binary").orderBy("race", "key").limit(1).collect()
        if not won:
            break
        centres.append(np.frombuffer(bytes(won[0].x), np.float64))
    return np.array(centres)


def step(packed: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per k: weight, cost and sum of the points nearest to each centre (ties to the lower number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in centres.items()}
        for b in batches:
            for x, w in _numbers(b, ("x", "w")):
                x = x.reshape(len(w), -1)
                wx = x * w[:, None]
                for k, c in centres.items():
                    far = distances(x, c)
                    own = far.argmin(1)
                    cost = w * far[np.arange(len(own)), own]
                    for i in range(len(c)):
                        mine = own == i
                        total[k][i] += np.concatenate([wx[mine].sum(0), [w[mine].sum(), cost[mine].sum()]])
        for k, t in total.items():
            n = t.size
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(t.ravel())], names=["k", "at", "s"])

    out = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in centres.items()}
    for r in packed.mapInArrow(run, "k int, at int, s double").groupBy("k", "at").agg(F.sum("s").alias("s")).collect():
        out[r.k].flat[r.at] = r.s
    return {k: (t[:, -2], t[:, -1], t[:, :-2]) for k, t in out.items()}


def sweep(packed: DataFrame, ks: Sequence[int], iterations: int = 20, tol: float = 1e-4) -> tuple[dict[int, np.ndarray], list[tuple[int, float, list[int]]]]:
    """Centres per k, and rows ``(k, cost, sizes)``.

    A k is done after ``iterations``, or when none of its centres moves further than ``tol``; an empty cluster stays
    where it is.  Cost and sizes are those of the returned centres.
    """
    chosen = start(packed, max(ks))
    centres = {int(k): chosen[:k].copy() for k in ks}
    moving = {k for k, c in centres.items() if len(c)}
    for _ in range(iterations):
        if not moving:
            break
        for k, (n, _, sums) in step(packed, {k: centres[k] for k in sorted(moving)}).items():
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centres[k])
            if ((new - centres[k]) ** 2).sum(1).max() <= tol * tol:
                moving.discard(k)
            centres[k] = new
    last = step(packed, {k: c for k, c in centres.items() if len(c)})
    rows = []
    for k in centres:
        n, cost, _ = last.get(k, (np.zeros(0), np.zeros(0), None))
        rows.append((k, float(cost.sum()), [int(round(x)) for x in n] + [0] * (k - len(n))))
    return centres, rows


def nearest(centres: np.ndarray, features: str = "features") -> Column:
    """The number of the nearest centre (ties to the lower number) of a vector column; other columns stay in the JVM."""

    @F.arrow_udf("int")
    def near(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, centres.shape[1]))
        return pa.array(distances(rows, centres).argmin(1).astype(np.int32))

    return near(vector_to_array(F.col(features)))


def elbow(costs: DataFrame, by: Sequence[str] = (), k: str = "k", cost: str = "wssse") -> DataFrame:
    """Per curve the k whose relative drop in cost exceeds the next one's by most (ties to the smaller k).

    ``costs`` has one row per curve (``by``) and k.  A curve of fewer than three points
    has no elbow and gives its largest k.
    """
    curve = Window.partitionBy(*by).orderBy(k)
    before = F.lag(F.col(cost)).over(curve)
    drops = costs.select(*by, F.col(k).alias("__k"), ((before - F.col(cost)) / F.greatest(before, F.lit(1e-12))).alias("__drop"))
    after = Window.partitionBy(*by).orderBy("__k")
    gains = drops.withColumn("__gain", F.col("__drop") - F.lead("__drop").over(after))
    best = F.min(F.when(F.col("__gain").isNotNull(), F.struct((-F.col("__gain")).alias("g"), F.col("__k"))))["__k"]
    return gains.groupBy(*by).agg(F.coalesce(best, F.max("__k")).alias(k))
