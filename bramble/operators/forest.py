"""Random forest that depends on its rows alone.

Every tree draws each distinct row a number of times: a Poisson(1) draw from the md5 of seed, tree and the row's
text.  All trees grow together, one pass over the points per level: tasks count classes per (tree, node, feature,
bin), the shuffle adds the counts up by (tree, node), and the split with the largest gain is chosen where they
meet.  Counts are whole numbers, so the same rows and seed give the same forest under any partitioning, and whether equal
rows are grouped (with their number as weight) or not.

A node looks at ``sqrt`` of all features (all of them if there is one tree), those with the smallest md5 of
seed, tree, node and feature.  A numeric column with at most ``bins`` distinct values is split between any two of
them, another one at its quantiles.  Ties go to the lower feature, then to the lower threshold.

The driver holds the trees: (tree, node) rows.  A task holds its counts, at most trees x nodes x features of a node
x bins x classes numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import features as FE
from .kmeans import draw
from .ranks import count_percentiles

#: Upper ends of the Poisson(1) distribution function: a draw above the i-th counts more than i.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
MAX_CLASSES = 100


@dataclass
class Tree:
    """Node 1 is the root, the children of ``i`` are ``2 i`` (at most the threshold) and ``2 i + 1``."""

    splits: dict[int, tuple[int, float, float, float]] = field(default_factory=dict)  # node: slot, threshold, gain, rows
    counts: dict[int, list[float]] = field(default_factory=dict)  # node: rows per class

    def route(self, x: np.ndarray) -> np.ndarray:
        """The node of every row, as far as the tree has grown."""
        at = np.ones(len(x), np.int64)
        for node in sorted(self.splits):
            slot, cut, *_ = self.splits[node]
            here = at == node
            at[here] = 2 * node + (x[here, slot] > cut)
        return at


def thresholds(points: DataFrame, nums: Sequence[str], slots: int, bins: int = 32) -> list[list[float]]:
    """Per feature slot the values it can be split at: numeric columns first, then 0/1 slots."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.col(c).cast("double").alias("v")) for i, c in enumerate(nums)])) if nums else None
    cuts: list[list[float]] = [[] for _ in nums] + [[0.5]] * (slots - len(nums))
    if not nums:
        return cuts
    counts = points.select(pairs.alias("p"), F.col("weight").alias("w")).groupBy("p.slot", "p.v").agg(F.sum("w").cast("bigint").alias("n")).persist()
    sizes = {r.slot: r.m for r in counts.groupBy("slot").agg(F.count(F.lit(1)).alias("m")).collect()}
    few = [s for s, m in sizes.items() if m <= bins]
    values: dict[int, list[float]] = {}
    for r in counts.filter(F.col("slot").isin(few)).collect() if few else []:  # at most bins per column
        values.setdefault(r.slot, []).append(r.v)
    for slot, vs in values.items():
        vs.sort()
        cuts[slot] = [(a + b) / 2 for a, b in zip(vs, vs[1:])]
    if len(few) < len(sizes):
        top = {r.slot: r.v for r in counts.groupBy("slot").agg(F.max("v").alias("v")).collect()}
        for r in count_percentiles(counts.filter(~F.col("slot").isin(few)), "v", "n", [i / bins for i in range(1, bins)], ["slot"]).collect():
            cuts[r.slot] = sorted({q for q in r.q if q < top[r.slot]})
    counts.unpersist()
    return cuts


def _blocks(points: DataFrame, cols: Sequence[str], label: str, trees: int, seed: int, bootstrap: bool) -> DataFrame:
    """``x, y, w``: features, classes and per tree the rows each point stands for, in blocks."""
    text = FE.row_text(points, cols)
    draws = F.array(*[draw(seed, t, text) for t in range(trees)]) if bootstrap else F.array_repeat(F.lit(0.5), trees)
    rows = points.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"), F.col("weight").alias("w"), draws.alias("u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, u = (b.column(i).flatten().to_numpy() for i in (0, 3))
                times = np.searchsorted(POISSON, u, side="left") if bootstrap else np.ones(len(u))
                w = times.reshape(b.num_rows, trees) * b.column(2).to_numpy()[:, None]
                raw = [x.tobytes(), b.column(1).to_numpy().astype(np.int64).tobytes(), w.astype(np.float64).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.binary()) for r in raw], names=["x", "y", "w"])

    return rows.mapInArrow(run, "x binary, y binary, w binary")


def looked_at(seed: int, tree: int, node: int, slots: int, most: int) -> list[int]:
    """The features that a node may split on."""
    order = sorted(range(slots), key=lambda s: hashlib.md5(f"{seed}|{tree}|{node}|{s}".encode()).hexdigest())
    return sorted(order[:most])


def gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of class counts in the last axis."""
    share = counts / np.maximum(counts.sum(-1, keepdims=True), 1e-300)
    return 1.0 - (share * share).sum(-1)


def best_split(hist: np.ndarray, own: list[int], cuts: list[list[float]]) -> tuple[int, int, float, np.ndarray] | None:
    """``slot, bin, gain, rows left per class`` of the best split of one node; ``hist`` is features x bins x classes."""
    best, whole = None, hist[0].sum(0)
    n = whole.sum()
    for f, slot in enumerate(own):
        left = np.cumsum(hist[f], 0)[: len(cuts[slot])]
        right = whole - left
        nl, nr = left.sum(1), right.sum(1)
        gain = np.round(gini(whole) - nl / n * gini(left) - nr / n * gini(right), 12)
        gain[(nl == 0) | (nr == 0)] = -1.0
        if len(gain) and gain.max() > 1e-12 and (best is None or gain.max() > best[2]):
            at = int(gain.argmax())
            best = (slot, at, float(gain[at]), left[at])
    return best


def grow(points: DataFrame, cols: Sequence[str], label: str, nums: Sequence[str], slots: int, trees: int = 10, depth: int = 5, seed: int = 42, bootstrap: bool = True, bins: int = 32) -> tuple[list[Tree], int]:
    """The trees, and the number of classes, of ``points`` (features, ``weight``, label 0, 1, ...)."""
    top = points.agg(F.max(F.col(label).cast("double"))).first()[0]
    if top is None:
        raise ValueError("no rows to fit")
    classes = int(top) + 1
    if classes > MAX_CLASSES:
        raise ValueError(f"labels must be 0 to {MAX_CLASSES - 1}")
    cuts = thresholds(points, nums, slots, bins)
    width = max(len(c) for c in cuts) + 1
    most = slots if trees == 1 else math.ceil(math.sqrt(slots))
    packed = _blocks(points, cols, label, trees, seed, bootstrap).persist()
    forest = [Tree() for _ in range(trees)]
    active = {(t, 1) for t in range(trees)}
    for _ in range(depth):
        if not active:
            break
        looks = {(t, node): looked_at(seed, t, node, slots, most) for t, node in active}

        def count(batches: Iterator[pa.RecordBatch], forest=forest, looks=looks) -> Iterator[pa.RecordBatch]:
            total = {k: np.zeros((len(own), width * classes)) for k, own in looks.items()}
            for b in batches:
                for i in range(b.num_rows):
                    y = np.frombuffer(b.column(1)[i].as_py(), np.int64)
                    x = np.frombuffer(b.column(0)[i].as_py(), np.float64).reshape(len(y), -1)
                    w = np.frombuffer(b.column(2)[i].as_py(), np.float64).reshape(len(y), -1)
                    place = np.column_stack([np.searchsorted(c, x[:, s], side="left") for s, c in enumerate(cuts)]) * classes + y[:, None]
                    for t, tree in enumerate(forest):
                        at = tree.route(x)
                        for node in {n for tt, n in looks if tt == t}:
                            mine = np.flatnonzero((at == node) & (w[:, t] > 0))
                            for f, slot in enumerate(looks[t, node]):
                                total[t, node][f] += np.bincount(place[mine, slot], weights=w[mine, t], minlength=width * classes)
            keys = [k for k, v in total.items() if v.any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)] + [pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["tree", "node", "hist"]
            )

        def choose(batches: Iterator[pa.RecordBatch], looks=looks) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for b in batches:
                for t, node, raw in zip(*(c.to_pylist() for c in b.columns)):
                    part = np.frombuffer(raw, np.float64).reshape(len(looks[t, node]), width, classes)
                    total[t, node] = total[t, node] + part if (t, node) in total else part
            out = []
            for (t, node), hist in total.items():
                found, whole = best_split(hist, looks[t, node], cuts), hist[0].sum(0)
                slot, at, gain, left = found if found else (-1, 0, 0.0, whole)
                out.append((t, node, slot, cuts[slot][at] if found else 0.0, gain, whole.tolist(), left.tolist()))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["tree", "node", "slot", "cut", "gain", "whole", "left"])

        hists = packed.mapInArrow(count, "tree int, node int, hist binary").repartition("tree", "node")
        active = set()
        for r in hists.mapInArrow(choose, "tree int, node int, slot int, cut double, gain double, whole array<double>, left array<double>").collect():
            tree = forest[r.tree]
            tree.counts[r.node] = list(r.whole)
            if r.slot >= 0:
                tree.splits[r.node] = (r.slot, r.cut, r.gain, sum(r.whole))
                tree.counts[2 * r.node], tree.counts[2 * r.node + 1] = list(r.left), [a - b for a, b in zip(r.whole, r.left)]
                active |= {(r.tree, child) for child in (2 * r.node, 2 * r.node + 1) if sum(c > 0 for c in tree.counts[child]) > 1}
    packed.unpersist()
    return forest, classes


@dataclass
class Forest:
    prep: PipelineModel
    trees: list[Tree]
    classes: int
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its features, ``probability`` (mean of the trees' shares) and ``prediction`` (ties to the lower class)."""
        out = self.prep.transform(df).withColumn("__p", shares(self.trees, self.classes))
        return out.withColumn("probability", array_to_vector("__p")).withColumn("prediction", (F.array_position("__p", F.array_max("__p")) - 1).cast("double")).drop("__p")

    def splits(self, spark) -> DataFrame:
        """``tree, node, slot, feature, threshold, gain, n_rows``: one row per split."""
        rows = [(t, n, s[0], self.names[s[0]], s[1], s[2], s[3]) for t, tree in enumerate(self.trees) for n, s in sorted(tree.splits.items())]
        return spark.createDataFrame(rows, "tree int, node int, slot int, feature string, threshold double, gain double, n_rows double")


def shares(trees: list[Tree], classes: int, features: str = "features") -> Column:
    """Per row the mean of the trees' class shares; other columns stay in the JVM."""
    leaves = []
    for tree in trees:
        counts = {n: np.array(c) for n, c in tree.counts.items()}
        leaves.append({n: c / c.sum() for n, c in counts.items() if c.sum()})

    @F.arrow_udf("array<double>")
    def share(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy().reshape(len(x), -1) if len(x) else np.zeros((0, 1))
        total = np.zeros((len(rows), classes))
        for tree, leaf in zip(trees, leaves):
            at = tree.route(rows)
            for node in np.unique(at):
                if node in leaf:
                    total[at == node] += leaf[node]
        total /= np.maximum(total.sum(1, keepdims=True), 1e-300)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * classes), pa.array(total.ravel()))

    return share(vector_to_array(F.col(features)))


def importances(splits: DataFrame, by: str = "feature") -> DataFrame:
    """``by, importance`` from the table of splits: gain times rows, each tree's shares summing to one, then the mean over trees."""
    gains = splits.groupBy("tree", by).agg(F.sum(F.col("gain") * F.col("n_rows")).alias("g"))
    whole = splits.groupBy("tree").agg(F.sum(F.col("gain") * F.col("n_rows")).alias("w"))
    trees = whole.agg(F.count(F.lit(1)).alias("trees")).scalar()
    return gains.join(F.broadcast(whole), "tree").groupBy(by).agg((F.sum(F.col("g") / F.col("w")) / F.max(trees)).alias("importance"))
