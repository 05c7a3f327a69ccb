"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration (operator 10).

Every text becomes a row of statistics (lengths, repetition, symbols, case, layout).  They
are standardised and mapped to ``features`` cosines that approximate a Gaussian kernel.  Each
partition of the labelled rows sums its part of the normal equations, groups of partitions
are added up, and the driver solves one system of ``features + 1`` unknowns.  Scores of a
second fold of labelled rows, binned, are calibrated by pooling adjacent violators.

Learning uses only labelled rows whose ``crc32(doc_id) mod 5`` is not 0: remainders 1
to 3 fit the ridge, 4 the calibration (all of them both where one fold lacks a label).  At most
``max_rows`` rows by hash order are fitted, a documented bound of the sample; every row is
scored.  Inputs are the text's statistics alone.

Nulls and ties: a null or empty text has all statistics zero and is scored; a null
``doc_id`` is not held out and never labelled; labels with a null id or quality are
ignored, and of two labels for one id the larger counts; repeated rows score alike; without
both classes every score is the share of good labels (0.5 without any); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary, col, written

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
BINS = 1000
MAX_ROWS = 200_000
SEED = 42
THRESHOLD = 0.3

_SYMBOL = re.compile(rb"[#*$%&|<>{}@~^=+_\\/]")
_MARK = re.compile(rb"[!?]")
_STOP = re.compile(rb"[.,;:]")
_DIGIT = re.compile(rb"[0-9]")
_UPPER = re.compile(rb"[A-Z]")
_LOWER = re.compile(rb"[a-z]")
N_STATS = 17


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one whole text."""
    words = text.split() if text else []
    if not words:
        return [0.0] * N_STATS
    n, size = len(words), len(text)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split(b"\n") if x.strip()]
    length = np.fromiter(map(len, words), np.float64, n)
    symbols, marks = len(_SYMBOL.findall(text)), len(_MARK.findall(text))
    upper, lower = len(_UPPER.findall(text)), len(_LOWER.findall(text))
    marked = sum(1 for w in words if w[-1:] in b"#*$%&!|")
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        np.log1p(n), np.log1p(len(lines)), np.log1p(n / len(lines)),
        length.mean(), length.std(), float(min(length.max(), 100.0)),
        len(counts) / n, pairs / max(1, n - 1), max(counts.values()) / n, same / n,
        len(set(lines)) / len(lines), symbols / size, marks / size, len(_STOP.findall(text)) / n,
        len(_DIGIT.findall(text)) / size, upper / max(1, upper + lower), marked / n,
    ]


def fold(doc_id: Column) -> Column:
    """``crc32(doc_id as text) mod 5``; null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 5).cast("int")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # None: constant
    edges: np.ndarray  # upper ends of the calibrated steps
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return design(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.values[0])
        return np.clip(np.interp(self.raw(x), self.edges, self.values), 0.0, 1.0)


def design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, 1.0 / WIDTH, (x.shape[1], FEATURES))
    b = rng.uniform(0.0, 2 * np.pi, FEATURES)
    z = np.sqrt(2.0 / FEATURES) * np.cos(np.clip((x - mean) / scale, -8, 8) @ w + b)
    return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def _summed(rows: DataFrame, part, size: int) -> np.ndarray:
    """The sum over partitions of ``part(batches) -> array of size``, added up in groups before the driver."""

    def each(batches: Iterator[pa.RecordBatch]):
        total = part(batches)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def add(tables: Iterator[pa.RecordBatch]):
        total = np.zeros(size)
        for b in tables:
            for s in b.column(0).to_pylist():
                total += np.frombuffer(s)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    groups = rows.mapInArrow(each, "s binary").repartition(8).mapInArrow(add, "s binary").collect()  # 8 sums of `size` numbers
    return sum((np.frombuffer(r["s"]) for r in groups), np.zeros(size))


def _xy(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(b.column(0).to_pylist(), np.float64).reshape(-1, N_STATS)
    return x, b.column(1).to_numpy().astype(np.float64)


def pooled(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic means of bins with counts n and sums total (pooling adjacent violators)."""
    stack: list[list[float]] = []
    for c, s in zip(n, total):
        stack.append([c, s, 1])
        while len(stack) > 1 and stack[-2][1] * stack[-1][0] >= stack[-1][1] * stack[-2][0]:
            c2, s2, k2 = stack.pop()
            stack[-1] = [stack[-1][0] + c2, stack[-1][1] + s2, stack[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / c) for c, s, k in stack])


def fit(stats: DataFrame) -> Model:
    """Fit ``stats (x array<double>, y double, fold int)``; only sums and bins reach the driver."""
    counts = {(r["fold"], r["y"]): r["count"] for r in stats.groupBy("fold", "y").count().collect()}  # at most 8 rows
    good, total = sum(v for k, v in counts.items() if k[1] == 1.0), sum(counts.values())
    if good in (0, total):
        share = good / total if total else 0.5
        return Model(np.zeros(N_STATS), np.ones(N_STATS), None, np.zeros(1), np.array([float(share)]))
    both = all(any(counts.get((f, y), 0) for f in folds) for folds in ((1, 2, 3), (4,)) for y in (0.0, 1.0))
    train, check = (stats.filter("fold <> 4"), stats.filter("fold = 4")) if both else (stats, stats)

    def moments(batches):
        out = np.zeros(1 + 2 * N_STATS)
        for b in batches:
            x, _ = _xy(b)
            out += np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
        return out

    m = _summed(train.select("x", "y"), moments, 1 + 2 * N_STATS)
    mean = m[1 : 1 + N_STATS] / m[0]
    scale = np.sqrt(np.maximum(m[1 + N_STATS :] / m[0] - mean**2, 0.0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    # Both classes weigh the same in the ridge; the calibration restores their shares.
    n1 = sum(v for k, v in counts.items() if k[1] == 1.0 and (k[0] != 4 or not both))
    n0 = m[0] - n1
    d = FEATURES + 1

    def equations(batches):
        a, r = np.zeros((d, d)), np.zeros(d)
        for b in batches:
            x, y = _xy(b)
            z = design(x, mean, scale)
            w = np.where(y == 1.0, 0.5 / n1, 0.5 / n0)
            a += z.T @ (z * w[:, None])
            r += z.T @ (w * y)
        return np.concatenate([a.ravel(), r])

    s = _summed(train.select("x", "y"), equations, d * d + d)
    weights = np.linalg.solve(s[: d * d].reshape(d, d) + RIDGE * np.eye(d), s[d * d :])
    model = Model(mean, scale, weights, np.zeros(1), np.zeros(1))

    def bins(batches):
        out = np.zeros((2, BINS))
        for b in batches:
            x, y = _xy(b)
            at = np.clip(np.floor((model.raw(x) + 0.5) * BINS / 2), 0, BINS - 1).astype(int)
            np.add.at(out, (0, at), 1.0)
            np.add.at(out, (1, at), y)
        return out.ravel()

    n, total = _summed(check.select("x", "y"), bins, 2 * BINS).reshape(2, BINS)
    here = np.flatnonzero(n)
    model.edges = (here + 0.5) * 2 / BINS - 0.5
    model.values = pooled(n[here], total[here])
    return model


def scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    text = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("t"))

    def measure(batches):
        for b in batches:
            x = [statistics(t) for t in binary(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    kind = text.schema["doc_id"].dataType
    stats = written(text.mapInArrow(measure, T.StructType().add("doc_id", kind).add("x", T.ArrayType(T.DoubleType()))), "statistics")
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    known = known.withColumn("fold", fold(F.col("doc_id"))).filter("fold <> 0")
    if known.count() > max_rows:  # the documented bound of the labelled sample
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    model = fit(written(stats.join(known, "doc_id").select("x", "y", "fold"), "labelled"))

    def judge(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    out = stats.mapInArrow(judge, T.StructType().add("doc_id", kind).add("score", "double"))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
