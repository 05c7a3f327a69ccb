"""Feature preparation (M1-M5): string indexing, one-hot encoding, a
content-hash train/test split, vector assembly and the preparation pipeline.

All of these are Spark ML stages or column expressions.  Fitting a
``StringIndexer`` is one distributed count per column; the label list it
returns to the driver is bounded by the number of distinct labels (the model).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDX, VEC = "_idx", "_vec"


def index_strings(cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """M1: one multi-column indexer, most frequent label first, ties alphabetical.

    ``handle_invalid="keep"`` maps unseen or null labels to an extra index, so
    an indexer fitted on the training split never fails on test rows.
    """
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[c + IDX for c in cols],
        stringOrderType="frequencyDesc",
        handleInvalid=handle_invalid,
    )


def one_hot(cols: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """M2: one-hot encode the indexed columns (last category dropped by default)."""
    return OneHotEncoder(inputCols=[c + IDX for c in cols], outputCols=[c + VEC for c in cols], dropLast=drop_last)


def assemble(nums: Sequence[str], cats: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """M4: numeric columns followed by the one-hot vectors of the categorical columns."""
    return VectorAssembler(inputCols=list(nums) + [c + VEC for c in cats], outputCol=out, handleInvalid=handle_invalid)


def feature_pipeline(nums: Sequence[str], cats: Sequence[str], out: str = "features") -> Pipeline:
    """M5: indexer -> encoder -> assembler, fitted once and applied to train and test."""
    return Pipeline(stages=[index_strings(cats), one_hot(cats), assemble(nums, cats, out)])


def _six_decimals(x: Column) -> Column:
    """``%.6f`` of a double; a whole number, not zero (which has a sign), is written without the slow formatter."""
    whole = x.try_cast("bigint")
    plain = (x != 0) & (F.abs(x) < 1e15) & (whole.cast("double") == x)
    return F.when(plain, F.concat(whole.cast("string"), F.lit(".000000"))).otherwise(F.format_string("%.6f", x))


def row_text(df: DataFrame, cols: Sequence[str] | None = None, sep: str = "|", null: str = "~") -> Column:
    """A fixed text form of a row: values joined by ``sep``, nulls as ``null``.

    Floating-point values are written with six decimals, because engines
    disagree on the shortest text of a double.
    """
    parts = []
    for c in cols or df.columns:
        dt = df.schema[c].dataType
        x = F.col(c)
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            txt = _six_decimals(x.cast("double"))
        else:
            txt = x.cast("string")
        parts.append(F.coalesce(txt, F.lit(null)))
    return F.concat_ws(sep, *parts)


def hash_bucket(df: DataFrame, seed: int = 42, cols: Sequence[str] | None = None, buckets: int = 1000) -> Column:
    """A bucket in ``[0, buckets)`` from the md5 of the seed and the row's text."""
    text = F.concat_ws("|", F.lit(str(seed)), row_text(df, cols))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def hash_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42, cols: Sequence[str] | None = None
) -> list[DataFrame]:
    """M3: a reproducible split by content hash (unlike ``randomSplit``).

    A row's side depends only on its values and the seed, so the split is the
    same under any partitioning, caching or re-planning; identical rows go to
    the same side (pass key ``cols`` to split them apart).  Narrow: each side
    is a filter over the input.
    """
    total = float(sum(weights))
    edges, acc = [], 0.0
    for w in weights:
        acc += w
        edges.append(int(round(1000 * acc / total)))
    b = hash_bucket(df, seed, cols)
    out, lo = [], 0
    for hi in edges:
        # A filter hashes the row once per bound: the bounds that every bucket keeps are left out.
        bounds = [b >= lo] * (lo > 0) + [b < hi] * (hi < 1000)
        out.append(df.filter(reduce(and_, bounds)) if bounds else df)
        lo = hi
    return out


def with_split_label(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42, names=("train", "test")) -> DataFrame:
    """The split as a column (``split``) instead of separate frames."""
    total = float(sum(weights))
    b = hash_bucket(df, seed)
    expr, acc = None, 0.0
    for w, name in zip(weights, names):
        acc += w
        cond = b < int(round(1000 * acc / total))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("split", expr)


def stable_layout(df: DataFrame, partitions: int, seed: int = 42) -> DataFrame:
    """A fixed partitioning and in-partition order keyed by row content.

    Spark ML fits (forest bootstraps, k-means initialisation) depend on the
    row layout as well as the seed; this layout makes them repeatable across
    core counts.  Costs one shuffle; use only where repeatability matters.
    """
    key = F.md5(row_text(df))
    return df.withColumn("__k", key).repartition(partitions, "__k").sortWithinPartitions("__k").drop("__k")


def vector_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    size = meta.get("num_attrs", 0)
    names = [f"{col}_{i}" for i in range(size)]
    for group in attrs.values():
        for a in group:
            if a["idx"] >= len(names):
                names.extend(f"{col}_{i}" for i in range(len(names), a["idx"] + 1))
            names[a["idx"]] = a.get("name", names[a["idx"]])
    return names


def source_of(slot_name: str, inputs: Sequence[str]) -> str:
    """The assembler input column a slot came from (longest matching prefix)."""
    best = slot_name
    for c in sorted(inputs, key=len, reverse=True):
        base = c[: -len(VEC)] if c.endswith(VEC) else c
        if slot_name == c or slot_name.startswith(c + "_") or slot_name == base:
            return base
    return best


def weighted_distinct(df: DataFrame, cols: Sequence[str], weight: str = "weight") -> DataFrame:
    """Distinct rows of ``cols`` with their multiplicity as a double ``weight``.

    For discrete feature spaces the distinct rows are bounded by the domain,
    not by the row count, so a model fitted on them (with ``weightCol``) does
    one pass over the data instead of one per iteration.  Weighted least
    squares on this table has exactly the normal equations of the full table;
    k-means has the same objective.  The aggregate is combined map-side, so a
    hot feature row costs one row per map task.
    """
    return df.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias(weight))


def index_from_weights(points: DataFrame, cols: Sequence[str], weight: str = "weight", handle_invalid: str = "keep"):
    """M1 on a weighted table: labels ordered by total weight desc, then label.

    Returns one fitted ``StringIndexerModel`` per column.

    Gives the same label order as :func:`index_strings` fitted on the
    unweighted rows, without another pass over them.  Only the label lists
    (bounded by the distinct labels) reach the driver.
    """
    from pyspark.ml.feature import StringIndexerModel

    stacked = None
    for c in cols:
        part = points.groupBy(F.lit(c).alias("__c"), F.col(c).cast("string").alias("__v")).agg(F.sum(weight).alias("__w"))
        stacked = part if stacked is None else stacked.unionByName(part)
    rows = stacked.filter(F.col("__v").isNotNull()).collect()
    labels = {c: [] for c in cols}
    for r in sorted(rows, key=lambda r: (r["__c"], -r["__w"], r["__v"])):
        labels[r["__c"]].append(r["__v"])
    # One single-column model per input: PySpark pads ragged multi-column label
    # arrays with nulls.
    return [
        StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=c + IDX, handleInvalid=handle_invalid) for c in cols
    ]


def fit_weighted_preparation(points: DataFrame, nums: Sequence[str], cats: Sequence[str], out: str = "features", weight: str = "weight"):
    """M5 on a weighted table: the fitted indexer -> encoder -> assembler pipeline."""
    from pyspark.ml import PipelineModel

    if not cats:
        return PipelineModel(stages=[assemble(nums, cats, out)])
    indexers = index_from_weights(points, cats, weight)
    indexed = PipelineModel(stages=indexers).transform(points)
    encoder = one_hot(cats).fit(indexed)
    return PipelineModel(stages=[*indexers, encoder, assemble(nums, cats, out)])


def vector_sums(df: DataFrame, col: str = "features") -> DataFrame:
    """M4 check: the total of every slot of an assembled vector, by slot name.

    One aggregate with one sum per slot (the slot count comes from the
    column's metadata), then unpivoted: ``slot int, feature string, total double``.
    """
    from pyspark.ml.functions import vector_to_array

    names = vector_names(df, col)
    arr = vector_to_array(F.col(col))
    sums = df.select(arr.alias("__a")).agg(*[F.sum(F.col("__a")[i]).alias(f"s{i}") for i in range(len(names))])
    entries = ", ".join(f"{i}, '{n.replace(chr(39), chr(39) * 2)}', s{i}" for i, n in enumerate(names))
    return sums.selectExpr(f"stack({len(names)}, {entries}) AS (slot, feature, total)").select(
        F.col("slot").cast("int").alias("slot"), "feature", F.col("total").cast("double").alias("total")
    )
