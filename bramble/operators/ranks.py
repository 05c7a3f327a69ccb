"""Exact percentiles without a task that holds all values.

``percentile`` merges one map of every distinct value into a single task per group.
Here the values' counts are range-partitioned instead: each partition's total gives
the rank it starts at, and only the partitions that hold a wanted rank are summed
value by value.  The largest piece of work is one range partition, however many
values a group has and however hot it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import materialize


def count_percentiles(counts: DataFrame, value: str, n: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``*by, q``: the percentiles of ``value``, each row standing for ``n`` rows (linear interpolation).

    ``counts`` has one row per group and value, without nulls; a group without rows
    has no row in the result.
    """
    by = list(by)
    ranged = counts.select(*by, F.col(value).cast("double").alias("__v"), F.col(n).alias("__n")).repartitionByRange(*by, "__v")
    ranged = materialize(ranged.withColumn("__part", F.spark_partition_id()))
    # One row per group and partition from here to ``starts``.
    parts = ranged.groupBy(*by, "__part").agg(F.sum("__n").alias("__s"))
    group = Window.partitionBy(*by)
    parts = parts.withColumn("__total", F.sum("__s").over(group))
    parts = parts.withColumn("__base", F.sum("__s").over(group.orderBy("__part")) - F.col("__s"))
    at = [F.lit(float(p)) * (F.col("__total") - 1) for p in probs]
    wanted = F.array_distinct(F.array(*[f(x).cast("bigint") for x in at for f in (F.floor, F.ceil)]))
    here = F.filter(wanted, lambda r: (r >= F.col("__base")) & (r < F.col("__base") + F.col("__s")))
    starts = parts.select(*by, "__part", "__base", "__total", here.alias("__ranks")).filter(F.size("__ranks") > 0)
    inside = ranged.join(starts, [*by, "__part"])
    upto = F.col("__base") + F.sum("__n").over(Window.partitionBy(*by, "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("__upto", upto)
    mine = F.filter("__ranks", lambda r: (r >= F.col("__upto") - F.col("__n")) & (r < F.col("__upto")))
    found = inside.select(*by, "__v", "__total", F.explode(mine).alias("__r"))
    # At most two ranks per probability and group.
    found = found.groupBy(*by).agg(F.first("__total").alias("__total"), F.map_from_entries(F.collect_list(F.struct("__r", "__v"))).alias("__m"))
    low = [F.element_at("__m", F.floor(x).cast("bigint")) for x in at]
    high = [F.element_at("__m", F.ceil(x).cast("bigint")) for x in at]
    q = F.array(*[a + (b - a) * (x - F.floor(x)) for a, b, x in zip(low, high, at)])
    return found.select(*by, q.alias("q"))


def column_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``column, q`` of several numeric columns, counted in one pass; an all-null column has no row."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    long = df.select(pairs.alias("__p")).select("__p.column", "__p.value").filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return count_percentiles(counts, "value", "n", probs, ["column"])
