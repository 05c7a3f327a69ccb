"""Descriptive statistics (A1-A13) as Spark aggregates.

Design rules followed throughout:

* every statistic is computed by a distributed aggregate with map-side partial
  aggregation, so a hot key or a hot value never lands whole in one task;
* constants that a later step needs (min, max, quartiles, bandwidth) are
  folded into the plan as scalar subqueries (``DataFrame.scalar()``), never
  collected to the driver;
* per-group statistics are joined back through :func:`lookup_join`, which
  broadcasts only below a checked row count;
* results are small, typed DataFrames; nothing is plotted.

Exact percentiles come from range-partitioned value counts (:mod:`.ranks`), so no
task holds all values; ``method="approx"`` uses the bounded ``percentile_approx`` sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import lookup_join, materialize
from .ranks import column_percentiles, count_percentiles

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _approx(x: Column, probs: Sequence[float], accuracy: int) -> Column:
    return F.percentile_approx(x, F.array(*[F.lit(float(p)) for p in probs]), accuracy).cast("array<double>")


def _check_method(method: str) -> None:
    if method not in ("exact", "approx"):
        raise ValueError("method must be 'exact' or 'approx'")


# --------------------------------------------------------------------------- A1, S5


def describe_all(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: count, mean, sample stddev, min, max of every column, in one pass.

    Long form, one row per column: ``column, count, mean, stddev, min, max``.
    ``mean``/``stddev`` are null for non-numeric columns; ``min``/``max`` are
    rendered as text so string and numeric columns share one table.
    """
    cols = list(cols or df.columns)
    aggs, entries = [], []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs.append(F.count(x).alias(f"n{i}"))
        if is_numeric(df, c):
            aggs.append(F.avg(x).cast("double").alias(f"m{i}"))
            aggs.append(F.stddev_samp(x).cast("double").alias(f"s{i}"))
        else:
            aggs.append(F.lit(None).cast("double").alias(f"m{i}"))
            aggs.append(F.lit(None).cast("double").alias(f"s{i}"))
        aggs.append(F.min(x).cast("string").alias(f"lo{i}"))
        aggs.append(F.max(x).cast("string").alias(f"hi{i}"))
        entries.append(f"{_sql_str(c)}, n{i}, m{i}, s{i}, lo{i}, hi{i}")
    return df.agg(*aggs).selectExpr(
        f"stack({len(cols)}, {', '.join(entries)}) AS (`column`, `count`, `mean`, `stddev`, `min`, `max`)"
    )


def shape(df: DataFrame) -> DataFrame:
    """One row ``n_rows bigint, n_cols int``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def preview(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (top-n per partition, then merge)."""
    keys = list(order_by or df.columns)
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


# --------------------------------------------------------------------------- A2


def summarize(df: DataFrame, cols: Sequence[str], method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """A2: count, mean, sample std, min, 25/50/75% (linear interpolation), max.

    One aggregate over all columns, unpivoted to one row per column:
    ``column, count, mean, std, min, p25, p50, p75, max``.  Exact percentiles take one
    more pass, which counts the values of all columns.
    """
    _check_method(method)
    probs = (0.25, 0.5, 0.75)
    aggs, entries = [], []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            (_approx(x, probs, accuracy) if method == "approx" else F.lit(None).cast("array<double>")).alias(f"q{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
        entries.append(f"{_sql_str(c)}, n{i}, m{i}, s{i}, lo{i}, q{i}, hi{i}")
    out = df.agg(*aggs).selectExpr(f"stack({len(cols)}, {', '.join(entries)}) AS (`column`, `count`, `mean`, `std`, `min`, `q`, `max`)")
    if method == "exact":
        out = out.drop("q").join(column_percentiles(df, cols, probs), "column", "left")
    at = [F.col("q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return out.select("column", "count", "mean", "std", "min", *at, "max")


def counted_sets(df: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Rows per combination of each column set, in one pass: ``set_no, *columns, n``.

    One aggregate with grouping sets (combined map-side, so each task sends at most the distinct
    combinations); columns outside a row's set are null, and so are missing values inside it.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(F.grouping_id().alias("__id"), F.count(F.lit(1)).alias("n"))
    ids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets]
    number = F.coalesce(*[F.when(F.col("__id") == i, F.lit(no)) for no, i in enumerate(ids)])
    return out.select(number.alias("set_no"), *cols, "n")


def summarize_counts(counts: DataFrame, quartiles: DataFrame) -> DataFrame:
    """A2 from ``column, value, n`` and ``column, q``: the same table as :func:`summarize`."""
    n, v = F.col("n").cast("double"), F.col("value")
    means = counts.groupBy("column").agg((F.sum(n * v) / F.sum(n)).alias("mean"))
    spread = F.sum(n * (v - F.col("mean")) * (v - F.col("mean")))
    out = counts.join(F.broadcast(means), "column").groupBy("column", "mean").agg(
        F.sum("n").alias("count"), F.sqrt(F.try_divide(spread, F.sum(n) - 1)).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    at = [F.col("q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return out.join(F.broadcast(quartiles), "column").select("column", "count", "mean", "std", "min", *at, "max")


# --------------------------------------------------------------------------- A3


def _auto_bin_count(n: Column, lo: Column, hi: Column, q1: Column, q3: Column, integral: bool) -> Column:
    """NumPy's 'auto' rule: the smaller of the Sturges and Freedman-Diaconis widths
    (at least 1 for integer data)."""
    ptp = hi - lo
    sturges = ptp / (F.log2(n.cast("double")) + F.lit(1.0))
    fd = F.lit(2.0) * (q3 - q1) * F.pow(n.cast("double"), F.lit(-1.0 / 3.0))
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    if integral:
        width = F.when((width > 0) & (width < 1), F.lit(1.0)).otherwise(width)
    return F.when((ptp > 0) & (width > 0), F.ceil(ptp / width)).otherwise(F.lit(1)).cast("int")


def histogram(df: DataFrame, c: str, bins: int | str = "auto", weight: str | None = None) -> DataFrame:
    """A3: equal-width histogram with NumPy's edge rule; empty bins are kept.

    Edges are ``linspace(min, max, nbins + 1)`` (``min - 0.5, max + 0.5`` for a
    constant column).  Every bin is half-open except the last, which is closed.
    ``bins`` is an integer or ``"auto"`` (NumPy's rule); with ``weight`` a row stands for that many.
    Output: ``bin int, bin_lo double, bin_hi double, count bigint``.

    Plan: one global aggregate gives the range (and, for ``"auto"``, the value counts
    the quartiles) as a one-row frame, materialised once; the bin list is derived from it; the data side reads
    it once per row through a single scalar subquery and is reduced by a
    grouped count (at most ``nbins`` rows leave each map task); the two small
    sides are joined on the bin id.
    """
    integral = isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    one = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    data = df.select(F.col(c).cast("double").alias("x"), one.alias("w")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    stat_cols = [F.coalesce(F.sum("w"), F.lit(0)).alias("n"), F.min("x").alias("lo0"), F.max("x").alias("hi0")]
    raw = data.agg(*stat_cols)
    if bins == "auto":
        quartiles = count_percentiles(data.groupBy("x").agg(F.sum("w").alias("n")), "x", "n", (0.25, 0.75))
        raw = raw.withColumn("q", quartiles.scalar())
    const = F.col("lo0") == F.col("hi0")
    if bins == "auto":
        nb = F.when(const, F.lit(1)).otherwise(
            _auto_bin_count(F.col("n"), F.col("lo0"), F.col("hi0"), F.col("q")[0], F.col("q")[1], integral)
        )
    else:
        nb = F.lit(int(bins))
    params = materialize(
        raw.select(
            F.when(const, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
            F.when(const, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"),
            nb.cast("int").alias("nb"),
        )
    )

    def edge(k: Column, p: str = "") -> Column:
        lo, hi, n = F.col(f"{p}lo"), F.col(f"{p}hi"), F.col(f"{p}nb")
        return F.when(k >= n, hi).otherwise(lo + k.cast("double") * ((hi - lo) / n))

    p = "__p."
    x = F.col("x")
    withp = data.select("x", "w", params.select(F.struct("lo", "hi", "nb")).scalar().alias("__p"))
    lo, hi, n = F.col(p + "lo"), F.col(p + "hi"), F.col(p + "nb")
    idx0 = F.least(F.greatest(F.floor((x - lo) / (hi - lo) * n).cast("int"), F.lit(0)), n - 1)
    idx1 = F.when(x < edge(idx0, p), idx0 - 1).otherwise(idx0)
    idx = F.when((x >= edge(idx1 + 1, p)) & (idx1 != n - 1), idx1 + 1).otherwise(idx1)
    counts = withp.groupBy(idx.alias("bin")).agg(F.sum("w").alias("count"))
    # Bins are rows: their number (one integer on the driver) can pass what one array holds.
    total = (params.select("nb").first() or [0])[0]
    all_bins = df.sparkSession.range(total or 0).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(params))
    out = all_bins.join(counts, "bin", "left")
    return out.select(
        F.col("bin").cast("int").alias("bin"),
        edge(F.col("bin")).alias("bin_lo"),
        edge(F.col("bin") + 1).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


# --------------------------------------------------------------------------- A4


def kde_error(resolution: int, bandwidth: float, tail: float = 6.0) -> float:
    """How far :func:`kde` with this resolution can be from the sum of all kernels, at any point.

    Linear binning moves a value between two bins ``bandwidth / resolution`` apart, which changes its kernel by at
    most an eighth of the squared step times the kernel's largest second derivative; kernels are
    left out beyond ``tail`` bandwidths.
    """
    peak = 1.0 / (math.sqrt(2.0 * math.pi) * bandwidth)
    return peak * (1.0 / (8.0 * resolution * resolution) + math.exp(-0.5 * (tail - 1.0 / resolution) ** 2))


def kde(
    df: DataFrame,
    c: str,
    grid: int = 200,
    cut: float = 0.0,
    bw_adjust: float = 1.0,
    resolution: int | None = 50,
    weight: str | None = None,
    tail: float = 6.0,
) -> DataFrame:
    """A4: Gaussian kernel density on an evenly spaced grid (Scott's bandwidth).

    ``bandwidth = stddev_samp * n^(-1/5) * bw_adjust``; the grid spans
    ``[min - cut*bw, max + cut*bw]`` in ``grid`` points.  Every value is shared between the two nearest of
    bins ``bandwidth / resolution`` apart (linear binning), and each bin adds its kernel to the grid points within ``tail``
    bandwidths; :func:`kde_error` bounds what that changes.  So the rows after the first aggregate are at most
    the bins, whatever the number of distinct values, and each meets only the points near it.  With ``resolution=None`` every
    distinct value has its own kernel and meets every point: exact, for columns of few values.
    With ``weight`` a row stands for that many.  A constant column has no bandwidth: its points coincide and the density is null.
    Output: ``point int, x double, density double``.
    """
    one = F.col(weight).cast("double") if weight else F.lit(1.0)
    data = df.select(F.col(c).cast("double").alias("v"), one.alias("w")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    if resolution is None:
        data = data.groupBy("v").agg(F.sum("w").alias("w"))
    n, mean = F.sum("w"), F.sum(F.col("w") * F.col("v")) / F.sum("w")
    if weight is None and resolution is not None:
        spread = F.stddev_samp("v")
        st = data.agg(n.alias("n"), spread.alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    else:
        centre = data.agg(mean.alias("m")).scalar()
        gap = F.col("v") - F.col("m")
        st = data.withColumn("m", centre).agg(
            n.alias("n"), F.sqrt(F.try_divide(F.sum(F.col("w") * gap * gap), n - 1)).alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )
    bw = F.col("sd") * F.pow(F.col("n"), F.lit(-0.2)) * F.lit(float(bw_adjust))
    params = materialize(
        st.select(
            "n",
            "lo",
            bw.alias("bw"),
            (F.col("lo") - F.lit(float(cut)) * bw).alias("gmin"),
            (F.col("hi") + F.lit(float(cut)) * bw).alias("gmax"),
        )
    )
    last = grid - 1

    def grid_x(g: Column, p: str = "") -> Column:
        gmin, gmax = F.col(f"{p}gmin"), F.col(f"{p}gmax")
        return F.when(g == last, gmax).otherwise(gmin + g.cast("double") * ((gmax - gmin) / F.lit(float(last))))

    every = params.select(F.struct("bw", "lo", "gmin", "gmax")).scalar()
    if resolution is None:
        near = F.sequence(F.lit(0), F.lit(last))
        binned = data.select("v", "w", every.alias("__p"))
    else:
        step = F.col("__p.bw") / F.lit(float(resolution))
        at = F.try_divide(F.col("v") - F.col("__p.lo"), step)
        shared = data.withColumn("__p", every).filter(step > 0).select("w", F.floor(at).alias("bin"), (at - F.floor(at)).alias("part"))
        shared = shared.groupBy("bin").agg(F.sum(F.col("w") * (1 - F.col("part"))).alias("a"), F.sum(F.col("w") * F.col("part")).alias("b"))
        both = shared.select("bin", F.col("a").alias("w")).unionByName(shared.select(F.col("bin") + 1, F.col("b")).toDF("bin", "w"))
        binned = both.groupBy("bin").agg(F.sum("w").alias("w")).filter("w > 0").withColumn("__p", every)
        binned = binned.select((F.col("__p.lo") + F.col("bin") * step).alias("v"), "w", "__p")
        space = (F.col("__p.gmax") - F.col("__p.gmin")) / F.lit(float(last))
        first = F.greatest(F.ceil((F.col("v") - F.lit(tail) * F.col("__p.bw") - F.col("__p.gmin")) / space), F.lit(0)).cast("int")
        final = F.least(F.floor((F.col("v") + F.lit(tail) * F.col("__p.bw") - F.col("__p.gmin")) / space), F.lit(last)).cast("int")
        near = F.when(first <= final, F.sequence(first, final))
    pts = binned.select("v", "w", "__p", F.explode(near).alias("point"))
    z = F.try_divide(grid_x(F.col("point"), "__p.") - F.col("v"), F.col("__p.bw"))
    dens = pts.groupBy("point").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    grid_pts = params.select("n", "bw", "gmin", "gmax", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("point"))
    out = grid_pts.join(dens, "point", "left")
    return out.select(
        F.col("point").cast("int").alias("point"),
        grid_x(F.col("point")).alias("x"),
        F.try_divide(F.coalesce(F.col("s"), F.lit(0.0)), F.col("n") * F.col("bw") * F.lit(math.sqrt(2.0 * math.pi))).alias("density"),
    )


# --------------------------------------------------------------------------- A5, A6, A10, A11


def value_counts(df: DataFrame, c: str, order: str = "count", dropna: bool = True) -> DataFrame:
    """``c, count`` per value; ``order="count"`` (desc, then value) or ``"value"``."""
    src = df.filter(F.col(c).isNotNull()) if dropna else df
    out = src.groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    if order == "count":
        return out.orderBy(F.desc("count"), F.asc_nulls_last(c))
    if order == "value":
        return out.orderBy(F.asc_nulls_last(c))
    raise ValueError("order must be 'count' or 'value'")


def value_counts_many(df: DataFrame, cols: Sequence[str], dropna: bool = True) -> DataFrame:
    """A5/A6 for several columns in one pass: ``column, value (text), count``.

    Each row contributes one ``(column, value)`` pair per column; a single
    grouped count (combined map-side, so at most distinct-values rows per task)
    covers every column.  Use :func:`split_value_counts` to get one typed
    frame per column.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    long = df.select(pairs.alias("__p")).select("__p.column", "__p.value")
    if dropna:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def split_value_counts(long: DataFrame, df: DataFrame, c: str, order: str = "count") -> DataFrame:
    """One column's typed ``c, count`` frame from :func:`value_counts_many`'s output."""
    out = long.filter(F.col("column") == F.lit(c)).select(F.col("value").cast(df.schema[c].dataType).alias(c), "count")
    if order == "count":
        return out.orderBy(F.desc("count"), F.asc_nulls_last(c))
    return out.orderBy(F.asc_nulls_last(c))


def group_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A10: rows per group, ``*by, count``."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def group_means(df: DataFrame, by: Sequence[str] | str, cols: Sequence[str], prefix: str = "avg_") -> DataFrame:
    """The mean of each column per group, each aliased by name (never by position)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*[F.avg(F.col(c).cast("double")).alias(f"{prefix}{c}") for c in cols])


# --------------------------------------------------------------------------- A7, A13


def pivot_counts(df: DataFrame, rows: str, cols: str, values: Sequence | None = None, fill: int | None = None) -> DataFrame:
    """Counts per (rows, cols) pair as a wide table, one column per ``cols`` value.

    Passing ``values`` avoids the extra job Spark runs to discover them, and
    restricts the table to them: rows of any other value are left out.
    Absent pairs are null, or ``fill`` when given.
    """
    src = df.filter(F.col(rows).isNotNull() & F.col(cols).isNotNull())
    grouped = src.groupBy(rows)
    piv = grouped.pivot(cols, list(values)) if values is not None else grouped.pivot(cols)
    out = piv.agg(F.count(F.lit(1)))
    if fill is not None:
        out = out.fillna(fill, subset=[c for c in out.columns if c != rows])
    return out


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table with zeros for absent pairs; rows with a null in either key are left out."""
    return pivot_counts(df, rows, cols, values, fill=0)


# --------------------------------------------------------------------------- A8, A9


def box_stats(df: DataFrame, by: str, y: str, whis: float = 1.5, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Box-plot statistics of ``y`` per ``by`` group.

    Quartiles by linear interpolation; whiskers are the most extreme values
    within ``whis * IQR`` of the box (never inside the box); outliers are the
    values beyond the fences.  The data is reduced to distinct ``(by, y)``
    pairs with counts first (map-side combined, so a hot group does not reach
    one task whole); quartiles come from those counts, range-partitioned; the per-group fences are joined back to the reduced table.
    Output: ``by, n, q1, median, q3, whisker_lo, whisker_hi, n_outliers``.
    """
    _check_method(method)
    src = df.filter(F.col(by).isNotNull() & F.col(y).isNotNull())
    vc = src.groupBy(by, F.col(y).cast("double").alias("__y")).agg(F.count(F.lit(1)).alias("__n"))
    if method == "exact":
        # Read twice (quartiles, then whiskers): compute the reduced table once.
        vc = materialize(vc)
        q = count_percentiles(vc, "__y", "__n", (0.25, 0.5, 0.75), [by]).withColumnRenamed("q", "__q")
    else:
        q = src.groupBy(by).agg(_approx(F.col(y).cast("double"), (0.25, 0.5, 0.75), accuracy).alias("__q"))
    return box_from_counts(vc, q.withColumnRenamed("__q", "q"), by, whis)


def box_from_counts(counts: DataFrame, quartiles: DataFrame, by: str, whis: float = 1.5) -> DataFrame:
    """A8/A9 from ``by, __y, __n`` (rows per group and value) and ``by, q`` (its quartiles)."""
    q = quartiles.select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    j = lookup_join(counts, q, on=by, how="inner")
    iqr = F.col("q3") - F.col("q1")
    lo_lim = F.col("q1") - F.lit(whis) * iqr
    hi_lim = F.col("q3") + F.lit(whis) * iqr
    out = j.groupBy(by, "q1", "median", "q3").agg(
        F.sum("__n").cast("bigint").alias("n"),
        F.min(F.when(F.col("__y") >= lo_lim, F.col("__y"))).alias("__wlo"),
        F.max(F.when(F.col("__y") <= hi_lim, F.col("__y"))).alias("__whi"),
        F.sum(F.when((F.col("__y") < lo_lim) | (F.col("__y") > hi_lim), F.col("__n")).otherwise(0)).cast("bigint").alias("n_outliers"),
    )
    return out.select(
        by,
        "n",
        "q1",
        "median",
        "q3",
        F.least(F.col("q1"), F.col("__wlo")).alias("whisker_lo"),
        F.greatest(F.col("q3"), F.col("__whi")).alias("whisker_hi"),
        "n_outliers",
    )
