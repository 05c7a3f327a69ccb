"""Missing values: profile (N1) and imputation.

Every fill value is computed on the executors and reaches the filled column
either as a scalar subquery (one value for the whole table) or through a
size-checked lookup join (one value per group).  Nothing is collected.
A one-value statistic is materialised (checkpointed) before it is read as a
scalar subquery, so the filled frame's plan does not nest the whole upstream
plan once per step, and a lost executor does not recompute it.

Mode semantics (fixed here, arbitrary in the reference): nulls are not a
candidate value, the most frequent value wins, ties go to the smallest value.
A column that is entirely null has no mode, and filling it is a no-op.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..presets import REVIEW
from .joins import lookup_join, materialize
from .ranks import column_percentiles

FLOATING = (T.FloatType, T.DoubleType)


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN for floating-point columns only (``isnan`` on text raises under ANSI)."""
    x = F.col(c)
    if isinstance(df.schema[c].dataType, FLOATING):
        return x.isNull() | F.isnan(x)
    return x.isNull()


# --------------------------------------------------------------------------- N1


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage per column, in one aggregate.

    Output ``column string, missing_count bigint, missing_pct double``; the
    percentage is null on an empty frame instead of dividing by zero.
    """
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)]
    entries = ", ".join(f"{_sql_str(c)}, m{i}" for i, c in enumerate(cols))
    long = df.agg(*aggs).selectExpr("__rows", f"stack({len(cols)}, {entries}) AS (`column`, missing_count)")
    return long.select(
        "column",
        F.col("missing_count").cast("bigint").alias("missing_count"),
        (F.try_divide(F.col("missing_count").cast("double"), F.col("__rows").cast("double")) * F.lit(100.0)).alias(
            "missing_pct"
        ),
    )


# --------------------------------------------------------------------------- statistics


def median_value(df: DataFrame, c: str, method: str = "approx", rel_err: float = 0.01) -> Column:
    """The median of ``c`` as a scalar-subquery column (computed now, read lazily).

    ``approx``: the bounded quantile sketch with relative rank error ``rel_err``
    (the reference's ``approxQuantile(c, [0.5], 0.01)``; returns an actual value).
    ``exact``: linear interpolation between the two middle values.
    """
    x = F.col(c)
    if method == "approx":
        stat = F.percentile_approx(x, F.lit(0.5), max(1, int(round(1.0 / rel_err))))
    elif method == "exact":
        return materialize(column_percentiles(df, [c], (0.5,)).select(F.col("q")[0].alias("median"))).scalar()
    else:
        raise ValueError("method must be 'approx' or 'exact'")
    return materialize(df.agg(stat.cast("double").alias("median"))).scalar()


def approx_medians(df: DataFrame, cols: Sequence[str], rel_err: float = 0.01) -> DataFrame:
    """The sketched medians of several columns in one pass, with the ranks they really have.

    ``column, n, median, rank_lo, rank_hi, rank_error``: the shares of values below the median and up to it, from
    one more aggregate that counts, and how far that interval stays from one half (0 if it holds it).  The
    sketch (mergeable, about ``1 / rel_err`` entries per task) promises ``rank_error <= rel_err``.
    """
    accuracy = max(1, int(round(1.0 / rel_err)))
    medians = materialize(df.agg(*[F.percentile_approx(F.col(c), F.lit(0.5), accuracy).cast("double").alias(f"m{i}") for i, c in enumerate(cols)]))
    found = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], medians.select(F.struct(*medians.columns)).scalar().alias("m"))
    aggs = []
    for i in range(len(cols)):
        x, m = F.col(f"x{i}"), F.col(f"m.m{i}")
        aggs += [F.count(x).alias(f"n{i}"), F.max(m).alias(f"v{i}"), F.count_if(x < m).alias(f"lo{i}"), F.count_if(x <= m).alias(f"hi{i}")]
    entries = ", ".join(f"{_sql_str(c)}, n{i}, v{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    long = found.agg(*aggs).selectExpr(f"stack({len(cols)}, {entries}) AS (`column`, n, median, below, upto)")
    lo, hi = F.try_divide(F.col("below").cast("double"), F.col("n")), F.try_divide(F.col("upto").cast("double"), F.col("n"))
    return long.select("column", "n", "median", lo.alias("rank_lo"), hi.alias("rank_hi"), F.greatest(lo - 0.5, 0.5 - hi, F.lit(0.0)).alias("rank_error"))


def _value_counts(df: DataFrame, c: str, by: Sequence[str] = ()) -> DataFrame:
    src = df.filter(F.col(c).isNotNull())
    return src.groupBy(*by, c).agg(F.count(F.lit(1)).alias("__n"))


def _best(c: str) -> Column:
    """Most frequent first, then smallest value: the minimum of (-count, value)."""
    return F.min(F.struct((-F.col("__n")).alias("k"), F.col(c).alias("v")))["v"]


def mode_value(df: DataFrame, c: str) -> Column:
    """The mode of ``c`` (nulls excluded, ties to the smallest) as a scalar-subquery column.

    A distributed ``groupBy(c).count()`` (map-side combined) followed by a
    global minimum over the distinct values, which carries one row per map
    task to the final step.
    """
    return materialize(_value_counts(df, c).agg(_best(c).alias("mode"))).scalar()


def group_modes(df: DataFrame, c: str, by: Sequence[str] | str) -> DataFrame:
    """The mode of ``c`` within each ``by`` group: ``*by, mode``."""
    by = [by] if isinstance(by, str) else list(by)
    src = df.filter(F.col(c).isNotNull())
    for b in by:
        src = src.filter(F.col(b).isNotNull())
    return _value_counts(src, c, by).groupBy(*by).agg(_best(c).alias("mode"))


# --------------------------------------------------------------------------- I1-I4


def impute_median(df: DataFrame, c: str, method: str = "approx", rel_err: float = 0.01, keep_type: bool = False) -> DataFrame:
    """Fill nulls of ``c`` with its median.

    By default the column becomes double, as in the reference; with
    ``keep_type=True`` the median is rounded (half up) back to an integral type.
    """
    med = median_value(df, c, method, rel_err)
    dtype = df.schema[c].dataType
    if keep_type:
        fill = F.round(med).cast(dtype) if not isinstance(dtype, FLOATING) else med.cast(dtype)
        return df.withColumn(c, F.coalesce(F.col(c), fill))
    return df.withColumn(c, F.coalesce(F.col(c).cast("double"), med))


def impute_constant(df: DataFrame, c: str, value) -> DataFrame:
    """Fill nulls of ``c`` with a constant."""
    return df.withColumn(c, F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)))


def impute_mode(df: DataFrame, c: str) -> DataFrame:
    """Fill nulls of ``c`` with its global mode (type preserved)."""
    return df.withColumn(c, F.coalesce(F.col(c), mode_value(df, c)))


def impute_group_mode(df: DataFrame, c: str, by: Sequence[str] | str, max_broadcast_rows: int | None = None) -> DataFrame:
    """I4: fill nulls of ``c`` with the mode of ``c`` within the row's ``by`` group.

    The per-group modes (one row per group) are joined back with
    :func:`lookup_join`: broadcast below a checked row count, shuffle join with
    AQE skew splitting above it.  Rows whose group is null, or whose group has
    no non-null value, stay null.
    """
    by = [by] if isinstance(by, str) else list(by)
    modes = group_modes(df, c, by).withColumnRenamed("mode", "__fill")
    kw = {} if max_broadcast_rows is None else {"max_broadcast_rows": max_broadcast_rows}
    joined = lookup_join(df, modes, on=by, how="left", **kw)
    return joined.withColumn(c, F.coalesce(F.col(c), F.col("__fill"))).select(*df.columns)


# --------------------------------------------------------------------------- I5


@dataclass(frozen=True)
class Step:
    """One imputation step: ``kind`` in median / constant / mode / group_mode."""

    kind: str
    column: str
    value: object = None
    by: tuple[str, ...] = ()


def review_plan(cols=REVIEW, median_method: str = "approx") -> list[Step]:
    """The reference's order: age median, title constant, rating mode, division mode,
    department mode within division, then the leftover department mode.
    Order matters: division is filled before department groups are counted."""
    return [
        Step("median", cols.age, median_method),
        Step("constant", cols.title, "No Title"),
        Step("mode", cols.rating),
        Step("mode", cols.division),
        Step("group_mode", cols.department, by=(cols.division,)),
        Step("mode", cols.department),
    ]


def apply_step(df: DataFrame, step: Step) -> DataFrame:
    if step.kind == "median":
        return impute_median(df, step.column, method=step.value or "approx")
    if step.kind == "constant":
        return impute_constant(df, step.column, step.value)
    if step.kind == "mode":
        return impute_mode(df, step.column)
    if step.kind == "group_mode":
        return impute_group_mode(df, step.column, list(step.by))
    raise ValueError(f"unknown imputation step {step.kind!r}")


@dataclass
class ImputeResult:
    imputed: DataFrame
    profile_before: DataFrame
    profile_after: DataFrame


def _fill_batch(df: DataFrame, batch: list[Step]) -> DataFrame:
    """Apply independent global fills whose statistics share passes.

    All medians come from one aggregate; all modes from one multi-column
    value count (each column's ``(value, count)`` pairs, combined map-side).
    Each step's statistic reads only its own column, which no step of the
    batch modifies before it, so the result equals applying them one by one.
    """
    from .stats import value_counts_many

    fills: dict[str, Column] = {}
    medians = [s for s in batch if s.kind == "median"]
    exact = [s.column for s in medians if s.value == "exact"]
    sketched = [s.column for s in medians if s.value != "exact"]
    rows = []
    if exact:
        found = materialize(column_percentiles(df, exact, (0.5,)))
        rows.append((exact, found.agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"m{i}") for i, c in enumerate(exact)]))))
    if sketched:
        found = materialize(df.agg(*[F.percentile_approx(c, F.lit(0.5), 100).cast("double").alias(f"m{i}") for i, c in enumerate(sketched)]))
        rows.append((sketched, found.select(F.struct("*"))))
    for cols, row in rows:
        value = row.scalar()
        for i, c in enumerate(cols):
            fills[c] = F.coalesce(F.col(c).cast("double"), value[f"m{i}"])
    modes = [s for s in batch if s.kind == "mode"]
    if modes:
        cols = [s.column for s in modes]
        long = value_counts_many(df, cols)
        # Ties go to the smallest *typed* value, as in mode_value (not the smallest text).
        best = [
            F.min(
                F.when(
                    F.col("column") == F.lit(c),
                    F.struct((-F.col("count")).alias("k"), F.col("value").cast(df.schema[c].dataType).alias("v")),
                )
            )["v"].alias(f"d{i}")
            for i, c in enumerate(cols)
        ]
        row = materialize(long.agg(*best)).select(F.struct(*[f"d{i}" for i in range(len(cols))])).scalar()
        for i, c in enumerate(cols):
            fills[c] = F.coalesce(F.col(c), row[f"d{i}"])
    for s in batch:
        if s.kind == "constant":
            fills[s.column] = F.coalesce(F.col(s.column), F.lit(s.value).cast(df.schema[s.column].dataType))
    return df.select(*[fills[c].alias(c) if c in fills else F.col(c) for c in df.columns])


def _group_then_global_mode(df: DataFrame, c: str, by: list[str], max_broadcast_rows: int | None = None) -> DataFrame:
    """I4 followed by I3 on the same column, from one pass over the rows.

    One grouped count over ``(*by, c)``, nulls included, gives the per-group
    modes and also the column's counts *after* the group fill (each group's
    nulls are credited to that group's mode), hence the global mode.  Rows
    are then filled in one projection after a size-checked lookup join.
    Equal to ``impute_group_mode`` then ``impute_mode``.
    """
    counts = materialize(df.groupBy(*by, c).agg(F.count(F.lit(1)).alias("__n")))
    known = counts.filter(F.col(c).isNotNull())
    for b in by:
        known = known.filter(F.col(b).isNotNull())
    modes = known.groupBy(*by).agg(_best(c).alias("__fill"))
    group_nulls = counts.filter(F.col(c).isNull()).drop(c).join(modes, by, "inner").select(F.col("__fill").alias(c), "__n")
    after = counts.filter(F.col(c).isNotNull()).select(c, "__n").unionByName(group_nulls)
    total = after.groupBy(c).agg(F.sum("__n").alias("__n"))
    global_mode = materialize(total.agg(_best(c).alias("mode"))).scalar()
    kw = {} if max_broadcast_rows is None else {"max_broadcast_rows": max_broadcast_rows}
    joined = lookup_join(df, modes, on=by, how="left", **kw)
    return joined.withColumn(c, F.coalesce(F.col(c), F.col("__fill"), global_mode)).select(*df.columns)


_BATCHABLE = ("median", "constant", "mode")


def impute(df: DataFrame, plan: list[Step] | None = None) -> ImputeResult:
    """Run the plan in order; report the missing profile before and after.

    Consecutive global steps (median / constant / mode) on columns no earlier
    step has filled are applied together by :func:`_fill_batch`, so their
    statistics share passes over the data; a group-mode fill followed by a
    global mode of the same column shares one pass
    (:func:`_group_then_global_mode`); other steps run one by one.
    """
    plan = plan if plan is not None else review_plan()
    out, filled, i = df, set(), 0
    while i < len(plan):
        batch, j = [], i
        while j < len(plan) and plan[j].kind in _BATCHABLE and plan[j].column not in filled | {s.column for s in batch}:
            batch.append(plan[j])
            j += 1
        if len(batch) > 1:
            out = _fill_batch(out, batch)
        elif (
            plan[i].kind == "group_mode"
            and i + 1 < len(plan)
            and plan[i + 1].kind == "mode"
            and plan[i + 1].column == plan[i].column
        ):
            batch, j = [plan[i], plan[i + 1]], i + 2
            out = _group_then_global_mode(out, plan[i].column, list(plan[i].by))
        else:
            batch, j = [plan[i]], i + 1
            out = apply_step(out, plan[i])
        filled |= {s.column for s in batch}
        i = j
    return ImputeResult(out, missing_profile(df), missing_profile(out))
