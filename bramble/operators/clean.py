"""Cleaning operators: name normalisation (P1), duplicate removal (C1),
range / membership filters (C2-C4), the cleaning recipe (C5) and its
per-step row report (C6).

All of these are narrow, lazy transformations except duplicate removal, which
is one hash aggregate over every column.  Spark runs it with a map-side partial
aggregate, so a group of exact copies, however hot, leaves each map task as a
single row before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..presets import REVIEW


def normalized_name(name: str) -> str:
    """Lower-case, spaces to underscores (the reference's renaming rule)."""
    return name.lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalized_name` in one projection.

    Raises ``ValueError`` when two columns collide after renaming, instead of
    silently producing an ambiguous frame.
    """
    names = [normalized_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def drop_exact_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows equal on ``subset`` (all columns by default); NULL equals NULL."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def range_predicate(c: str, lo=None, hi=None, inclusive: tuple[bool, bool] = (True, True)) -> Column:
    """Not-null and within ``[lo, hi]``; each bound open or closed, either may be omitted."""
    x = F.col(c)
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & ((x >= F.lit(lo)) if inclusive[0] else (x > F.lit(lo)))
    if hi is not None:
        cond = cond & ((x <= F.lit(hi)) if inclusive[1] else (x < F.lit(hi)))
    return cond


def in_predicate(c: str, values: Iterable) -> Column:
    """Not-null and one of ``values``."""
    return F.col(c).isNotNull() & F.col(c).isin(list(values))


def filter_range(df: DataFrame, c: str, lo=None, hi=None, inclusive: tuple[bool, bool] = (True, True)) -> DataFrame:
    """Keep rows whose ``c`` is not null and inside the range."""
    return df.filter(range_predicate(c, lo, hi, inclusive))


def filter_in(df: DataFrame, c: str, values: Iterable) -> DataFrame:
    """C4: keep rows whose ``c`` is not null and in ``values``."""
    return df.filter(in_predicate(c, values))


@dataclass(frozen=True)
class Rule:
    """A named row filter used by the cleaning recipe."""

    name: str
    predicate: Column


def review_rules(cols=REVIEW) -> list[Rule]:
    """The reference's validity rules: age in (0, 100) open, rating in [1, 5], flag in {0, 1}."""
    return [
        Rule("age", range_predicate(cols.age, 0, 100, inclusive=(False, False))),
        Rule("rating", range_predicate(cols.rating, 1, 5, inclusive=(True, True))),
        Rule("recommended", in_predicate(cols.recommended, (0, 1))),
    ]


ALL_STEPS = ("normalize", "dedupe", "age", "rating", "recommended")


def _selected(df: DataFrame, steps: Iterable[str], rules: list[Rule] | None) -> tuple[set, list[Rule]]:
    """The steps as a set and the rules to apply, in order.

    Rules that were passed all apply, except one named like a built-in step that is
    not selected; the built-in rules apply where their step is selected.
    """
    steps = set(steps)
    known = set(ALL_STEPS) | {r.name for r in rules or []}
    if steps - known:
        raise ValueError(f"unknown cleaning steps {sorted(steps - known)}; choose from {sorted(known)}")
    if rules is not None:
        return steps, [r for r in rules if r.name in steps or r.name not in ALL_STEPS]
    # Without the renaming step, the rules address the columns by their original names.
    actual = {} if "normalize" in steps else {normalized_name(c): f"`{c}`" for c in df.columns}
    cols = REVIEW
    own = review_rules(
        type(cols)(age=actual.get(cols.age, cols.age), rating=actual.get(cols.rating, cols.rating),
                   recommended=actual.get(cols.recommended, cols.recommended))
    )
    return steps, [r for r in own if r.name in steps]


def clean(df: DataFrame, steps: Iterable[str] = ALL_STEPS, rules: list[Rule] | None = None) -> DataFrame:
    """Normalise names, drop exact duplicates, then apply the validity rules.

    Each step is optional.  ``rules`` replace the built-in ones; every rule passed
    applies (see :func:`_selected`).  Written in the reference's order (duplicates
    first); Catalyst moves the deterministic filters below the aggregate, so the
    shuffle only carries valid rows.
    """
    steps, rules = _selected(df, steps, rules)
    if "normalize" in steps:
        df = normalize_columns(df)
    if "dedupe" in steps:
        df = drop_exact_duplicates(df)
    for rule in rules:
        df = df.filter(rule.predicate)
    return df


def clean_report(df: DataFrame, rules: list[Rule] | None = None, steps: Iterable[str] = ALL_STEPS) -> DataFrame:
    """Rows in and out of every selected cleaning step, in one shuffle and one small aggregate.

    Duplicate removal commutes with the row filters, so the count after step k
    is the number of *distinct* rows that pass rules 1..k.  One aggregate over
    the distinct rows (each carrying its copy count) yields every step's count.
    Without the dedupe step nothing is shuffled and rows are counted as they are.
    Output: ``step_no int, step string, rows_in bigint, rows_out bigint, dropped bigint``.
    """
    return clean_with_report(df, rules, steps)[1]


def clean_with_report(
    df: DataFrame, rules: list[Rule] | None = None, steps: Iterable[str] = ALL_STEPS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C5 and C6 from one duplicate-removal shuffle.

    Returns ``(cleaned, report, counted)``: ``counted`` holds every distinct
    row with its copy count (``__copies``; without the dedupe step every row
    with 1); the cleaned rows and the per-step report are both read from it, so the
    raw table is shuffled once instead of twice.  Persist it when both outputs are used.
    """
    steps, rules = _selected(df, steps, rules)
    if "normalize" in steps:
        df = normalize_columns(df)
    if "dedupe" in steps:
        counted = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    else:
        counted = df.withColumn("__copies", F.lit(1).cast("bigint"))
    cleaned = counted
    for rule in rules:
        cleaned = cleaned.filter(rule.predicate)
    return cleaned.drop("__copies"), _report_from_distinct(counted, rules, "dedupe" in steps), counted


def _report_from_distinct(distinct: DataFrame, rules: list[Rule], dedupe: bool = True) -> DataFrame:
    passed = F.lit(True)
    aggs = [F.sum("__copies").alias("c0"), F.count(F.lit(1)).alias("c1")]
    for i, rule in enumerate(rules):
        passed = passed & rule.predicate
        aggs.append(F.count_if(passed).alias(f"c{i + 2}"))
    wide = distinct.agg(*aggs)
    names = ["dedupe"] + [r.name for r in rules]
    shown = [(i, name) for i, name in enumerate(names) if dedupe or i]
    if not shown:
        return wide.sparkSession.createDataFrame([], "step_no int, step string, rows_in bigint, rows_out bigint, dropped bigint")
    entries = ", ".join(
        f"{no + 1}, '{name}', coalesce(c{i}, 0L), coalesce(c{i + 1}, 0L)" for no, (i, name) in enumerate(shown)
    )
    return wide.selectExpr(f"stack({len(shown)}, {entries}) AS (step_no, step, rows_in, rows_out)").select(
        F.col("step_no").cast("int").alias("step_no"),
        "step",
        F.col("rows_in").cast("bigint").alias("rows_in"),
        F.col("rows_out").cast("bigint").alias("rows_out"),
        (F.col("rows_in") - F.col("rows_out")).cast("bigint").alias("dropped"),
    )
