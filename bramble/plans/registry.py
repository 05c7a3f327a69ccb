"""Registered queries: one per operator of the survey inventory.

Each query takes ``(spark, sf_dir)``, reads the given tables (or the review
table Spark derives from them) and returns a DataFrame.  Doubles are rounded to
four digits so results compare across engines; the matching DuckDB statements
live in :mod:`bramble.plans.oracle_sql` and in ``ORACLE`` below.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array

from ..operators import clean as C
from ..operators import features as FE
from ..operators import kmeans as KM
from ..operators import linear as LN
from ..operators import metrics as M
from ..operators import models as MO
from ..operators import missing as N
from ..operators import stats as A
from ..operators.joins import lookup_join
from ..presets import REVIEW as R
from ..sources import generator as G
from ..sources import sinks
from ..sources.reviews_raw import reviews_raw
from ..sources.tables import read_table
from . import recipes as E
from .oracle_sql import (
    CLEAN_WHERE,
    COLS,
    generator_sql,
    group_fill_select,
    group_mode_ctes,
    imputed_ctes,
    mode_sql,
    select_with,
    with_reviews,
)
from .model_sql import forest_ctes, least_squares_ctes, least_squares_prediction
from .sweep_sql import sweep_ctes

Query = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double/float column (for cross-engine comparison)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


_stored: dict[tuple[str, str], str] = {}


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty review table that Spark derives from ``lineitem`` and ``part``, written once per session and folder.

    Its hash expressions are long; every query after the first reads the table from the checkpoint folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = sinks.own_path(spark, "reviews-raw")
        reviews_raw(spark, sf_dir).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def raw_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.normalize_columns(reviews(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(reviews(spark, sf_dir))


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------- cleaning


@register("p1_normalize_columns", with_reviews("SELECT * FROM raw_n"))
def q_p1(spark, d):
    return raw_n(spark, d)


@register("c1_drop_exact_duplicates", with_reviews("SELECT * FROM deduped"))
def q_c1(spark, d):
    return C.drop_exact_duplicates(raw_n(spark, d))


@register(
    "c2_filter_age_open_range",
    with_reviews("SELECT * FROM raw_n WHERE age IS NOT NULL AND age > 0 AND age < 100"),
)
def q_c2(spark, d):
    return C.filter_range(raw_n(spark, d), R.age, 0, 100, inclusive=(False, False))


@register(
    "c3_filter_rating_closed_range",
    with_reviews("SELECT * FROM raw_n WHERE rating IS NOT NULL AND rating BETWEEN 1 AND 5"),
)
def q_c3(spark, d):
    return C.filter_range(raw_n(spark, d), R.rating, 1, 5)


@register(
    "c4_filter_recommended_in",
    with_reviews("SELECT * FROM raw_n WHERE recommended_ind IS NOT NULL AND recommended_ind IN (0, 1)"),
)
def q_c4(spark, d):
    return C.filter_in(raw_n(spark, d), R.recommended, (0, 1))


@register("c5_clean", with_reviews("SELECT * FROM cleaned"))
def q_c5(spark, d):
    return cleaned(spark, d)


_C6_SQL = with_reviews(
    """SELECT CAST(step_no AS INTEGER) AS step_no, step, CAST(rows_in AS BIGINT) AS rows_in,
       CAST(rows_out AS BIGINT) AS rows_out, CAST(rows_in - rows_out AS BIGINT) AS dropped
FROM (
  SELECT 1 AS step_no, 'dedupe' AS step, (SELECT count(*) FROM raw_n) AS rows_in, (SELECT count(*) FROM deduped) AS rows_out
  UNION ALL SELECT 2, 'age', (SELECT count(*) FROM deduped), (SELECT count(*) FROM deduped WHERE age IS NOT NULL AND age > 0 AND age < 100)
  UNION ALL SELECT 3, 'rating', (SELECT count(*) FROM deduped WHERE age IS NOT NULL AND age > 0 AND age < 100),
     (SELECT count(*) FROM deduped WHERE age IS NOT NULL AND age > 0 AND age < 100 AND rating IS NOT NULL AND rating BETWEEN 1 AND 5)
  UNION ALL SELECT 4, 'recommended',
     (SELECT count(*) FROM deduped WHERE age IS NOT NULL AND age > 0 AND age < 100 AND rating IS NOT NULL AND rating BETWEEN 1 AND 5),
     (SELECT count(*) FROM cleaned)
) t"""
)


@register("c5_clean_custom_rule", with_reviews("SELECT * FROM cleaned WHERE positive_feedback_count IS NOT NULL AND positive_feedback_count >= 3"))
def q_c5_custom(spark, d):
    rules = [*C.review_rules(), C.Rule("feedback", C.range_predicate(R.feedback, lo=3))]
    return C.clean(reviews(spark, d), rules=rules)


@register(
    "c6_report_subset",
    with_reviews(
        """SELECT CAST(1 AS INTEGER) AS step_no, 'age' AS step, count(*) AS rows_in, count(*) FILTER (WHERE age IS NOT NULL AND age > 0 AND age < 100) AS rows_out,
       count(*) FILTER (WHERE age IS NULL OR age <= 0 OR age >= 100) AS dropped FROM raw_n"""
    ),
)
def q_c6_subset(spark, d):
    return C.clean_report(reviews(spark, d), steps=("normalize", "age"))


@register("c6_clean_report", _C6_SQL)
def q_c6(spark, d):
    return C.clean_report(reviews(spark, d))


# --------------------------------------------------------------------------- crosstab (step 1 slice)


_UNCLEANED = "SELECT rating, " + ", ".join(
    f'CAST(count(*) FILTER (WHERE recommended_ind = {v}) AS BIGINT) AS "{v}"' for v in (0, 1, 2)
)


@register("a7_crosstab_uncleaned", with_reviews(_UNCLEANED + " FROM raw_n WHERE rating IS NOT NULL AND recommended_ind IS NOT NULL GROUP BY rating"))
def q_a7_raw(spark, d):
    """Every flag value that occurs has its column, invalid ones too."""
    return A.crosstab(raw_n(spark, d), R.rating, R.recommended)


_A7_SQL = with_reviews(
    """SELECT rating, CAST(count(*) FILTER (WHERE recommended_ind = 0) AS BIGINT) AS "0",
       CAST(count(*) FILTER (WHERE recommended_ind = 1) AS BIGINT) AS "1"
FROM cleaned WHERE rating IS NOT NULL AND recommended_ind IS NOT NULL GROUP BY rating"""
)


@register("a7_crosstab_rating_recommended", _A7_SQL)
def q_a7(spark, d):
    return A.crosstab(cleaned(spark, d), R.rating, R.recommended, values=[0, 1])


# --------------------------------------------------------------------------- missing values


def _profile_sql(source: str) -> str:
    cols = [
        "age",
        "title",
        "review_text",
        "rating",
        "recommended_ind",
        "positive_feedback_count",
        "division_name",
        "department_name",
        "class_name",
    ]
    parts = [
        f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_count, "
        f"round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100.0, 4) AS missing_pct FROM {source}"
        for c in cols
    ]
    return "\nUNION ALL ".join(parts)


@register("n1_missing_profile_raw", with_reviews(_profile_sql("raw_n")))
def q_n1_raw(spark, d):
    return round_doubles(N.missing_profile(raw_n(spark, d)))


@register("n1_missing_profile_cleaned", with_reviews(_profile_sql("cleaned")))
def q_n1_clean(spark, d):
    return round_doubles(N.missing_profile(cleaned(spark, d)))


_held: list[DataFrame] = []


def held(df: DataFrame) -> DataFrame:
    """``df`` persisted, for a query whose statistics and result read it, so duplicates are removed in one shuffle.

    What the query before this one held is released here (a result still in use recomputes its blocks).
    """
    while _held:
        _held.pop().unpersist()
    _held.append(df.persist())
    return _held[-1]


def imputed(spark: SparkSession, sf_dir: str, cols: Sequence[str] = tuple(COLS), median_method: str = "exact") -> DataFrame:
    """``cols`` of the cleaned reviews after the reference's imputation plan (exact median by default).

    Only ``cols``, and what their fills read, are kept behind the duplicate removal.  They
    feed every fill statistic and then the result, so they are held (:func:`held`).
    """
    need = set(cols)
    steps = []
    for step in reversed(N.review_plan(median_method=median_method)):
        if step.column in need:
            need |= set(step.by)
            steps.insert(0, step)
    base = held(cleaned(spark, sf_dir).select(*[c for c in COLS if c in need]))
    return N.impute(base, steps).imputed.select(*cols)


# --------------------------------------------------------------------------- imputation


_AGE_R = "round(age, 4)"


@register(
    "i1_impute_median_exact",
    with_reviews(
        select_with("raw_n", age="round(coalesce(CAST(age AS DOUBLE), (SELECT quantile_cont(age, 0.5) FROM raw_n)), 4)")
    ),
)
def q_i1(spark, d):
    return round_doubles(N.impute_median(raw_n(spark, d), R.age, method="exact"))


_MEDIAN_COLS = ["age", "rating", "recommended_ind", "positive_feedback_count"]


@register(
    "i1_approx_median_rank",
    with_reviews("\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS n, true AS within FROM raw_n" for c in _MEDIAN_COLS)),
)
def q_i1_rank(spark, d):
    """The sketched median of every numeric column holds a rank within one hundredth of the middle, as counted."""
    found = N.approx_medians(raw_n(spark, d), _MEDIAN_COLS, rel_err=0.01)
    return found.select("column", "n", (F.col("rank_error") <= 0.01).alias("within"))


@register("i2_impute_constant", with_reviews(select_with("raw_n", title="coalesce(title, 'No Title')")))
def q_i2(spark, d):
    return N.impute_constant(raw_n(spark, d), R.title, "No Title")


@register("i3_impute_mode_rating", with_reviews(select_with("raw_n", rating=f"coalesce(rating, {mode_sql('raw_n', 'rating')})")))
def q_i3_rating(spark, d):
    return N.impute_mode(raw_n(spark, d), R.rating)


@register(
    "i3_impute_mode_division",
    with_reviews(select_with("cleaned", division_name=f"coalesce(division_name, {mode_sql('cleaned', 'division_name')})")),
)
def q_i3_division(spark, d):
    return N.impute_mode(held(cleaned(spark, d)), R.division)


@register(
    "i4_impute_group_mode",
    with_reviews(
        group_fill_select("gm", "cleaned", "department_name", "division_name"),
        *group_mode_ctes("gm", "cleaned", "department_name", "division_name"),
    ),
)
def q_i4(spark, d):
    return N.impute_group_mode(held(cleaned(spark, d)), R.department, R.division)


@register("i5_impute_recipe", with_reviews(select_with("imputed", age=_AGE_R), *imputed_ctes()))
def q_i5(spark, d):
    return round_doubles(imputed(spark, d))


@register("n1_missing_profile_imputed", with_reviews(_profile_sql("imputed"), *imputed_ctes()))
def q_n1_imputed(spark, d):
    return round_doubles(N.missing_profile(imputed(spark, d)))


# --------------------------------------------------------------------------- descriptive statistics


_STRING_COLS = {"title", "review_text", "division_name", "department_name", "class_name"}


def _describe_sql(source: str) -> str:
    parts = []
    for c in COLS:
        if c in _STRING_COLS:
            mean, sd = "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"
        else:
            mean, sd = f"round(avg({c}), 4)", f"round(stddev_samp({c}), 4)"
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS \"count\", {mean} AS \"mean\", {sd} AS stddev, "
            f"CAST(min({c}) AS VARCHAR) AS \"min\", CAST(max({c}) AS VARCHAR) AS \"max\" FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


@register("a1_describe_raw", with_reviews(_describe_sql("raw_n")))
def q_a1(spark, d):
    return round_doubles(A.describe_all(raw_n(spark, d)))


_NUMERIC = ["age", "rating", "recommended_ind", "positive_feedback_count"]


def _summary_sql(source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS \"count\", round(avg({c}), 4) AS \"mean\", "
        f"round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS \"min\", "
        f"round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, "
        f"round(quantile_cont({c}, 0.75), 4) AS p75, round(CAST(max({c}) AS DOUBLE), 4) AS \"max\" FROM {source}"
        for c in _NUMERIC
    ]
    return "\nUNION ALL ".join(parts)


@register("a2_summarize_imputed", with_reviews(_summary_sql("imputed"), *imputed_ctes()))
def q_a2(spark, d):
    return round_doubles(A.summarize(imputed(spark, d, _NUMERIC), _NUMERIC))


def _histogram_sql(source: str, c: str) -> str:
    edge = "CASE WHEN {k} >= nb THEN hi ELSE lo + CAST({k} AS DOUBLE) * ((hi - lo) / nb) END"
    ctes = [
        f"h AS (SELECT CAST({c} AS DOUBLE) AS x FROM {source} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))",
        "st AS (SELECT count(*) AS n, min(x) AS lo0, max(x) AS hi0, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM h)",
        "w AS (SELECT *, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi, "
        "(hi0 - lo0) / (log2(CAST(n AS DOUBLE)) + 1.0) AS sturges, 2.0 * (q3 - q1) * pow(CAST(n AS DOUBLE), -1.0 / 3.0) AS fd FROM st)",
        "w2 AS (SELECT *, CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END AS width FROM w)",
        "nbt AS (SELECT lo, hi, CASE WHEN lo0 = hi0 THEN 1 WHEN hi0 - lo0 > 0 AND width > 0 "
        "THEN CAST(ceil((hi0 - lo0) / width) AS INTEGER) ELSE 1 END AS nb FROM w2)",
        "i0 AS (SELECT x, lo, hi, nb, least(greatest(CAST(floor((x - lo) / (hi - lo) * nb) AS INTEGER), 0), nb - 1) AS i0 FROM h, nbt)",
        f"i1 AS (SELECT *, CASE WHEN x < {edge.format(k='i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM i0)",
        f"i2 AS (SELECT *, CASE WHEN x >= {edge.format(k='(i1 + 1)')} AND i1 <> nb - 1 THEN i1 + 1 ELSE i1 END AS bin FROM i1)",
        "cnt AS (SELECT bin, count(*) AS n FROM i2 GROUP BY bin)",
        "bins AS (SELECT CAST(b.range AS INTEGER) AS bin, lo, hi, nb FROM nbt, range(nbt.nb) b)",
    ]
    body = (
        f"SELECT b.bin, round({edge.format(k='b.bin')}, 4) AS bin_lo, round({edge.format(k='(b.bin + 1)')}, 4) AS bin_hi, "
        "CAST(coalesce(c.n, 0) AS BIGINT) AS \"count\" FROM bins b LEFT JOIN cnt c ON b.bin = c.bin"
    )
    return ctes, body


_H_CTES, _H_BODY = _histogram_sql("imputed", "age")


@register("a3_histogram_age", with_reviews(_H_BODY, *imputed_ctes(), *_H_CTES))
def q_a3(spark, d):
    return round_doubles(A.histogram(imputed(spark, d, [R.age]), R.age, bins="auto"))


_H10_CTES, _H10_BODY = _histogram_sql("cleaned", "positive_feedback_count")
_H10_CTES = [c.replace("CASE WHEN lo0 = hi0 THEN 1 WHEN hi0 - lo0 > 0 AND width > 0 THEN CAST(ceil((hi0 - lo0) / width) AS INTEGER) ELSE 1 END", "10") for c in _H10_CTES]


@register("a3_histogram_feedback_10_bins", with_reviews(_H10_BODY, *_H10_CTES))
def q_a3_10(spark, d):
    return round_doubles(A.histogram(cleaned(spark, d), R.feedback, bins=10))


def _kde_sql(source: str, c: str, grid: int = 200) -> tuple[list[str], str]:
    last = grid - 1
    ctes = [
        f"kv AS (SELECT CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))",
        "kst AS (SELECT CAST(count(*) AS DOUBLE) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM kv)",
        "kbw AS (SELECT *, sd * pow(n, -0.2) AS bw FROM kst)",
        f"kg AS (SELECT CAST(range AS INTEGER) AS point, CASE WHEN range = {last} THEN hi ELSE lo + CAST(range AS DOUBLE) * ((hi - lo) / {float(last)}) END AS x, n, bw FROM kbw, range({grid}))",
        "kvc AS (SELECT v, CAST(count(*) AS DOUBLE) AS w FROM kv GROUP BY v)",
    ]
    body = (
        "SELECT point, round(x, 4) AS x, round(sum(w * exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) / (n * bw * sqrt(2.0 * pi())), 4) AS density "
        "FROM kg, kvc GROUP BY point, x, n, bw"
    )
    return ctes, body


_K_CTES, _K_BODY = _kde_sql("imputed", "age")


@register("a4_kde_age", with_reviews(_K_BODY, *imputed_ctes(), *_K_CTES))
def q_a4(spark, d):
    return round_doubles(A.kde(imputed(spark, d, [R.age]), R.age, resolution=None))


def _kde_binned_sql(source: str, c: str, grid: int = 200, resolution: int = 50, tail: float = 6.0) -> tuple[list[str], str]:
    last = grid - 1
    ctes = [
        f"kv AS (SELECT CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))",
        "kst AS (SELECT CAST(count(*) AS DOUBLE) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM kv)",
        "kbw AS (SELECT *, sd * pow(n, -0.2) AS bw FROM kst)",
        f"ks AS (SELECT floor((v - lo) / (bw / {resolution})) AS bin, (v - lo) / (bw / {resolution}) - floor((v - lo) / (bw / {resolution})) AS part FROM kv, kbw)",
        "kb AS (SELECT bin, sum(w) AS w FROM (SELECT bin, 1 - part AS w FROM ks UNION ALL SELECT bin + 1, part FROM ks) GROUP BY bin)",
        f"kg AS (SELECT CAST(range AS INTEGER) AS point, CASE WHEN range = {last} THEN hi ELSE lo + CAST(range AS DOUBLE) * ((hi - lo) / {float(last)}) END AS x FROM kbw, range({grid}))",
        f"kd AS (SELECT point, sum(w * exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) AS s FROM (SELECT lo + bin * (bw / {resolution}) AS v, w, bw FROM kb, kbw), kg WHERE abs(x - v) <= {tail} * bw GROUP BY point)",
    ]
    body = "SELECT point, round(x, 4) AS x, round(coalesce(s, 0) / (n * bw * sqrt(2.0 * pi())) * {scale}, 4) AS density FROM kg LEFT JOIN kd USING (point), kbw"
    return ctes, body


_KC_CTES, _KC_BODY = _kde_binned_sql("lineitem", "l_extendedprice")


@register("a4_kde_extended_price", "WITH " + ",\n".join(_KC_CTES) + "\n" + _KC_BODY.format(scale="100000"))
def q_a4_price(spark, d):
    """The density of a continuous column (binned, the default), in units of one in 100,000."""
    out = A.kde(read_table(spark, d, "lineitem"), "l_extendedprice")
    return round_doubles(out.withColumn("density", F.col("density") * 100_000))


def _value_counts_sql(source: str, c: str) -> str:
    return f'SELECT {c}, CAST(count(*) AS BIGINT) AS "count" FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}'


@register("a5_value_counts_rating", with_reviews(_value_counts_sql("imputed", "rating"), *imputed_ctes()))
def q_a5(spark, d):
    return A.value_counts(imputed(spark, d, [R.rating]), R.rating, order="value")


@register("a6_value_counts_division", with_reviews(_value_counts_sql("imputed", "division_name"), *imputed_ctes()))
def q_a6_div(spark, d):
    return A.value_counts(imputed(spark, d, [R.division]), R.division, order="count")


@register("a6_value_counts_department", with_reviews(_value_counts_sql("imputed", "department_name"), *imputed_ctes()))
def q_a6_dept(spark, d):
    return A.value_counts(imputed(spark, d, [R.department]), R.department, order="count")


@register("a6_value_counts_class", with_reviews(_value_counts_sql("imputed", "class_name"), *imputed_ctes()))
def q_a6_class(spark, d):
    return A.value_counts(imputed(spark, d, [R.klass]), R.klass, order="count")


def _box_sql(source: str, by: str, y: str) -> tuple[list[str], str]:
    ctes = [
        f"bx AS (SELECT {by} AS g, CAST({y} AS DOUBLE) AS y FROM {source} WHERE {by} IS NOT NULL AND {y} IS NOT NULL)",
        "bq AS (SELECT g, count(*) AS n, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS med, quantile_cont(y, 0.75) AS q3 FROM bx GROUP BY g)",
        "bf AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_lim, q3 + 1.5 * (q3 - q1) AS hi_lim FROM bq)",
    ]
    body = (
        f"SELECT f.g AS {by}, CAST(f.n AS BIGINT) AS n, round(f.q1, 4) AS q1, round(f.med, 4) AS median, round(f.q3, 4) AS q3, "
        "round(least(f.q1, min(CASE WHEN x.y >= f.lo_lim THEN x.y END)), 4) AS whisker_lo, "
        "round(greatest(f.q3, max(CASE WHEN x.y <= f.hi_lim THEN x.y END)), 4) AS whisker_hi, "
        "CAST(count(*) FILTER (WHERE x.y < f.lo_lim OR x.y > f.hi_lim) AS BIGINT) AS n_outliers "
        "FROM bf f JOIN bx x ON f.g = x.g GROUP BY f.g, f.n, f.q1, f.med, f.q3"
    )
    return ctes, body


_B8_CTES, _B8_BODY = _box_sql("imputed", "division_name", "rating")


@register("a8_box_rating_by_division", with_reviews(_B8_BODY, *imputed_ctes(), *_B8_CTES))
def q_a8(spark, d):
    return round_doubles(A.box_stats(imputed(spark, d, [R.division, R.rating]), R.division, R.rating))


_B9_CTES, _B9_BODY = _box_sql("imputed", "rating", "positive_feedback_count")


@register("a9_box_feedback_by_rating", with_reviews(_B9_BODY, *imputed_ctes(), *_B9_CTES))
def q_a9(spark, d):
    return round_doubles(A.box_stats(imputed(spark, d, [R.rating, R.feedback]), R.rating, R.feedback))


@register(
    "a10_group_counts_division_department",
    with_reviews(
        'SELECT division_name, department_name, CAST(count(*) AS BIGINT) AS "count" FROM cleaned GROUP BY division_name, department_name'
    ),
)
def q_a10(spark, d):
    return A.group_counts(cleaned(spark, d), [R.division, R.department])


@register(
    "a11_group_means_by_division",
    with_reviews(
        "SELECT division_name, "
        + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 4) AS avg_{c}" for c in _NUMERIC)
        + " FROM imputed GROUP BY division_name",
        *imputed_ctes(),
    ),
)
def q_a11(spark, d):
    return round_doubles(A.group_means(imputed(spark, d, [R.division, *_NUMERIC]), R.division, _NUMERIC))


_DIVISIONS = ["General", "General Petite", "Initmates", "Trend"]


@register(
    "a13_pivot_department_by_division",
    with_reviews(
        "SELECT department_name, "
        + ", ".join(
            f"CASE WHEN count(*) FILTER (WHERE division_name = '{v}') = 0 THEN NULL "
            f"ELSE CAST(count(*) FILTER (WHERE division_name = '{v}') AS BIGINT) END AS \"{v}\""
            for v in _DIVISIONS
        )
        + " FROM cleaned WHERE department_name IS NOT NULL AND division_name IS NOT NULL GROUP BY department_name"
    ),
)
def q_a13(spark, d):
    return A.pivot_counts(cleaned(spark, d), R.department, R.division, values=_DIVISIONS)


@register(
    "s4_preview_first_10",
    with_reviews(
        "SELECT * FROM cleaned ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in COLS) + " LIMIT 10"
    ),
)
def q_s4(spark, d):
    return A.preview(cleaned(spark, d), 10)


@register(
    "s2_frame_with_declared_schema",
    with_reviews(
        "SELECT " + ", ".join(f'{c} AS "{f.name}"' for c, f in zip(COLS, G.REVIEW_SCHEMA.fields)) + " FROM raw_n ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in COLS) + " LIMIT 10"
    ),
)
def q_s2(spark, d):
    """The first ten reviews as plain rows, made a frame of the declared schema."""
    return G.reviews_frame(spark, [tuple(r) for r in A.preview(raw_n(spark, d), 10).collect()])


@register("s3_csv_round_trip", with_reviews("SELECT * FROM cleaned"))
def q_s3(spark, d):
    """The cleaned table written as CSV into a folder of its own, and read back."""
    rows = cleaned(spark, d)
    return sinks.read_csv(spark, sinks.write_csv(rows), rows.schema)


_AWKWARD_SQL = """CASE positive_feedback_count % 13 WHEN 0 THEN replace(title, ' ', chr(10)) WHEN 1 THEN replace(title, ' ', chr(34))
  WHEN 2 THEN '  ' || title || chr(9) WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN chr(92) || 'N' WHEN 6 THEN chr(92) || title || chr(92)
  WHEN 7 THEN replace(title, ' ', ',') WHEN 8 THEN chr(13) || chr(10) || title || chr(13) WHEN 9 THEN chr(34) || chr(34)
  WHEN 10 THEN '#' || title || chr(39) || 'é' || chr(34) WHEN 11 THEN 'null' WHEN 12 THEN title || chr(34) || ',' || chr(10) || chr(92) || chr(34) END"""


@register("s3_csv_awkward_text", with_reviews(f"SELECT age, rating, title, positive_feedback_count, {_AWKWARD_SQL} AS awkward FROM raw_n"))
def q_s3_awkward(spark, d):
    """Line ends, quotes, delimiters, padding, backslashes, the null mark itself, empty and null texts: read back as written."""
    text = F.col("title")
    forms = [
        F.replace(text, F.lit(" "), F.lit("\n")),
        F.replace(text, F.lit(" "), F.lit('"')),
        F.concat(F.lit("  "), text, F.lit("\t")),
        F.lit(""),
        F.lit(None).cast("string"),
        F.lit("\\N"),
        F.concat(F.lit("\\"), text, F.lit("\\")),
        F.replace(text, F.lit(" "), F.lit(",")),
        F.concat(F.lit("\r\n"), text, F.lit("\r")),
        F.lit('""'),
        F.concat(F.lit("#"), text, F.lit("'é\"")),
        F.lit("null"),
        F.concat(text, F.lit('",\n\\"')),
    ]
    rest = F.col("positive_feedback_count") % len(forms)
    awkward = F.coalesce(*[F.when(rest == i, form) for i, form in enumerate(forms)])
    rows = raw_n(spark, d).select("age", "rating", "title", "positive_feedback_count", awkward.alias("awkward"))
    return sinks.read_csv(spark, sinks.write_csv(rows, rows_per_file=50_000), rows.schema)


@register(
    "s5_shape_cleaned",
    with_reviews("SELECT CAST(count(*) AS BIGINT) AS n_rows, 9 AS n_cols FROM cleaned"),
)
def q_s5(spark, d):
    return A.shape(cleaned(spark, d))


# --------------------------------------------------------------------------- generator


def lineitem_review_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key per line item, ``"<orderkey>-<linenumber>"``: the generator's row ids."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"))


@register(
    "s1_generate_reviews",
    generator_sql("concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))", "lineitem"),
)
def q_s1(spark, d):
    return G.synthesize_reviews(lineitem_review_keys(spark, d), "review_id", seed=42)


@register(
    "s1_generated_rating_shares",
    "WITH gen AS ("
    + generator_sql("concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))", "lineitem")
    + ') SELECT "Rating" AS rating, CAST(count(*) AS BIGINT) AS "count", '
    'round(count(*) * 1.0 / sum(count(*)) OVER (), 4) AS share FROM gen GROUP BY "Rating"',
)
def q_s1_shares(spark, d):

    gen = G.synthesize_reviews(lineitem_review_keys(spark, d), "review_id", seed=42)
    vc = gen.groupBy(F.col("Rating").alias("rating")).agg(F.count(F.lit(1)).alias("count"))
    total = gen.agg(F.count(F.lit(1)).alias("n")).scalar()
    return round_doubles(vc.select("rating", "count", (F.col("count") / total).alias("share")))


# --------------------------------------------------------------------------- feature preparation and models


ML_COLS = ["age", "rating", "recommended_ind", "positive_feedback_count", "division_name", "department_name", "class_name"]
CATS = ["division_name", "department_name", "class_name"]
REG_NUMS = ["age", "recommended_ind", "positive_feedback_count"]
CLU_NUMS = ["age", "rating", "recommended_ind", "positive_feedback_count"]
CLS_NUMS = ["age", "rating", "positive_feedback_count"]


ML_CTE = "ml AS (SELECT " + ", ".join(ML_COLS) + " FROM imputed)"
_HASHED = ", ".join("coalesce(printf('%.6f', age), '~')" if c == "age" else f"coalesce(CAST({c} AS VARCHAR), '~')" for c in COLS)
#: The split hashes all nine columns of a row, not only the model's.
SPLIT_CTE = (
    "mls AS (SELECT " + ", ".join(ML_COLS) + f", CASE WHEN CAST('0x' || substr(md5('42|' || concat_ws('|', {_HASHED})), 1, 8) AS BIGINT) % 1000 < 800 "
    "THEN 'train' ELSE 'test' END AS split FROM imputed)"
)


def ml_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imputed(spark, sf_dir, ML_COLS)


def split_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    train, test = FE.hash_split(imputed(spark, sf_dir).select(*COLS), (0.8, 0.2), seed=42)
    return train.select(*ML_COLS), test.select(*ML_COLS)


def _index_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", {c} AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS INTEGER) AS label_index, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM imputed GROUP BY {c}"
    )


@register("m1_string_index", with_reviews("\nUNION ALL ".join(_index_sql(c) for c in CATS), *imputed_ctes()))
def q_m1(spark, d):
    ml = ml_frame(spark, d)
    out = FE.index_strings(CATS).fit(ml).transform(ml)
    parts = [
        out.groupBy(F.lit(c).alias("column"), F.col(c).alias("label"), F.col(c + FE.IDX).cast("int").alias("label_index")).agg(
            F.count(F.lit(1)).alias("n_rows")
        )
        for c in CATS
    ]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def _onehot_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", {c} AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS INTEGER) AS hot_slot, "
        f"CAST(count(*) OVER () AS INTEGER) AS vec_size, CAST(count(*) AS BIGINT) AS n_rows FROM imputed GROUP BY {c}"
    )


@register("m2_one_hot", with_reviews("\nUNION ALL ".join(_onehot_sql(c) for c in CATS), *imputed_ctes()))
def q_m2(spark, d):
    ml = ml_frame(spark, d)
    out = Pipeline(stages=[FE.index_strings(CATS), FE.one_hot(CATS)]).fit(ml).transform(ml)
    parts = []
    for c in CATS:
        arr = vector_to_array(F.col(c + FE.VEC))
        parts.append(
            out.groupBy(
                F.lit(c).alias("column"),
                F.col(c).alias("label"),
                (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_slot"),
                F.size(arr).cast("int").alias("vec_size"),
            ).agg(F.count(F.lit(1)).alias("n_rows"))
        )
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@register(
    "m3_hash_split",
    with_reviews("SELECT " + ", ".join(c if c != "age" else "round(age, 4) AS age" for c in ML_COLS) + ", split FROM mls",
                 *imputed_ctes(), ML_CTE, SPLIT_CTE),
)
def q_m3(spark, d):
    return round_doubles(FE.with_split_label(imputed(spark, d).select(*COLS), (0.8, 0.2), seed=42).select(*ML_COLS, "split"))


@register(
    "m8_regression_metrics_group_mean_rule",
    with_reviews(
        "SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((t.rating - m.pred) * (t.rating - m.pred))), 4) AS rmse, "
        "round(avg(abs(t.rating - m.pred)), 4) AS mae, "
        "round(1 - sum((t.rating - m.pred) * (t.rating - m.pred)) / (var_samp(CAST(t.rating AS DOUBLE)) * (count(*) - 1)), 4) AS r2 "
        "FROM mls t JOIN (SELECT division_name, avg(CAST(rating AS DOUBLE)) AS pred FROM mls WHERE split = 'train' GROUP BY division_name) m "
        "ON t.division_name = m.division_name WHERE t.split = 'test'",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)
def q_m8(spark, d):
    train, test = split_frames(spark, d)
    means = train.groupBy(R.division).agg(F.avg(F.col(R.rating).cast("double")).alias("prediction"))
    pred = lookup_join(test, means, on=R.division, how="inner")
    return round_doubles(M.regression_metrics(pred, R.rating, "prediction"))


_RULE = "CASE WHEN rating >= 4 THEN 1.0 ELSE 0.0 END"


def rule_predictions(spark: SparkSession, d: str) -> DataFrame:
    """A fixed rule (recommend when rating >= 4) on the test split: checks the metric operators."""
    _, test = split_frames(spark, d)
    return test.withColumn("prediction", F.when(F.col(R.rating) >= 4, F.lit(1.0)).otherwise(F.lit(0.0)))


@register(
    "m12_confusion_matrix_rule",
    with_reviews(
        f"SELECT recommended_ind, CAST(count(*) FILTER (WHERE {_RULE} = 0.0) AS BIGINT) AS pred_0, "
        f"CAST(count(*) FILTER (WHERE {_RULE} = 1.0) AS BIGINT) AS pred_1 FROM mls WHERE split = 'test' GROUP BY recommended_ind",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)
def q_m12(spark, d):
    return M.confusion_matrix(rule_predictions(spark, d), R.recommended, "prediction")


@register(
    "m12_confusion_unlisted_label",
    with_reviews(
        f"SELECT recommended_ind, CAST(count(*) FILTER (WHERE {_RULE} = 1.0) AS BIGINT) AS pred_1, "
        f"CAST(count(*) FILTER (WHERE {_RULE} <> 1.0) AS BIGINT) AS pred_other FROM mls WHERE split = 'test' GROUP BY recommended_ind",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)
def q_m12_other(spark, d):
    return M.confusion_matrix(rule_predictions(spark, d), R.recommended, "prediction", labels=[1.0])


@register(
    "p4_residual_rule",
    with_reviews(
        "SELECT " + ", ".join("round(age, 4) AS age" if c == "age" else c for c in ML_COLS) + f", {_RULE} AS prediction, "
        f"CAST(recommended_ind AS DOUBLE) - {_RULE} AS error FROM mls WHERE split = 'test'",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)
def q_p4(spark, d):
    return round_doubles(M.with_residual(rule_predictions(spark, d), R.recommended, "prediction"))


@register(
    "t4_sample_predictions_rule",
    with_reviews(
        f"SELECT recommended_ind, {_RULE} AS prediction FROM mls WHERE split = 'test' ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in ML_COLS) + " LIMIT 10",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)
def q_t4(spark, d):
    return MO.sample_predictions(rule_predictions(spark, d), 10, ML_COLS, [R.recommended, "prediction"])


@register(
    "m9_scaled_slot_std",
    with_reviews(
        "\nUNION ALL ".join(f"SELECT {i} AS slot, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std FROM imputed" for i, c in enumerate(CLU_NUMS)),
        *imputed_ctes(),
    ),
)
def q_m9_std(spark, d):
    """The spreads that ``kmeans_sweep(scale=True)`` divides by, from the weighted distinct rows."""
    points = FE.weighted_distinct(ml_frame(spark, d), CLU_NUMS + CATS)
    prep = FE.fit_weighted_preparation(points, CLU_NUMS, CATS, out="raw_features")
    return round_doubles(MO.slot_std(prep.transform(points), "raw_features", "weight").filter(F.col("slot") < len(CLU_NUMS)))


@register(
    "m15_classification_metrics_rule",
    with_reviews(
        """SELECT CAST(sum(n_actual) AS BIGINT) AS n, round(sum(tp) / sum(n_actual), 4) AS accuracy,
       round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END * n_actual) / sum(n_actual), 4) AS f1
FROM (SELECT a.label, a.n_actual, a.tp, CASE WHEN coalesce(p.n_pred, 0) > 0 THEN a.tp / p.n_pred ELSE 0.0 END AS prec,
             a.tp / a.n_actual AS rec
      FROM (SELECT CAST(recommended_ind AS DOUBLE) AS label, count(*) AS n_actual,
                   sum(CASE WHEN CAST(recommended_ind AS DOUBLE) = pr THEN 1 ELSE 0 END) AS tp
            FROM (SELECT *, """ + _RULE + """ AS pr FROM mls WHERE split = 'test') x GROUP BY 1) a
      LEFT JOIN (SELECT """ + _RULE + """ AS label, count(*) AS n_pred FROM mls WHERE split = 'test' GROUP BY 1) p
      ON a.label = p.label) per""",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)


def q_m15(spark, d):
    return round_doubles(M.classification_metrics(rule_predictions(spark, d), R.recommended, "prediction"))


# Fitted models that SQL can state: least squares on three numeric columns, one split of one tree.

_TRAIN_SUMS = "cv AS (SELECT " + ", ".join(
    f"covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS s{i}{j}"
    for i, a in enumerate(REG_NUMS)
    for j, b in [*enumerate(REG_NUMS), (9, "rating")]
) + ", " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}" for i, c in [*enumerate(REG_NUMS), (9, "rating")]) + " FROM mls WHERE split = 'train')"


def _det(columns: list[str]) -> str:
    """The determinant of the 3 x 3 matrix whose columns are s0c, s1c, s2c."""
    a, b, c = ([f"s{i}{k}" for i in range(3)] for k in columns)
    return (
        f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]})"
        f" + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))"
    )


_SOLVED = "co AS (SELECT *, m9 - b0 * m0 - b1 * m1 - b2 * m2 AS icpt FROM (SELECT *, " + ", ".join(
    f"{_det(['9' if k == j else str(k) for k in range(3)])} / {_det(['0', '1', '2'])} AS b{j}" for j in range(3)
) + " FROM cv) t)"
_FIT_CTES = [*imputed_ctes(), ML_CTE, SPLIT_CTE, _TRAIN_SUMS, _SOLVED]
_FITTED = "icpt + " + " + ".join(f"b{i} * CAST({c} AS DOUBLE)" for i, c in enumerate(REG_NUMS))


def _numeric_fit(spark, d):
    train, test = split_frames(spark, d)
    return MO.fit_regression(train, test, REG_NUMS, [], label=R.rating)


@register(
    "m7_numeric_regression_coefficients",
    with_reviews(
        "SELECT -1 AS slot, 'intercept' AS feature, round(icpt, 4) AS coefficient FROM co "
        + " ".join(f"UNION ALL SELECT {i}, '{c}', round(b{i}, 4) FROM co" for i, c in enumerate(REG_NUMS)),
        *_FIT_CTES,
    ),
)
def q_m7_numeric(spark, d):
    return round_doubles(MO.coefficients(_numeric_fit(spark, d)))


@register(
    "m6_numeric_regression_predictions",
    with_reviews(
        "SELECT " + ", ".join("round(age, 4) AS age" if c == "age" else c for c in ML_COLS)
        + f", round({_FITTED}, 4) AS prediction, round(rating - ({_FITTED}), 4) AS error FROM mls, co WHERE split = 'test'",
        *_FIT_CTES,
    ),
)
def q_m6_numeric(spark, d):
    return round_doubles(M.with_residual(_numeric_fit(spark, d).predictions.select(*ML_COLS, "prediction"), R.rating, "prediction"))


@register(
    "m8_numeric_regression_metrics",
    with_reviews(
        "SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, "
        "round(1 - sum(e * e) / (var_samp(y) * (count(*) - 1)), 4) AS r2 "
        f"FROM (SELECT CAST(rating AS DOUBLE) AS y, rating - ({_FITTED}) AS e FROM mls, co WHERE split = 'test') t",
        *_FIT_CTES,
    ),
)
def q_m8_numeric(spark, d):
    return round_doubles(_numeric_fit(spark, d).metrics)


_CENTRES = (25.0, 40.0, 60.0)
_NEAREST = "CASE " + " ".join(
    f"WHEN abs(age - {c}) = least({', '.join(f'abs(age - {x})' for x in _CENTRES)}) THEN {i}" for i, c in enumerate(_CENTRES)
) + " END"
_LABELLED = f"lab AS (SELECT *, {_NEAREST} AS cluster FROM ml)"


def _labelled(spark, d):
    """Every row with the nearest of three fixed centres on the age axis, and a weight of one."""
    away = F.array(*[F.struct(F.abs(F.col(R.age) - c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(_CENTRES)])
    return ml_frame(spark, d).withColumn("prediction", F.array_min(away)["i"])


@register(
    "m11_profile_fixed_centres",
    with_reviews(
        "SELECT cluster, CAST(count(*) AS BIGINT) AS size, "
        + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 4) AS avg_{c}" for c in CLU_NUMS) + " FROM lab GROUP BY cluster",
        *imputed_ctes(), ML_CTE, _LABELLED,
    ),
)
def q_m11_fixed(spark, d):
    points = FE.weighted_distinct(_labelled(spark, d), [*CLU_NUMS, "prediction"])
    return round_doubles(MO.cluster_profile(points, CLU_NUMS, weight="weight"))


@register(
    "m11_division_by_fixed_cluster",
    with_reviews(
        "SELECT division_name, " + ", ".join(f'CAST(count(*) FILTER (WHERE cluster = {i}) AS BIGINT) AS "{i}"' for i in range(3))
        + " FROM lab GROUP BY division_name",
        *imputed_ctes(), ML_CTE, _LABELLED,
    ),
)
def q_m11_div_fixed(spark, d):
    return MO.cluster_by_group(_labelled(spark, d), R.division, 3)


_SPLIT_CTES = [
    *imputed_ctes(), ML_CTE, SPLIT_CTE,
    "tr AS (SELECT rating, recommended_ind AS y FROM mls WHERE split = 'train')",
    "cuts AS (SELECT t.v + 0.5 AS cut FROM (SELECT DISTINCT rating AS v FROM tr) t WHERE t.v < (SELECT max(rating) FROM tr))",
    "parts AS (SELECT cut, rating > cut AS up, count(*) AS n, avg(CAST(y AS DOUBLE)) AS p FROM tr, cuts GROUP BY cut, rating > cut)",
    # The purest cut: least weighted Gini impurity, the lower one of equal cuts.
    "won AS (SELECT cut FROM parts GROUP BY cut ORDER BY sum(n * 2 * p * (1 - p)), cut LIMIT 1)",
    "leaf AS (SELECT up, p, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, cut FROM parts JOIN won USING (cut))",
    "judged AS (SELECT m.*, l.p, l.prediction FROM mls m JOIN leaf l ON (m.rating > l.cut) = l.up WHERE m.split = 'test')",
]


def _one_split(spark, d):
    """One tree of depth one on the rating, every training row once."""
    train, test = split_frames(spark, d)
    return MO.fit_classifier(train, test, [R.rating], [], label=R.recommended, num_trees=1, max_depth=1, bootstrap=False)


@register(
    "m13_one_split_predictions",
    with_reviews("SELECT " + ", ".join("round(age, 4) AS age" if c == "age" else c for c in ML_COLS) + ", prediction FROM judged", *_SPLIT_CTES),
)
def q_m13_one(spark, d):
    return round_doubles(_one_split(spark, d).predictions.select(*ML_COLS, "prediction"))


@register(
    "m15_one_split_metrics",
    with_reviews(
        """SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(tp) / sum(n), 4) AS accuracy,
       round(sum(CASE WHEN tp > 0 THEN 2.0 * tp / (n + m) ELSE 0 END * n) / sum(n), 4) AS f1
FROM (SELECT y, count(*) FILTER (WHERE a = y) AS n, count(*) FILTER (WHERE b = y) AS m, count(*) FILTER (WHERE a = y AND b = y) AS tp
      FROM (SELECT CAST(recommended_ind AS DOUBLE) AS a, prediction AS b FROM judged) t, (VALUES (0.0), (1.0)) v(y) GROUP BY y) per WHERE n > 0""",
        *_SPLIT_CTES,
    ),
)
def q_m15_one(spark, d):
    return round_doubles(_one_split(spark, d).metrics)


@register(
    "m16_one_split_probability_sample",
    with_reviews(
        "SELECT recommended_ind, prediction, '[' || printf('%.6f', 1 - p) || ', ' || printf('%.6f', p) || ']' AS probability_text FROM judged ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in ML_COLS) + " LIMIT 10",
        *_SPLIT_CTES,
    ),
)
def q_m16_one(spark, d):
    pred = MO.vector_as_text(_one_split(spark, d).predictions, "probability")
    return MO.sample_predictions(pred, 10, ML_COLS, [R.recommended, "prediction", "probability_text"])


# The regression that the recipe fits: three numbers and three one-hot columns, collinear among themselves.


_LS_CTES = (*imputed_ctes(), ML_CTE, SPLIT_CTE, *least_squares_ctes("(SELECT * FROM mls WHERE split = 'train')", REG_NUMS, CATS, "rating"))
_LS_TEST = f"lst AS (SELECT t.*, {least_squares_prediction('t', REG_NUMS, CATS)} AS prediction FROM mls t WHERE t.split = 'test')"


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register(
    "m6_gram_entries",
    _recursive(with_reviews("SELECT CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j, round(s, 4) AS total FROM rgram WHERE i <= j AND s <> 0", *_LS_CTES)),
)
def q_m6_gram(spark, d):
    """Sums of products of intercept, features and label over the training rows, where not zero."""
    train, _ = split_frames(spark, d)
    points = FE.weighted_distinct(train, [*REG_NUMS, *CATS, R.rating])
    prepared = FE.fit_weighted_preparation(points, REG_NUMS, CATS).transform(points)
    return round_doubles(LN.gram(prepared, R.rating, weight="weight").filter("total <> 0"))


@register(
    "m6_linear_regression_predictions",
    _recursive(with_reviews(f"SELECT {', '.join(c if c != 'age' else 'round(age, 4) AS age' for c in ML_COLS)}, round(prediction, 4) AS prediction, round(rating - prediction, 4) + 0.0 AS error FROM lst", *_LS_CTES, _LS_TEST)),
)
def q_m6(spark, d):
    train, test = split_frames(spark, d)
    res = MO.fit_regression(train, test, REG_NUMS, CATS, label=R.rating)
    out = round_doubles(M.with_residual(res.predictions.select(*ML_COLS, "prediction"), R.rating, "prediction"))
    return out.withColumn("error", F.col("error") + F.lit(0.0))  # no negative zero


_LS_COEF = "SELECT CAST(slot - 2 AS INTEGER) AS slot, name AS feature, round(b, 4) AS coefficient FROM rbeta UNION ALL SELECT -1, 'intercept', round(b, 4) FROM ricpt"


@register("m7_regression_coefficients", _recursive(with_reviews(_LS_COEF, *_LS_CTES)))
def q_m7(spark, d):
    train, test = split_frames(spark, d)
    return round_doubles(MO.coefficients(MO.fit_regression(train, test, REG_NUMS, CATS, label=R.rating)))


_LS_METRICS = _recursive(
    with_reviews(
        "SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((rating - prediction) * (rating - prediction))), 4) AS rmse, round(avg(abs(rating - prediction)), 4) AS mae, "
        "round(1 - sum((rating - prediction) * (rating - prediction)) / (var_samp(CAST(rating AS DOUBLE)) * (count(*) - 1)), 4) AS r2 FROM lst",
        *_LS_CTES, _LS_TEST,
    )
)


@register("m8_regression_metrics_linear_model", _LS_METRICS)
def q_m8_lr(spark, d):
    train, test = split_frames(spark, d)
    return round_doubles(MO.fit_regression(train, test, REG_NUMS, CATS, label=R.rating).metrics)


@register("m9_kmeans_sweep")
def q_m9(spark, d):
    return round_doubles(MO.kmeans_sweep(ml_frame(spark, d), CLU_NUMS, CATS, ks=(2, 3, 4, 5), seed=42).table)


_STEPS = 3
_SWEEP_CTES = (*imputed_ctes(), ML_CTE, *sweep_ctes("ml", CLU_NUMS, CATS, (2, 3, 4, 5), _STEPS, doubles=("age",)))


@register(
    "m9_sweep_three_iterations",
    with_reviews(
        "SELECT CAST(a.k AS INTEGER) AS k, CAST(a.c AS INTEGER) AS cluster, CAST(sum(p.w) AS BIGINT) AS size, round(any_value(t.cost), 4) AS wssse "
        f"FROM asg{_STEPS} a JOIN pts p USING (key) JOIN (SELECT k, sum(w * dist) AS cost FROM asg{_STEPS} JOIN pts USING (key) GROUP BY k) t ON t.k = a.k GROUP BY a.k, a.c",
        *_SWEEP_CTES,
    ),
)
def q_m9_three(spark, d):
    """The sweep table after three iterations from the hash-drawn start: cost and size of every cluster of k = 2..5."""
    table = MO.kmeans_sweep(ml_frame(spark, d), CLU_NUMS, CATS, ks=(2, 3, 4, 5), seed=42, iterations=_STEPS, tol=0.0).table
    return round_doubles(table.select("k", F.posexplode("sizes").alias("cluster", "size"), "wssse"))


_ELBOW_CTES = (
    "costs AS (SELECT class_name, k, CAST(count(*) FILTER (rating >= k) AS DOUBLE) AS wssse FROM cleaned, (SELECT unnest(range(1, 6)) AS k) GROUP BY class_name, k)",
    "drops AS (SELECT class_name, k, (lag(wssse) OVER c - wssse) / greatest(lag(wssse) OVER c, 1e-12) AS fall FROM costs WINDOW c AS (PARTITION BY class_name ORDER BY k))",
    "gains AS (SELECT class_name, k, fall - lead(fall) OVER (PARTITION BY class_name ORDER BY k) AS gain FROM drops)",
)


@register(
    "m10_elbow",
    with_reviews(
        "SELECT class_name, CAST(coalesce((SELECT g.k FROM gains g WHERE g.class_name = c.class_name AND g.gain IS NOT NULL ORDER BY gain DESC, k LIMIT 1), max(k)) AS INTEGER) AS k "
        "FROM costs c GROUP BY class_name",
        *_ELBOW_CTES,
    ),
)
def q_m10_elbow(spark, d):
    """The elbow of one falling curve per class: its reviews rated k or better."""
    curves = cleaned(spark, d).groupBy("class_name").agg(*[F.count_if(F.col("rating") >= k).cast("double").alias(str(k)) for k in range(1, 6)])
    costs = curves.unpivot("class_name", [str(k) for k in range(1, 6)], "k", "wssse").withColumn("k", F.col("k").cast("int"))
    return KM.elbow(costs, ["class_name"])


def _k3(spark, d):
    return MO.kmeans_sweep(ml_frame(spark, d), CLU_NUMS, CATS, ks=(3,), seed=42)


@register("m10_kmeans_assign_k3")
def q_m10(spark, d):
    return MO.kmeans_assign(_k3(spark, d), 3).select(*ML_COLS, F.col("prediction").alias("cluster"))


@register("m11_cluster_profile")
def q_m11(spark, d):
    return round_doubles(MO.cluster_profile(MO.assign_points(_k3(spark, d), 3), CLU_NUMS, weight="weight"))


@register("m11_division_by_cluster")
def q_m11_div(spark, d):
    return MO.cluster_by_group(MO.assign_points(_k3(spark, d), 3), R.division, 3, weight="weight")


# A forest that SQL can state: two trees of depth two, every part of the ten-tree one below.


_FOREST_CTES = (
    *imputed_ctes(), ML_CTE, SPLIT_CTE,
    *forest_ctes("(SELECT * FROM mls WHERE split = 'train')", "mls WHERE split = 'test'", CLS_NUMS, CATS, "recommended_ind", 2, 2, doubles=("age",)),
    "fsplit AS (SELECT *, 0 AS lvl FROM fbest0 UNION ALL SELECT *, 1 FROM fbest1)",
    "fimp AS (SELECT name, sum(g / w) / (SELECT count(DISTINCT t) FROM fsplit) AS importance FROM (SELECT t, slot, sum(gain * n) AS g FROM fsplit GROUP BY t, slot) "
    "JOIN (SELECT t, sum(gain * n) AS w FROM fsplit GROUP BY t) USING (t) JOIN fname USING (slot) GROUP BY name)",
)


def _two_trees(spark, d):
    train, test = split_frames(spark, d)
    return MO.fit_classifier(train, test, CLS_NUMS, CATS, label=R.recommended, num_trees=2, max_depth=2, seed=42)


@register(
    "m13_two_trees_predictions",
    with_reviews(f"SELECT {', '.join(c if c != 'age' else 'round(age, 4) AS age' for c in ML_COLS)}, prediction, round(p1, 4) AS p1 FROM fpred", *_FOREST_CTES),
)
def q_m13_two(spark, d):
    pred = _two_trees(spark, d).predictions
    return round_doubles(pred.select(*ML_COLS, "prediction", vector_to_array("probability")[1].alias("p1")))


@register(
    "m14_two_trees_splits",
    with_reviews(
        "SELECT CAST(t AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, name AS feature, round(v, 4) AS threshold, round(gain, 4) AS gain, round(n, 4) AS n_rows FROM fsplit JOIN fname USING (slot)",
        *_FOREST_CTES,
    ),
)
def q_m14_splits(spark, d):
    """Every split with its gain: what importances are made of."""
    return round_doubles(_two_trees(spark, d).splits.drop("slot"))


@register(
    "m14_two_trees_importance",
    with_reviews(
        "SELECT CASE WHEN position('_vec_' IN name) > 0 THEN left(name, position('_vec_' IN name) - 1) ELSE name END AS feature, "
        "round(sum(coalesce(importance, 0)), 4) AS importance FROM fname LEFT JOIN fimp USING (name) GROUP BY 1 ORDER BY 2 DESC, 1",
        *_FOREST_CTES,
    ),
)
def q_m14_two(spark, d):
    """Importance by source column, largest first."""
    return round_doubles(MO.feature_importance(_two_trees(spark, d), CLS_NUMS + [c + FE.VEC for c in CATS]))


def _forest(spark, d):
    train, test = split_frames(spark, d)
    return MO.fit_classifier(train, test, CLS_NUMS, CATS, label=R.recommended, num_trees=10, seed=42)


@register("m13_random_forest_predictions")
def q_m13(spark, d):
    return _forest(spark, d).predictions.select(*ML_COLS, "prediction")


@register("m14_feature_importance")
def q_m14(spark, d):
    return round_doubles(MO.feature_importance(_forest(spark, d), CLS_NUMS + [c + FE.VEC for c in CATS]))


@register("m15_classification_metrics_forest")
def q_m15_rf(spark, d):
    return round_doubles(_forest(spark, d).metrics)


@register("m16_probability_sample")
def q_m16(spark, d):
    pred = MO.vector_as_text(_forest(spark, d).predictions, "probability")
    return MO.sample_predictions(pred, 10, ML_COLS, [R.recommended, "prediction", "probability_text"])


@register(
    "a12_group_mode_department_by_division",
    with_reviews(
        "SELECT division_name, fill AS \"mode\" FROM gm_gm",
        *group_mode_ctes("gm", "cleaned", "department_name", "division_name"),
    ),
)
def q_a12(spark, d):
    return N.group_modes(cleaned(spark, d), R.department, R.division)


def _assembled_ml(spark, d):
    """The k-means feature set, indexed on every row, assembled."""
    ml = ml_frame(spark, d)
    return FE.feature_pipeline(CLU_NUMS, CATS).fit(ml).transform(ml)


def _slot_sql(offset: str, c: str) -> str:
    return (
        f"SELECT CAST({offset} + idx AS INTEGER) AS slot, '{c}_vec_' || label AS feature, round(CAST(n AS DOUBLE), 4) AS total FROM "
        f"(SELECT {c} AS label, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS idx FROM imputed GROUP BY {c}) t"
    )


_ND = "(SELECT count(DISTINCT division_name) FROM imputed)"
_NP = "(SELECT count(DISTINCT department_name) FROM imputed)"
_M4_SQL = with_reviews(
    "\nUNION ALL ".join(
        [
            f"SELECT {i} AS slot, '{c}' AS feature, round(sum(CAST({c} AS DOUBLE)), 4) AS total FROM imputed"
            for i, c in enumerate(CLU_NUMS)
        ]
        + [
            _slot_sql("4", "division_name"),
            _slot_sql(f"4 + {_ND}", "department_name"),
            _slot_sql(f"4 + {_ND} + {_NP}", "class_name"),
        ]
    ),
    *imputed_ctes(),
)


@register("m4_assembled_feature_sums", _M4_SQL)
def q_m4(spark, d):
    return round_doubles(FE.vector_sums(_assembled_ml(spark, d)))


_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ML_COLS)
_M9_SQL = with_reviews(
    "SELECT CAST(a.cl AS INTEGER) AS cluster, round(CAST(count(*) AS DOUBLE), 4) AS n, round(sum(a.d2), 4) AS cost, "
    + ", ".join(f"round(avg(CAST(r.{c} AS DOUBLE)), 4) AS centre_{c}" for c in CLU_NUMS)
    + " FROM asg a JOIN rows_ r ON a.rid = r.rid GROUP BY a.cl",
    *imputed_ctes(),
    ML_CTE,
    f"cen AS (SELECT row_number() OVER (ORDER BY {_ORDER}) - 1 AS ci, * FROM (SELECT DISTINCT * FROM ml) u ORDER BY {_ORDER} LIMIT 3)",
    "rows_ AS (SELECT row_number() OVER () AS rid, * FROM ml)",
    "cd AS (SELECT r.rid, c.ci, "
    + " + ".join(f"(CAST(r.{x} AS DOUBLE) - CAST(c.{x} AS DOUBLE)) * (CAST(r.{x} AS DOUBLE) - CAST(c.{x} AS DOUBLE))" for x in CLU_NUMS)
    + " + "
    + " + ".join(f"CASE WHEN r.{x} = c.{x} THEN 0 ELSE 2 END" for x in CATS)
    + " AS d2 FROM rows_ r, cen c)",
    "best AS (SELECT rid, min(d2) AS d2 FROM cd GROUP BY rid)",
    "asg AS (SELECT cd.rid, min(cd.ci) AS cl, min(cd.d2) AS d2 FROM cd JOIN best b ON cd.rid = b.rid AND cd.d2 = b.d2 GROUP BY cd.rid)",
)


@register("m9_lloyd_step_fixed_centres", _M9_SQL)
def q_m9_step(spark, d):
    """One assignment + update step from three fixed centres: the first three
    distinct model rows in column order (k model-sized vectors reach the driver)."""
    ml = ml_frame(spark, d)
    prep = FE.feature_pipeline(CLU_NUMS, CATS).fit(ml)
    first = A.preview(ml.distinct(), 3, ML_COLS)
    ordered = prep.transform(first).orderBy(*[F.asc_nulls_first(c) for c in ML_COLS])
    centres = [r.c for r in ordered.select(vector_to_array("features").alias("c")).collect()]
    step = MO.lloyd_step(prep.transform(ml), centres)
    return round_doubles(
        step.select("cluster", "n", "cost", *[F.col("centre")[i].alias(f"centre_{c}") for i, c in enumerate(CLU_NUMS)])
    )


@register(
    "a6_value_counts_many",
    with_reviews(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS \"count\" "
            f"FROM imputed WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in ["rating", "division_name", "department_name", "class_name"]
        ),
        *imputed_ctes(),
    ),
)
def q_a6_many(spark, d):
    return A.value_counts_many(imputed(spark, d, [R.rating, R.division, R.department, R.klass]), [R.rating, R.division, R.department, R.klass])


_GEN_COLS = [f.name for f in G.REVIEW_SCHEMA.fields]
_GEN_NUMERIC = {"Age", "Rating", "Recommended_IND", "Positive_Feedback_Count"}


def _describe_generated_sql() -> str:
    parts = []
    for c in _GEN_COLS:
        q = f'"{c}"'
        mean, sd = (f"round(avg({q}), 4)", f"round(stddev_samp({q}), 4)") if c in _GEN_NUMERIC else (
            "CAST(NULL AS DOUBLE)",
            "CAST(NULL AS DOUBLE)",
        )
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({q}) AS BIGINT) AS \"count\", {mean} AS \"mean\", {sd} AS stddev, "
            f"CAST(min({q}) AS VARCHAR) AS \"min\", CAST(max({q}) AS VARCHAR) AS \"max\" FROM gen"
        )
    return (
        "WITH gen AS ("
        + generator_sql("concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))", "lineitem")
        + ")\n"
        + "\nUNION ALL ".join(parts)
    )


@register("a1_describe_generated", _describe_generated_sql())
def q_a1_generated(spark, d):
    gen = G.synthesize_reviews(lineitem_review_keys(spark, d), "review_id", seed=42, keep_id=False)
    return round_doubles(A.describe_all(gen))


# --------------------------------------------------------------------------- recipes


@register("e1_prepare_data", with_reviews(select_with("imputed", age="round(age, 4)"), *imputed_ctes()))
def q_e1(spark, d):
    """The prepared table through the recipe itself, with the exact median."""
    return round_doubles(E.prepare(reviews(spark, d), median_method="exact").data)


@register("e1_clean_report", _C6_SQL)
def q_e1_report(spark, d):
    return E.prepare(reviews(spark, d), median_method="exact").clean_report


def _generated(body: str, *ctes: str) -> str:
    """``body`` over the generated reviews of the line items, cleaned and imputed."""
    gen = generator_sql("concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR))", "lineitem")
    names = ", ".join(f'"{f.name}" AS {f.name.lower()}' for f in G.REVIEW_SCHEMA.fields)
    parts = [f"gen AS ({gen})", f"raw_n AS (SELECT {names} FROM gen)", "deduped AS (SELECT DISTINCT * FROM raw_n)", f"cleaned AS (SELECT * FROM deduped WHERE {CLEAN_WHERE})", *imputed_ctes(), *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


_E1_GENERATED = _generated(select_with("imputed", age="round(age, 4)"))


def _prepared_from_generator(spark, d, method):
    gen = G.synthesize_reviews(lineitem_review_keys(spark, d), "review_id", seed=42, keep_id=False)
    return round_doubles(E.prepare(gen, median_method=method).data)


@register("e1_generate_clean_impute", _E1_GENERATED)
def q_e1_generated(spark, d):
    """The first path of all: generate, clean, impute, with the recipe's own (sketched) median."""
    return _prepared_from_generator(spark, d, "approx")


@register("e1_generate_clean_impute_exact", _E1_GENERATED)
def q_e1_generated_exact(spark, d):
    return _prepared_from_generator(spark, d, "exact")


@register("e2_rating_vs_recommended", _A7_SQL)
def q_e2(spark, d):
    return E.explore(cleaned(spark, d))["rating_vs_recommended"]


_KI_CTES, _KI_BODY = _kde_binned_sql("imputed", "age")
#: The other nine tables of the bundle, each as SQL states it over the imputed reviews.
_EXPLORED = {
    "summary": (_summary_sql("imputed"), ()),
    "age_histogram": (_H_BODY, _H_CTES),
    "age_kde": (_KI_BODY.format(scale="1"), _KI_CTES),
    "rating_counts": (_value_counts_sql("imputed", "rating"), ()),
    "division_counts": (_value_counts_sql("imputed", "division_name"), ()),
    "department_counts": (_value_counts_sql("imputed", "department_name"), ()),
    "class_counts": (_value_counts_sql("imputed", "class_name"), ()),
    "rating_by_division": (_B8_BODY, _B8_CTES),
    "feedback_by_rating": (_B9_BODY, _B9_CTES),
}


def _register_explored(table: str) -> None:
    body, ctes = _EXPLORED[table]

    @register(f"e2_{table}", with_reviews(body, *imputed_ctes(), *ctes))
    def q_e2_table(spark, d):
        return round_doubles(E.explore(imputed(spark, d))[table])


for _table in _EXPLORED:
    _register_explored(_table)


@register(
    "e3_split_sizes",
    with_reviews("SELECT split, count(*) AS n_rows, CAST(sum(rating) AS BIGINT) AS rating_sum FROM mls GROUP BY split", *imputed_ctes(), ML_CTE, SPLIT_CTE),
)
def q_e3_split(spark, d):
    """The recipes' own split, by the rows and ratings on each side."""
    _, train, test = E.ml_split(imputed(spark, d).select(*COLS))
    sides = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return sides.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("rating").cast("bigint").alias("rating_sum"))


@register(
    "e4_division_totals",
    with_reviews("SELECT division_name, CAST(count(*) AS BIGINT) AS n_rows FROM imputed GROUP BY division_name", *imputed_ctes()),
)
def q_e4(spark, d):
    """The segmentation recipe: its clusters together hold every row of each division once."""
    table = E.run_segmentation(imputed(spark, d, ML_COLS))["division_by_cluster"]
    clusters = [c for c in table.columns if c != R.division]
    return table.select(R.division, sum((F.col(f"`{c}`") for c in clusters), F.lit(0)).cast("bigint").alias("n_rows"))


@register(
    "e4_profile",
    with_reviews(
        "SELECT CAST(a.c AS INTEGER) AS cluster, CAST(sum(p.w) AS BIGINT) AS size, "
        + ", ".join(f"round(sum(p.w * CAST(p.{c} AS DOUBLE)) / sum(p.w), 4) AS avg_{c}" for c in CLU_NUMS)
        + f" FROM asg{_STEPS} a JOIN pts p USING (key) WHERE a.k = 3 GROUP BY a.c",
        *_SWEEP_CTES,
    ),
)
def q_e4_profile(spark, d):
    """The segmentation recipe's clusters (k = 3 after three iterations) by size and means."""
    return round_doubles(E.run_segmentation(imputed(spark, d, ML_COLS), iterations=_STEPS, tol=0.0)["profile"])


@register(
    "e4_division_by_cluster",
    with_reviews(
        "SELECT p.division_name, " + ", ".join(f'CAST(coalesce(sum(p.w) FILTER (a.c = {i}), 0) AS BIGINT) AS "{i}"' for i in range(3))
        + f" FROM asg{_STEPS} a JOIN pts p USING (key) WHERE a.k = 3 GROUP BY p.division_name",
        *_SWEEP_CTES,
    ),
)
def q_e4_division(spark, d):
    """The recipe's division x cluster table, cell by cell."""
    return E.run_segmentation(imputed(spark, d, ML_COLS), iterations=_STEPS, tol=0.0)["division_by_cluster"]


@register("e3_metrics", _LS_METRICS)
def q_e3_metrics(spark, d):
    """The regression recipe's metrics."""
    return round_doubles(E.run_regression(imputed(spark, d))["metrics"])


@register("e3_coefficients", _recursive(with_reviews(_LS_COEF, *_LS_CTES)))
def q_e3_coefficients(spark, d):
    return round_doubles(E.run_regression(imputed(spark, d))["coefficients"])


@register(
    "e5_confusion",
    with_reviews(
        "SELECT recommended_ind, CAST(count(*) FILTER (prediction = 0) AS BIGINT) AS pred_0, CAST(count(*) FILTER (prediction = 1) AS BIGINT) AS pred_1 FROM fpred GROUP BY recommended_ind",
        *_FOREST_CTES,
    ),
)
def q_e5_cells(spark, d):
    """The classification recipe's confusion matrix, cell by cell (two trees of depth two)."""
    table = E.run_classification(imputed(spark, d), num_trees=2, max_depth=2)["confusion"]
    return table.select(R.recommended, *[(F.col(c) if c in table.columns else F.lit(0).cast("bigint")).alias(c) for c in ("pred_0", "pred_1")])


@register(
    "e5_probability_sample",
    with_reviews(
        "SELECT recommended_ind, prediction, '[' || printf('%.6f', p0) || ', ' || printf('%.6f', p1) || ']' AS probability_text FROM fpred ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in ML_COLS) + " LIMIT 10",
        *_FOREST_CTES,
    ),
)
def q_e5_sample(spark, d):
    return E.run_classification(imputed(spark, d), num_trees=2, max_depth=2)["sample"]


@register(
    "e5_confusion_totals",
    with_reviews(
        "SELECT recommended_ind, CAST(count(*) AS BIGINT) AS n_rows FROM mls WHERE split = 'test' GROUP BY recommended_ind",
        *imputed_ctes(), ML_CTE, SPLIT_CTE,
    ),
)
def q_e5(spark, d):
    """The classification recipe: its confusion matrix holds every test row once."""
    table = E.run_classification(imputed(spark, d), compress=True)["confusion"]
    predicted = [c for c in table.columns if c != R.recommended]
    return table.select(R.recommended, sum((F.col(f"`{c}`") for c in predicted), F.lit(0)).cast("bigint").alias("n_rows"))
