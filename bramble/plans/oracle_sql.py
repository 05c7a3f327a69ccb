"""DuckDB statements that state the same answer as each registered Spark query.

They run on DuckDB with the parquet tables registered as views.  Shared CTEs:
``reviews_raw`` (the fixture, verbatim), ``raw_n`` (names normalised) and
``cleaned`` (duplicates removed, validity rules applied).  Doubles are rounded
to 4 digits on both sides; counts are cast to BIGINT on both sides.
"""

from __future__ import annotations

from ..sources.reviews_raw import reviews_raw_duckdb_sql

RAW_N_SELECT = (
    'SELECT "Age" AS age, "Title" AS title, "Review Text" AS review_text, "Rating" AS rating, '
    '"Recommended IND" AS recommended_ind, "Positive Feedback Count" AS positive_feedback_count, '
    '"Division Name" AS division_name, "Department Name" AS department_name, "Class Name" AS class_name '
    "FROM reviews_raw"
)

CLEAN_WHERE = (
    "age IS NOT NULL AND age > 0 AND age < 100 "
    "AND rating IS NOT NULL AND rating >= 1 AND rating <= 5 "
    "AND recommended_ind IS NOT NULL AND recommended_ind IN (0, 1)"
)


def with_reviews(body: str, *extra_ctes: str) -> str:
    """Prefix ``body`` with the shared CTEs (and any extra ``name AS (...)`` CTEs)."""
    ctes = [
        f"reviews_raw AS (\n{reviews_raw_duckdb_sql()}\n)",
        f"raw_n AS ({RAW_N_SELECT})",
        "deduped AS (SELECT DISTINCT * FROM raw_n)",
        f"cleaned AS (SELECT * FROM deduped WHERE {CLEAN_WHERE})",
        *extra_ctes,
    ]
    return "WITH " + ",\n".join(ctes) + "\n" + body


COLS = [
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


def select_with(source: str, **overrides: str) -> str:
    """``SELECT`` every review column from ``source``, replacing some by expressions."""
    exprs = [f"{overrides[c]} AS {c}" if c in overrides else c for c in COLS]
    return f"SELECT {', '.join(exprs)} FROM {source}"


def mode_sql(source: str, c: str) -> str:
    """Scalar subquery: most frequent non-null value, ties to the smallest."""
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)"


def group_mode_ctes(prefix: str, source: str, c: str, by: str) -> list[str]:
    """CTEs ``{prefix}_gm(by, fill)``: per-group mode of ``c``."""
    return [
        f"{prefix}_dc AS (SELECT {by}, {c}, count(*) AS n FROM {source} "
        f"WHERE {c} IS NOT NULL AND {by} IS NOT NULL GROUP BY {by}, {c})",
        f"{prefix}_gm AS (SELECT {by}, {c} AS fill FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {by} ORDER BY n DESC, {c} ASC) AS rn FROM {prefix}_dc) t WHERE rn = 1)",
    ]


def group_fill_select(prefix: str, source: str, c: str, by: str) -> str:
    exprs = [f"coalesce(s.{c}, g.fill) AS {c}" if x == c else f"s.{x}" for x in COLS]
    return f"SELECT {', '.join(exprs)} FROM {source} s LEFT JOIN {prefix}_gm g ON s.{by} = g.{by}"


def imputed_ctes(source: str = "cleaned") -> list[str]:
    """The reference's imputation order (exact median), as CTEs ``s1`` .. ``imputed``."""
    return [
        "s1 AS ("
        + select_with(source, age=f"coalesce(CAST(age AS DOUBLE), (SELECT quantile_cont(age, 0.5) FROM {source}))")
        + ")",
        "s2 AS (" + select_with("s1", title="coalesce(title, 'No Title')") + ")",
        "s3 AS (" + select_with("s2", rating=f"coalesce(rating, {mode_sql('s2', 'rating')})") + ")",
        "s4 AS (" + select_with("s3", division_name=f"coalesce(division_name, {mode_sql('s3', 'division_name')})") + ")",
        *group_mode_ctes("s5", "s4", "department_name", "division_name"),
        "s5 AS (" + group_fill_select("s5", "s4", "department_name", "division_name") + ")",
        "imputed AS ("
        + select_with("s5", department_name=f"coalesce(department_name, {mode_sql('s5', 'department_name')})")
        + ")",
    ]


def _dlit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return repr(v) + "e0" if "e" not in repr(v) else repr(v)
    return str(v)


# What the generated reviews hold, stated here apart from the generator, so that a
# wrong entry there shows.
_TITLES = [
    "Love this {product}!",
    "Not what I expected",
    "Great {product} for the price",
    "Disappointing quality",
    "Perfect fit!",
    "Too small/large",
    "Exactly as described",
    "Beautiful {product}",
    "Not worth the money",
    "Comfortable and stylish",
]
_TEXTS = [
    "I really love this {product}. The quality is excellent and it fits perfectly. Would definitely recommend!",
    "The {product} wasn't what I expected. The color was off and the sizing runs small.",
    "Great {product} for the price! Comfortable material and looks more expensive than it is.",
    "Disappointing quality. The {product} started falling apart after just a few wears.",
    "Perfect fit! This {product} is true to size and very flattering.",
    "This {product} runs too small/large. Had to return it.",
    "The {product} is exactly as described. Very pleased with my purchase.",
    "This is a beautiful {product}. I've received many compliments when wearing it.",
    "Not worth the money. The {product} looks cheap and is poorly made.",
    "This {product} is both comfortable and stylish. I bought it in multiple colors!",
]
_PRODUCTS = ["dress", "blouse", "pants", "jacket", "skirt", "sweater", "top", "jeans", "shorts", "intimates"]
_DIVISIONS = ["General", "General Petite", "Initmates", "Trend"]
_TAGS = "age product division rating department class recommended feedback title text null_age null_title null_rating null_division".split()


def generator_sql(id_expr: str, source: str, seed: int = 42) -> str:
    """DuckDB statement of the review generator, one review per row of ``source``."""

    def u(tag: str) -> str:
        block, slot = divmod(_TAGS.index(tag), 4)
        return f"(CAST('0x' || substr(md5('{seed}:block{block}:' || rid), {8 * slot + 1}, 8) AS BIGINT) / 4294967296e0)"

    def choice(tag: str, values) -> str:
        lst = "[" + ", ".join(_dlit(v) for v in values) + "]"
        return f"({lst})[CAST(floor({u(tag)} * {len(values)}) + 1 AS INTEGER)]"

    def rint(tag: str, lo: int, hi: int) -> str:
        return f"CAST({lo} + floor({u(tag)} * ({hi} - {lo} + 1)) AS INTEGER)"

    rating = (
        f"CASE WHEN {u('rating')} < 0.05e0 THEN 1 WHEN {u('rating')} < 0.15000000000000002e0 THEN 2 "
        f"WHEN {u('rating')} < 0.30000000000000004e0 THEN 3 WHEN {u('rating')} < 0.6e0 THEN 4 ELSE 5 END"
    )

    def bern(p0: str) -> str:
        return f"CASE WHEN {u('recommended')} < {p0} THEN 0 ELSE 1 END"

    dept = (
        "CASE division0 WHEN 'Initmates' THEN 'Intimate' WHEN 'Trend' THEN 'Trend' ELSE "
        + choice("department", ["Tops", "Dresses", "Bottoms", "Jackets"])
        + " END"
    )
    klass = (
        f"CASE department0 WHEN 'Intimate' THEN {choice('class', ['Intimates', 'Sleep'])} WHEN 'Trend' THEN 'Trend' "
        f"WHEN 'Tops' THEN {choice('class', ['Blouses', 'Sweaters'])} WHEN 'Dresses' THEN 'Dresses' "
        f"WHEN 'Bottoms' THEN {choice('class', ['Pants', 'Skirts', 'Jeans', 'Shorts'])} ELSE 'Jackets' END"
    )
    stage1 = (
        f"SELECT {id_expr} AS rid, {rint('age', 18, 70)} AS age0, {choice('product', _PRODUCTS)} AS product0, "
        f"{choice('division', _DIVISIONS)} AS division0, CAST({rating} AS INTEGER) AS rating0 FROM {source}"
    )
    stage2 = f"SELECT *, {dept} AS department0 FROM g1"
    title = f"replace({choice('title', _TITLES)}, '{{product}}', product0)"
    text = f"replace({choice('text', _TEXTS)}, '{{product}}', product0)"
    rec = (
        f"CASE WHEN rating0 >= 4 THEN {bern('0.09999999999999998e0')} WHEN rating0 = 3 THEN {bern('0.5e0')} "
        f"ELSE {bern('0.9e0')} END"
    )
    fb = (
        f"CASE WHEN rating0 >= 4 THEN {rint('feedback', 0, 25)} "
        f"ELSE {rint('feedback', 0, 5)} END"
    )

    def nul(expr: str, tag: str, rate: float) -> str:
        return f"CASE WHEN {u(tag)} < {_dlit(float(rate))} THEN NULL ELSE {expr} END"

    final = (
        "SELECT rid AS review_id, "
        f"CAST({nul('age0', 'null_age', 0.03)} AS INTEGER) AS \"Age\", "
        f"{nul(title, 'null_title', 0.01)} AS \"Title\", {text} AS \"Review_Text\", "
        f"CAST({nul('rating0', 'null_rating', 0.05)} AS INTEGER) AS \"Rating\", "
        f"CAST({rec} AS INTEGER) AS \"Recommended_IND\", CAST({fb} AS INTEGER) AS \"Positive_Feedback_Count\", "
        f"{nul('division0', 'null_division', 0.02)} AS \"Division_Name\", "
        f"department0 AS \"Department_Name\", {klass} AS \"Class_Name\" FROM g2"
    )
    return f"WITH g1 AS ({stage1}), g2 AS ({stage2})\n{final}"
