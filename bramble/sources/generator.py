"""Synthetic review rows.

``synthesize_reviews(df, id_col)`` adds one synthetic review to every row of
``df``, keyed by ``id_col``; ``generate_reviews(spark, n)`` does so for
``spark.range(n)``.  Rows are independent, so generation is a single narrow
projection that scales with the number of partitions of the key frame.
Dependants (department, class, recommendation, feedback) are drawn before the
nulls are injected, as in the reference, so a row whose rating is null still
has a rating-shaped recommendation and feedback count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.random_cols import (
    conditional_bernoulli,
    dependent_choice,
    digest,
    draw,
    fill_template,
    null_with_rate,
    rand_choice,
    rand_int,
    weighted_choice,
)

# The reference's generator vocabulary and rates, in its order.
DIVISIONS = ["General", "General Petite", "Initmates", "Trend"]
TITLE_TEMPLATES = [
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
TEXT_TEMPLATES = [
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
PRODUCTS = ["dress", "blouse", "pants", "jacket", "skirt", "sweater", "top", "jeans", "shorts", "intimates"]
DEPARTMENT_BY_DIVISION = {"Initmates": ["Intimate"], "Trend": ["Trend"]}
OTHER_DEPARTMENTS = ["Tops", "Dresses", "Bottoms", "Jackets"]
CLASS_BY_DEPARTMENT = {
    "Intimate": ["Intimates", "Sleep"],
    "Trend": ["Trend"],
    "Tops": ["Blouses", "Sweaters"],
    "Dresses": ["Dresses"],
    "Bottoms": ["Pants", "Skirts", "Jeans", "Shorts"],
}
OTHER_CLASSES = ["Jackets"]
RATINGS = [1, 2, 3, 4, 5]
RATING_WEIGHTS = [0.05, 0.1, 0.15, 0.3, 0.4]
P_RECOMMENDED_HIGH, P_RECOMMENDED_MID, P_RECOMMENDED_LOW = 0.9, 0.5, 0.1
AGE_RANGE = (18, 70)
FEEDBACK_MAX_HIGH, FEEDBACK_MAX_LOW = 25, 5
NULL_RATES = {"age": 0.03, "title": 0.01, "rating": 0.05, "division": 0.02}
DEFAULT_ROWS = 23486

# The reference's column names and types, in its order.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("Age", T.IntegerType(), True),
        T.StructField("Title", T.StringType(), True),
        T.StructField("Review_Text", T.StringType(), True),
        T.StructField("Rating", T.IntegerType(), True),
        T.StructField("Recommended_IND", T.IntegerType(), True),
        T.StructField("Positive_Feedback_Count", T.IntegerType(), True),
        T.StructField("Division_Name", T.StringType(), True),
        T.StructField("Department_Name", T.StringType(), True),
        T.StructField("Class_Name", T.StringType(), True),
    ]
)


TAGS = (
    "age", "product", "division", "rating", "department", "class", "recommended", "feedback",
    "title", "text", "null_age", "null_title", "null_rating", "null_division",
)


def synthesize_reviews(df: DataFrame, id_col: str, seed: int = 42, keep_id: bool = True) -> DataFrame:
    """S1 over an existing key column: one synthetic review per row of ``df``.

    Four tags share a digest, so a row costs four md5; digests and draws are staged
    as columns, then the dependent choices read those.
    """
    blocks = range(-(-len(TAGS) // 4))
    hashed = df.select(F.col(id_col).alias("__id"), *[digest(F.col(id_col), f"block{b}", seed).alias(f"__h{b}") for b in blocks])
    draws = hashed.select("__id", *[draw(F.col(f"__h{i // 4}"), i % 4).alias(f"__u_{t}") for i, t in enumerate(TAGS)])

    def u(tag: str):
        return F.col(f"__u_{tag}")

    staged = draws.select(
        "*",
        rand_int(u("age"), *AGE_RANGE).alias("__age"),
        rand_choice(u("product"), PRODUCTS).alias("__product"),
        rand_choice(u("division"), DIVISIONS).alias("__division"),
        weighted_choice(u("rating"), RATINGS, RATING_WEIGHTS).cast("int").alias("__rating"),
    )
    division, rating = F.col("__division"), F.col("__rating")
    staged = staged.withColumn(
        "__department", dependent_choice(division, u("department"), DEPARTMENT_BY_DIVISION, OTHER_DEPARTMENTS)
    )
    klass = dependent_choice(F.col("__department"), u("class"), CLASS_BY_DEPARTMENT, OTHER_CLASSES)
    recommended = conditional_bernoulli(
        u("recommended"), [(rating >= 4, P_RECOMMENDED_HIGH), (rating == 3, P_RECOMMENDED_MID)], P_RECOMMENDED_LOW
    )
    feedback = rand_int(u("feedback"), F.lit(0), F.when(rating >= 4, F.lit(FEEDBACK_MAX_HIGH)).otherwise(FEEDBACK_MAX_LOW))
    product = F.col("__product")
    title = fill_template(rand_choice(u("title"), TITLE_TEMPLATES), product=product)
    text = fill_template(rand_choice(u("text"), TEXT_TEMPLATES), product=product)
    return staged.select(
        *([F.col("__id").alias(id_col)] if keep_id else []),
        null_with_rate(F.col("__age"), u("null_age"), NULL_RATES["age"]).cast("int").alias("Age"),
        null_with_rate(title, u("null_title"), NULL_RATES["title"]).alias("Title"),
        text.alias("Review_Text"),
        null_with_rate(rating, u("null_rating"), NULL_RATES["rating"]).cast("int").alias("Rating"),
        recommended.cast("int").alias("Recommended_IND"),
        feedback.cast("int").alias("Positive_Feedback_Count"),
        null_with_rate(division, u("null_division"), NULL_RATES["division"]).alias("Division_Name"),
        F.col("__department").alias("Department_Name"),
        klass.alias("Class_Name"),
    )


def generate_reviews(spark: SparkSession, n: int = DEFAULT_ROWS, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``n`` synthetic reviews with the reference's schema (ids 0..n-1)."""
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return synthesize_reviews(ids, "id", seed=seed, keep_id=False)


def reviews_frame(spark: SparkSession, rows: list) -> DataFrame:
    """A review frame from Python rows with the declared schema (tests, small inputs)."""
    return spark.createDataFrame(rows, schema=REVIEW_SCHEMA)
