"""Model metrics (M8, M12, M15, P4): one aggregate each, no driver loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_residual(df: DataFrame, y: str, yhat: str, out: str = "error") -> DataFrame:
    """Actual minus predicted."""
    return df.withColumn(out, F.col(y).cast("double") - F.col(yhat).cast("double"))


def regression_metrics(df: DataFrame, y: str = "rating", yhat: str = "prediction") -> DataFrame:
    """M8: RMSE, MAE and R^2 in one pass: ``n, rmse, mae, r2``.

    ``r2 = 1 - SSE / SST`` with ``SST = sum((y - mean(y))^2)``, as Spark's
    ``RegressionEvaluator``.  On a constant label (no spread to explain) r2 is null.
    """
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    agg = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        F.sum(F.abs(e)).alias("sae"),
        F.var_samp(F.col(y).cast("double")).alias("var_y"),
    )
    return agg.select(
        F.col("n").cast("bigint").alias("n"),
        F.sqrt(F.try_divide("sse", "n")).alias("rmse"),
        F.try_divide("sae", "n").alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var_y") * (F.col("n") - 1))).alias("r2"),
    )


def _label_text(v) -> str:
    try:
        f = float(v)
    except ValueError:
        return str(v)
    return str(int(f)) if f.is_integer() else str(v).replace(".", "_")


def pair_counts(df: DataFrame, y: str, yhat: str, weight: str = "n_rows") -> DataFrame:
    """Rows per (actual, predicted): the one pass that both tables below can be read from."""
    return df.groupBy(y, yhat).agg(F.count(F.lit(1)).alias(weight))


def confusion_matrix(df: DataFrame, y: str, yhat: str, labels: Sequence | None = None, weight: str | None = None) -> DataFrame:
    """Counts of (actual, predicted) over all rows; zeros for absent pairs.

    One row per actual label, one column ``pred_<label>`` per predicted label
    (``pred_0``, ``pred_1`` for 0.0 / 1.0).  Without ``labels`` the predicted labels
    are found in one more small job; with them, every other prediction (null
    too) is counted in ``pred_other``, so each row sums to its label's rows.  With ``weight`` a row
    stands for that many.
    """
    one = F.col(weight) if weight else F.lit(1)
    grouped = df.groupBy(F.col(y).alias(y))
    if labels is None:
        out = grouped.pivot(yhat).agg(F.sum(one))
        return out.select(y, *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint").alias(f"pred_{_label_text(n)}") for n in out.columns if n != y])
    hit = [F.coalesce(F.col(yhat) == F.lit(v), F.lit(False)) for v in labels]
    other = F.lit(True)
    for h in hit:
        other = other & ~h
    def rows(h):
        return F.coalesce(F.sum(F.when(h, one)), F.lit(0)).cast("bigint")

    return grouped.agg(*[rows(h).alias(f"pred_{_label_text(v)}") for h, v in zip(hit, labels)], rows(other).alias("pred_other"))


def classification_metrics(df: DataFrame, y: str, yhat: str, weight: str | None = None) -> DataFrame:
    """Accuracy and weighted F1 (weights = true-label frequencies): ``n, accuracy, f1``.

    Matches ``MulticlassClassificationEvaluator``: a class's F1 is 0 when its
    precision and recall are both 0; predicted-only labels carry no weight.
    The work is one grouped count over (actual, predicted) pairs; everything
    after it runs on at most (labels x labels) rows.  With ``weight`` a row stands for that many.
    """
    pairs = df.groupBy(F.col(y).cast("double").alias("a"), F.col(yhat).cast("double").alias("p")).agg(
        F.sum(F.col(weight) if weight else F.lit(1)).alias("c")
    )
    # Both sides of a pair are counted in one pass: read twice, the pairs would be scored twice.
    own = F.struct(F.col("a").alias("label"), F.lit(True).alias("is_actual"), F.col("c").alias("n"), F.when(F.col("a") == F.col("p"), F.col("c")).alias("hit"))
    other = F.struct(F.col("p").alias("label"), F.lit(False).alias("is_actual"), F.col("c").alias("n"), F.lit(None).cast(pairs.schema["c"].dataType).alias("hit"))
    per = pairs.select(F.explode(F.array(own, other)).alias("s")).groupBy(F.col("s.label").alias("label")).agg(
        F.sum(F.when(F.col("s.is_actual"), F.col("s.n"))).alias("n_actual"),
        F.coalesce(F.sum("s.hit"), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(~F.col("s.is_actual"), F.col("s.n"))), F.lit(0)).alias("n_pred"),
    ).filter("n_actual is not null")
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.col("tp") / F.col("n_actual")
    f1 = F.when(prec + rec > 0, 2.0 * prec * rec / (prec + rec)).otherwise(0.0)
    return per.agg(
        F.sum("n_actual").cast("bigint").alias("n"),
        (F.sum("tp") / F.sum("n_actual")).alias("accuracy"),
        (F.sum(f1 * F.col("n_actual")) / F.sum("n_actual")).alias("f1"),
    )
