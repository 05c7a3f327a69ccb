"""Quality rules: base counts and a hashed n-gram likelihood ratio (operator 8).

All DataFrame operations.  Words and pairs of words are hashed to ``buckets`` cells.
Two smoothed multinomials over the cells are estimated: one of trusted texts, one of
all texts.  A document's score is the mean over its n-grams of
``log(p_trusted / p_all)``; it is kept where the score is at least ``threshold``.  The
decision is a comparison, never a draw.

The weights are a table of at most ``buckets`` rows, which bounds their broadcast.
Counting combines in every task before its shuffle, scoring sums a document's
n-grams in the task that reads it; a text is never shuffled.

Nulls and ties: a null or blank text has no words, fails the base rules and has a null
score; a label row with a null id or quality is not trusted; repeated rows count and
are scored each; an empty table gives an empty result; without any trusted text the
score is 0 for every document that has words, so only the base rules decide; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_RE, col, let, written

BUCKETS = 1 << 16
SYMBOLS = "#*$%&|<>"
THRESHOLD = -0.08
SMOOTHING = 24.0


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; empty for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE_RE}]+", -1))


def _next(a: Column, b: Column, skip: int) -> Column:
    """Hashes of a's elements with b's from ``skip`` on, as far as both go."""
    return F.slice(F.zip_with(a, F.slice(b, F.lit(skip + 1), F.size(b)), lambda x, y: F.xxhash64(x, y)), F.lit(1), F.greatest(F.size(b) - skip, F.lit(0)))


def n_repeat_words(h: Column) -> Column:
    """Words covered by windows (hashes ``h``, each of three words) that occur twice or more in the text."""

    def covered(starts: Column) -> Column:
        gaps = lambda p: F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b, a + 3) - a))
        return let(starts, lambda p: F.aggregate(gaps(p), F.lit(0), lambda acc, x: acc + x))

    def sorted_starts(z: Column) -> Column:
        # (hash, position) in order; a window repeats if a neighbour has its hash.
        def over(s: Column) -> Column:
            last = F.size(s) - 1
            near = lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | ((i < last) & (s[F.least(i + 1, last)]["h"] == x["h"]))
            again = F.filter(F.transform(s, lambda x, i: F.struct(x["p"].alias("p"), near(x, i).alias("d"))), lambda x: x["d"])
            return F.sort_array(F.transform(again, lambda x: x["p"]))

        return let(F.sort_array(F.transform(z["h"], lambda x, i: F.struct(x.alias("h"), i.alias("p")))), over)

    def few_starts(z: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(z["h"]) - 1), lambda i: F.array_contains(z["again"], z["h"][i]))

    def repeated(sorted_h: Column) -> Column:
        same = F.zip_with(sorted_h, F.slice(sorted_h, F.lit(2), F.size(sorted_h)), lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.filter(same, lambda x: x.isNotNull()))

    # Few repeated windows are looked up one by one, many are sorted with their positions: the same starts either way.
    found = let(F.struct(h.alias("h"), let(F.sort_array(h), repeated).alias("again")), lambda z: F.when(F.size(z["again"]) <= 64, covered(few_starts(z))).otherwise(covered(sorted_starts(z))))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(found).cast("long")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` per row.

    ``one`` and ``two`` hold the hashes of its words and of its pairs of words, for the score.
    """
    keep = keep or []
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(*keep, col(id_col).alias("doc_id"), text.alias("__t"), words(col(text_col)).alias("__w"))
    front = rows.columns[:-2]
    lines = F.filter(F.split("__t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = rows.select(
        *front,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.transform("__w", lambda x: F.xxhash64(x)).alias("one"),
    )
    rows = rows.withColumn("two", _next(F.col("one"), F.col("one"), 1)).withColumn("__three", _next(F.col("two"), F.col("one"), 2))
    rows = rows.withColumn("n_repeat_words", n_repeat_words(F.col("__three"))).drop("__three")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return rows.withColumn("base_failed", failed)


#: Most trusted ids that are broadcast (8 bytes each and their table); more meet the texts in a shuffle join.
BROADCAST_IDS = 2_000_000


def cell_counts(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``cell, n_all, n_trusted`` over every text; the trusted are those whose id is in ``trusted_ids``."""
    ids = trusted_ids.select(col(trusted_ids.columns[0]).alias("__trusted")).filter("__trusted is not null").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(col(id_col).alias("__id"), words(col(text_col)).alias("w"))
    rows = rows.join(ids, F.col("__id") == F.col("__trusted"), "left").select(F.col("__trusted").isNotNull().alias("good"), "w")
    pairs = F.explode(F.arrays_zip("w", F.slice("w", F.lit(2), F.size("w")).alias("b")))
    one = F.xxhash64("z.w")
    cells = F.array(F.pmod(one, F.lit(buckets)).cast("int"), F.when(F.col("z.b").isNotNull(), F.pmod(F.xxhash64(one, F.xxhash64("z.b")), F.lit(buckets)).cast("int")))
    cell = rows.select("good", pairs.alias("z")).select("good", F.explode(cells).alias("cell")).filter("cell is not null")
    return cell.groupBy("cell").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("good").alias("n_trusted"))


def weights(counts: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``cell, weight``: log of the ratio of the two smoothed multinomials, at most one row per cell.

    Both get pseudo-counts in proportion to their totals, ``smoothing`` per cell on the
    larger side, so a cell says little before it has been seen about that often.
    """
    total = counts.agg((F.sum("n_trusted") / F.sum("n_all")).alias("share"))
    share = total.select("share").scalar()
    return counts.select("cell", F.log((F.col("n_trusted") / share + F.lit(smoothing)) / (F.col("n_all") + F.lit(smoothing))).alias("weight"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the texts labelled good."""
    return labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()


def judged(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, id_col: str = "doc_id",
    text_col: str = "text", keep: list[Column] | None = None,
) -> DataFrame:
    """Base counts, ``score`` and ``kept`` of every row, with the columns of ``keep`` in front."""
    counts = written(cell_counts(docs, trusted, buckets, id_col, text_col), "cells")
    none = counts.agg(F.sum("n_trusted")).first()[0] in (None, 0)
    rows = base_counts(docs, id_col, text_col, keep)
    names = [c for c in rows.columns if c not in ("one", "two")]
    if none:
        scored = rows.select(*names, F.when(F.col("n_words") > 0, F.lit(0.0)).alias("score"))
    else:
        table = written(weights(counts), "cell-weights").coalesce(1)
        # One array of weights by cell: exactly `buckets` numbers, a scalar subquery.
        cells = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell")).join(table, "cell", "left")
        entries = F.sort_array(F.collect_list(F.struct("cell", F.coalesce("weight", F.lit(0.0)).alias("weight"))))
        dense = cells.coalesce(1).agg(F.transform(entries, lambda e: e["weight"]).alias("w"))
        rows = rows.withColumn("__weights", dense.scalar())
        add = lambda acc, h: acc + F.col("__weights")[F.pmod(h, F.lit(buckets)).cast("int")]
        total = F.aggregate(F.concat("one", "two"), F.lit(0.0), add)
        scored = rows.select(*names, F.when(F.col("n_words") > 0, total / (F.size("one") + F.size("two"))).alias("score"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(float("-inf"))) >= threshold))


def passing(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept, columns unchanged."""
    out = judged(docs, trusted, threshold, buckets, id_col, text_col, keep=[F.struct(*[col(c) for c in docs.columns]).alias("__row")])
    # The row number keeps the filter above the verdict; pushed below, it would repeat every expression in it.
    out = out.withColumn("__n", F.monotonically_increasing_id()).filter("kept and __n >= 0")
    return out.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
