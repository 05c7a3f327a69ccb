"""Mixing sources to target weights with a low-discrepancy schedule (operator 5).

All DataFrame operations.  Sizes are words.  Targets are a share of ``total``
times all words by weight, at most ``most`` times a source's own words, the excess
shared again by weight (water filling in closed form).  The mix is a sequence of
slots of equally many tokens: slot ``i`` maps the golden-ratio point
``frac((i + 1) * phi)`` through the cumulative targets to a source, and its rank
among that source's slots names the block of the source's shuffled stream that it
takes; the stream starts again after its last document.  One closing slot per
source takes what whole blocks leave of the target.

Hot sources: stream offsets come from two-level running sums, first over hash buckets
of a source, then within a bucket; slot ranks likewise over chunks of the schedule.
No window holds a whole source.

Nulls and ties: a null text has size 0 and takes nothing; null is a source of its own,
sorted last; a null id is shuffled like any other; repeated rows are separate
documents (equal rows share what they take); an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, SPACE_RE, col, written

#: Binary digits of the golden ratio's fraction, for exact integer points: floor((sqrt(5) - 1) / 2 * 2**32), odd.
GOLDEN = 2654435769
POINT_BITS = 32
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    bare = F.btrim(text, F.lit(SPACE))
    n = F.size(F.split(bare, f"[{SPACE_RE}]+", -1))
    return F.when(bare.isNull() | (bare == ""), F.lit(0)).otherwise(n).cast("long")


def sized(docs: DataFrame, buckets: int, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, source, size, tie, bucket, mix``: narrow rows in a shuffled order by (mix, doc_id, tie)."""
    rows = docs.select(
        col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), word_count(col(text_col)).alias("size"),
        F.xxhash64(col(text_col)).alias("tie"),
    )
    mix = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")
    return rows.withColumn("mix", mix).withColumn("bucket", F.shiftright("mix", 40) % F.lit(buckets))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, place, source_size, target, upto``: one row per source; ``upto`` is the running target.

    Sources sort by code point, null last; weights repeat along that order.  With caps
    c and weights w, sources fill in order of c / w: the first k are full where the
    level (total - sum of their c) / (the rest's w) does not lift the next one above
    its cap.  The windows here hold one row per source.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("place", F.row_number().over(order).cast("long"))
    rows = rows.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    upto = Window.orderBy(F.col("cap") / F.col("w"), "place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("want", F.sum("source_size").over(everything) * F.lit(float(total)))
    rows = rows.withColumn("full", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
    rows = rows.withColumn("left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    level = (F.col("want") - F.col("full")) / F.col("left")
    # The level of the first source that is not full holds for all after it; taking those as full would only lower it.
    rows = rows.withColumn("level", F.max(F.when(level * F.col("w") <= F.col("cap"), level)).over(everything))
    rows = rows.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))))
    rows = rows.withColumn("quota", F.round("target").cast("long"))
    rows = rows.withColumn("upto", F.sum("quota").over(Window.orderBy("place")))
    return rows.select("source", "place", "source_size", "target", "quota", "upto")


def streams(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document with its place in its source's shuffled stream: ``[start, start + size)``."""
    # The plan has one row per source; from here on a source is its place, which is never null.
    rows = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    within = Window.partitionBy("place", "bucket").orderBy("mix", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("place", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(above), F.lit(0))).drop("n")
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["place", "bucket"])
    return rows.select("doc_id", "source", "size", "place", "source_size", "target", "quota", (F.col("base") + F.col("inner")).alias("start"))


def schedule(spark: SparkSession, plan: DataFrame, tokens: int, block: int, chunk: int = 1 << 11, cells: int = 4096) -> DataFrame:
    """``slot, place, rank, first, last``: the sequence of the mix; a slot takes tokens [first, last) of its stream.

    Points are exact integers, ``(slot + 1) * GOLDEN mod 2**32``; a point falls to the
    source whose running target first passes its share of ``tokens``.  Points meet
    targets by cells of the token range, so a slot is compared with the few sources
    that touch its cell.
    """
    slots, tokens = max(1, tokens // block), max(1, tokens)
    x = (F.col("id") + 1) % F.lit(1 << POINT_BITS)
    low, high = x % F.lit(1 << 16), F.floor(x / F.lit(1 << 16))  # in halves, so that no product passes 63 bits
    point = (low * F.lit(GOLDEN) + (high * F.lit(GOLDEN) % F.lit(1 << 16)) * F.lit(1 << 16)) % F.lit(1 << POINT_BITS)
    at = F.floor(point.cast("decimal(20,0)") * F.lit(tokens).cast("decimal(18,0)") / F.lit(1 << POINT_BITS).cast("decimal(11,0)")).cast("long")
    cell = lambda c: F.floor(c.cast("decimal(20,0)") * F.lit(cells).cast("decimal(10,0)") / F.lit(tokens).cast("decimal(18,0)")).cast("long")
    rows = spark.range(slots).select(F.col("id").alias("slot"), F.floor(F.col("id") / chunk).alias("chunk"), at.alias("at"))
    edges = plan.filter("quota > 0").select("place", (F.col("upto") - F.col("quota")).alias("lo"), F.col("upto").alias("hi"))
    edges = edges.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    rows = rows.withColumn("cell", cell(F.col("at"))).join(edges, "cell").filter("lo <= at and at < hi").select("slot", "chunk", "place")
    above = Window.partitionBy("place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("place", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = sums.groupBy("place").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(above), F.lit(0))).drop("n")
    inner = F.row_number().over(Window.partitionBy("place", "chunk").orderBy("slot")) - 1
    ranked = rows.withColumn("inner", inner).join(sums, ["place", "chunk"])
    ranked = ranked.select("slot", "place", (F.col("base") + F.col("inner")).alias("rank"))
    closing = plan.join(counts, "place", "left").select(
        (F.lit(slots) + F.col("place") - 1).alias("slot"), "place", F.coalesce("n", F.lit(0)).cast("long").alias("rank"), F.lit(True).alias("closing")
    )
    every = ranked.withColumn("closing", F.lit(False)).unionByName(closing)
    every = every.join(plan.select("place", "quota"), "place")
    first = F.least(F.col("rank") * F.lit(block), "quota")
    last = F.when(F.col("closing"), F.col("quota")).otherwise(F.least((F.col("rank") + 1) * F.lit(block), "quota"))
    return every.select("slot", "place", "rank", first.alias("first"), last.alias("last"))


def blocks(stream: DataFrame, block: int) -> DataFrame:
    """Pieces of documents per block of their source's stream, for as many turns as the target needs."""
    turns = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("quota") / F.greatest("source_size", F.lit(1))) - 1, F.lit(0)).cast("int"))
    rows = stream.filter("size > 0").withColumn("turn", F.explode(turns))
    rows = rows.withColumn("b", F.col("turn") * F.col("source_size") + F.col("start")).withColumn("e", F.least(F.col("b") + F.col("size"), "quota")).filter("b < e")
    rank = F.explode(F.sequence(F.floor(F.col("b") / block), F.floor((F.col("e") - 1) / block)))
    return rows.withColumn("rank", rank).select("place", "rank", "doc_id", "start", "b", "e")


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = 1.5, most: float = 2.0, slots: int = 1 << 16, block: int = 4096,
    buckets: int = 1024, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The documents with ``size, source_size, target, taken``, and the schedule with the pieces each slot takes.

    A slot has ``block`` tokens, fewer where the mix would have under ``slots`` slots.
    """
    rows = written(sized(docs, buckets, seed, id_col, text_col, source_col), "sizes")
    plan = written(targets(rows, weights, total, most), "mix-targets")
    tokens = plan.agg(F.max("upto")).first()[0] or 0
    size = int(max(1, min(block, tokens // slots)))
    stream = written(streams(rows, plan), "streams")
    sequence = schedule(docs.sparkSession, plan, tokens, size)
    # A closing slot's tail may reach past its own block when rounding left more; it takes blocks from its rank on.
    ranks = F.explode(F.sequence("rank", F.greatest("rank", F.floor((F.col("last") - 1) / size))))
    ends = sequence.filter("first < last").select("slot", "place", ranks.alias("rank"), "first", "last")
    pieces = blocks(stream, size).join(ends, ["place", "rank"])
    low = F.greatest("b", "first", F.col("rank") * F.lit(size))
    high = F.least("e", "last", (F.col("rank") + 1) * F.lit(size))
    pieces = pieces.select("slot", "place", "doc_id", "start", (low - F.col("b")).alias("from"), (high - low).alias("n")).filter("n > 0")
    taken = pieces.groupBy("place", "start").agg(F.sum("n").alias("taken"))
    # Within a source, positive sizes have distinct starts; an empty document takes nothing.
    key = F.when(F.col("size") > 0, F.col("start")).otherwise(-1 - F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    out = stream.withColumn("at", key).join(taken.withColumnRenamed("start", "at"), ["place", "at"], "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), pieces
