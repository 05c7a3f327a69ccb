"""Ranked lexical search by exact inner products in sparse ball trees (operator 12).

A document is a sparse vector of integer term weights, an item (query) a vector of term
counts, and the score their inner product.  Documents go into shards; each shard is a
ball tree: a node knows its members' centroid and radius, so no member scores above
``q . centroid + |q| * radius``, where ``q`` is cut to the terms that any member holds.  An item walks the tree best bound first, scores
leaves in exact integers and stops when the best bound left is below its k-th score.
Centroids, radii and bounds are floating point and rounded up by more than their error, so
nothing that could enter the list is pruned, ties included.

One pass reads the texts and keeps, per document, its length and its counts of the items'
terms (other terms add nothing to any score); document counts and total length are
summed from that table.  Items are searched in blocks of about ``block_bytes`` of text, which bounds the
vocabulary, the counts and the broadcast, at the price of one pass over the texts per block; a task holds one
shard and the lists of one block.

Weights, with N documents that hold a term, L terms in all, n in the document, df documents that hold the term
and tf its count there: ``w = floor(1000 ln((2N+2)/(2df+1)))``, ``m = 25 + 75 n N div L``, weight
``w * (10^9 tf div (1000 tf + 8 m))``.

Nulls and ties: a null text has no terms; an item without terms, or whose terms no document holds, has no
rows; equal scores are ordered by id (null last); every row is a document and every item row an item of its
own, repeated ids included; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import binary, col, written

LEAF = 64
#: A shard ends at so many documents or entries.
SHARD_DOCS, SHARD_ENTRIES = 4096, 2_000_000
#: Terms: ASCII letters (lower-cased), digits and all beyond ASCII; other bytes separate.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def _sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive places of ``ptr``, none of them empty."""
    return np.add.reduceat(values, ptr[:-1]) if len(ptr) > 1 else np.zeros(0, values.dtype)


class BallTree:
    """Documents ``i`` with entries ``term[ptr[i]:ptr[i+1]]``, ``value[...]`` (positive integers), at least one each."""

    def __init__(self, ptr: np.ndarray, term: np.ndarray, value: np.ndarray, width: int, leaf: int = LEAF):
        self.leaf = leaf
        self.order = np.arange(len(ptr) - 1)
        self.ptr, self.term, self.value = ptr.astype(np.int64), term, value
        self.work = np.zeros(width)
        #: per node: first and last document, children, sorted centroid terms and values, radius
        self.nodes: list[tuple[int, int, int, int, np.ndarray, np.ndarray, float]] = []
        if len(self.order):
            self._grow(0, len(self.order))
        del self.work

    def _entries(self, lo: int, hi: int):
        a, b = self.ptr[lo], self.ptr[hi]
        return self.ptr[lo : hi + 1] - a, self.term[a:b], self.value[a:b].astype(np.float64)

    def _dots(self, ptr, term, value, to_term, to_value) -> np.ndarray:
        self.work[to_term] = to_value
        out = _sums(value * self.work[term], ptr)
        self.work[to_term] = 0
        return out

    def _grow(self, lo: int, hi: int) -> int:
        ptr, term, value = self._entries(lo, hi)
        self.work[:] = 0
        np.add.at(self.work, term, value)
        at = np.unique(term)
        centre = self.work[at] / (hi - lo)
        self.work[at] = 0
        own, mid = _sums(value * value, ptr), float(centre @ centre)
        near = self._dots(ptr, term, value, at, centre)
        # all three sums are off by at most their number of terms times the unit roundoff, relative to (|d| + |c|)^2
        slack = 1e-15 * (len(at) + 8) * 2 * (own + mid)
        far = own - 2 * near + mid
        radius = math.sqrt(float(np.max(np.maximum(far, 0) + slack))) * (1 + 1e-12)
        me = len(self.nodes)
        self.nodes.append((lo, hi, -1, -1, at, centre, radius))
        if hi - lo <= self.leaf:
            return me
        one = int(far.argmax())
        p = slice(ptr[one], ptr[one + 1])
        to_one = own - 2 * self._dots(ptr, term, value, term[p], value[p]) + own[one]
        two = int(to_one.argmax())
        p = slice(ptr[two], ptr[two + 1])
        side = to_one - (own - 2 * self._dots(ptr, term, value, term[p], value[p]) + own[two])
        cut = int((side <= 0).sum())
        if min(cut, hi - lo - cut) * 20 < hi - lo:
            cut = (hi - lo) // 2
        self._reorder(lo, hi, np.argsort(side, kind="stable"))
        left = self._grow(lo, lo + cut)
        right = self._grow(lo + cut, hi)
        self.nodes[me] = (lo, hi, left, right, at, centre, radius)
        return me

    def _reorder(self, lo: int, hi: int, order: np.ndarray) -> None:
        start, sizes = self.ptr[lo:hi][order], np.diff(self.ptr[lo : hi + 1])[order]
        take = np.repeat(start - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(int(sizes.sum()))
        a, b = self.ptr[lo], self.ptr[hi]
        self.term[a:b], self.value[a:b] = self.term[take], self.value[take]
        self.ptr[lo + 1 : hi + 1] = a + np.cumsum(sizes)
        self.order[lo:hi] = self.order[lo:hi][order]

    def bound(self, node: int, term: np.ndarray, count: np.ndarray) -> float:
        """At least the score of every member, for sorted ``term`` with ``count``; terms that no member has add nothing."""
        at, centre, radius = self.nodes[node][4:]
        place = np.minimum(np.searchsorted(at, term), len(at) - 1)
        held = at[place] == term
        if not held.any():
            return 0.0
        own = count[held].astype(np.float64)
        return (float(centre[place[held]] @ own) + math.sqrt(float(own @ own)) * radius) * (1 + 1e-9) + 1.0

    def search(self, term: np.ndarray, count: np.ndarray, dense: np.ndarray, floor: int, offer) -> int:
        """Pass documents that may score ``floor`` or more to ``offer(docs, scores)``, which returns the new floor.

        ``dense`` holds ``count`` at ``term`` and zeros elsewhere.  Returns the number of leaves read.
        """
        if not self.nodes:
            return 0
        read, queue = 0, [(-self.bound(0, term, count), 0)]
        while queue and -queue[0][0] >= floor:
            _, node = heapq.heappop(queue)
            lo, hi, left, right = self.nodes[node][:4]
            if left >= 0:
                for child in (left, right):
                    most = self.bound(child, term, count)
                    if most >= floor:
                        heapq.heappush(queue, (-most, child))
                continue
            read += 1
            a, b = self.ptr[lo], self.ptr[hi]
            score = _sums(self.value[a:b] * dense[self.term[a:b]], self.ptr[lo : hi + 1] - a)
            hit = np.flatnonzero(score >= max(floor, 1))
            if len(hit):
                floor = offer(self.order[lo:hi][hit], score[hit])
        return read


def _counts(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs`` of documents with a term: the counts of the vocabulary's terms."""
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {t: i for i, t in enumerate(vocabulary.value)}.get
        for b in batches:
            n, found, tfs, sizes = [], [], [], []
            for text in binary(b.column(1)):
                words = terms(text)
                n.append(len(words))
                at, tf = np.unique(np.array([i for i in map(get, words) if i is not None], np.int32), return_counts=True)
                found.append(at)
                tfs.append(tf)
                sizes.append(len(at))
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], pa.int32())) for x in (found, tfs)]
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])
            yield out.filter(pa.array(np.array(n, np.int64) > 0))

    return rows.mapInArrow(run, T.StructType([rows.schema["id"]]).add("n", T.LongType()).add("terms", T.ArrayType(T.IntegerType())).add("tfs", T.ArrayType(T.IntegerType())))


def _document_counts(counts: DataFrame, width: int) -> np.ndarray:
    """Documents per term of the vocabulary (its size is bounded by the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    got = counts.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(width, np.int64)
    out[got["term"].to_numpy()] = got["df"].to_numpy()
    return out


def _lists(counts: DataFrame, weights, queries, big_n: int, big_l: int, k: int, leaf: int, shard_docs: int) -> DataFrame:
    """``item, id, score``: per task and item its ``k`` best documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        best = [[] for _ in queries.value]  # sorted (-score, null id, id)
        dense = np.zeros(len(w), np.int64)
        shard: list[pa.RecordBatch] = []

        def search():
            table = pa.Table.from_batches(shard).combine_chunks()
            sizes = np.asarray(table["terms"].combine_chunks().value_lengths())
            n, at = table["n"].to_numpy(), table["terms"].combine_chunks().flatten().to_numpy()
            tf = table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            m = np.repeat(25 + 75 * n * big_n // big_l, sizes)
            value = w[at] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            row, ok = np.repeat(np.arange(len(n)), sizes), value > 0
            at, value, sizes = at[ok], value[ok], np.bincount(row[ok], minlength=len(n))
            held = np.flatnonzero(sizes)
            ids = table["id"].combine_chunks().take(pa.array(held)).to_pylist()
            tree = BallTree(np.r_[0, np.cumsum(sizes[held])], at, value, len(w), leaf)
            for own, (term, count) in zip(best, queries.value):

                def offer(docs, scores, own=own):
                    own.extend((-int(s), ids[i] is None, ids[i]) for i, s in zip(docs.tolist(), scores.tolist()))
                    own.sort(key=lambda e: (e[0], e[1]) if e[1] else e)
                    del own[k:]
                    return -own[-1][0] if len(own) == k else 1

                if not len(term):
                    continue
                dense[term] = count
                tree.search(term, count, dense, -own[-1][0] if len(own) == k else 1, offer)
                dense[term] = 0

        docs = entries = 0
        for b in batches:
            for at in range(0, b.num_rows, min(1024, shard_docs)):
                part = b.slice(at, min(1024, shard_docs))
                shard.append(part)
                docs, entries = docs + part.num_rows, entries + len(part.column(2).flatten())
                if docs >= shard_docs or entries >= SHARD_ENTRIES:
                    search()
                    shard, docs, entries = [], 0, 0
        if shard:
            search()
        item = [i for i, own in enumerate(best) for _ in own]
        flat = [e for own in best for e in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array([e[2] for e in flat], id_type), pa.array([-e[0] for e in flat], pa.int64())], names=["item", "id", "score"]
        )

    kind = counts.schema["id"].dataType
    id_type = to_arrow_type(kind)
    return counts.mapInArrow(run, f"item long, id {kind.simpleString()}, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_bytes: int = 4 << 20,
    leaf: int = LEAF,
    shard_docs: int = SHARD_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of every item."""
    spark = docs.sparkSession
    asked = items.select(col(item_col).alias("item_id"), col(item_text_col).alias("t")).filter("t is not null")
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)))
    out, kind = None, docs.schema[id_col].dataType
    for block in range(blocks):
        rows = sorted(numbered.filter(F.col("block") == block).select("item_id", "t").collect(), key=lambda r: (r.item_id is None, str(r.item_id), r.t))
        words = [terms(r.t.encode("utf-8", "surrogatepass")) for r in rows]
        vocabulary = sorted({x for ws in words for x in ws})
        if not vocabulary:
            continue
        place = {x: i for i, x in enumerate(vocabulary)}
        queries = [np.unique(np.array([place[x] for x in ws], np.int64), return_counts=True) for ws in words]
        counts = written(_counts(docs, spark.sparkContext.broadcast(vocabulary), id_col, text_col), "lexical-counts")
        big_n, big_l = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not big_n:
            continue
        df = _document_counts(counts, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * big_n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        lists = _lists(counts, spark.sparkContext.broadcast(weight), spark.sparkContext.broadcast(queries), big_n, big_l, k, leaf, shard_docs)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
        top = lists.withColumn("rank", rank).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], T.StructType().add("item", T.LongType()).add("item_id", items.schema[item_col].dataType))
        part = written(top.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score"), "lexical-lists")
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = T.StructType().add("item_id", items.schema[item_col].dataType).add("rank", T.IntegerType()).add("doc_id", kind).add("score", T.LongType())
        return spark.createDataFrame([], schema)
    return out
