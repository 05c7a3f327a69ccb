"""SimHash near-duplicate groups with BK-trees (operator 3).

Fingerprints: 64 bits, one vote per word shingle.  Links: Hamming distance at
most ``radius``.  The distinct fingerprints are dealt to shards by bit blocks:
with ``m`` blocks, two fingerprints within ``radius`` bits agree on at least
``m - radius`` blocks, so one shard table per choice of ``m - radius`` blocks
brings every linked pair together in some shard, and no pair is lost.  Each shard
is a BK-tree (children keyed by the distance to their parent); a member follows
only edges within the radius of its own distance.  A shard above ``max_tree``
members is cut into pieces: each piece is one tree, and the shard's members
stream past it as queries.  Tasks return a spanning star per local group, never
all pairs; groups are then closed over shards by alternating star steps.

Nulls and ties: a null or wordless text has fingerprint zero and links like any
other; a null ``doc_id`` is ignored when the smallest id is taken (a group of
only null ids has a null component); repeated rows give repeated results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary, col, join_row, split_row, written

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The SimHash of one text as a signed 64-bit integer."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    k = min(shingle, len(words))
    flat = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    first, last = start[: len(words) - k + 1].tolist(), (start + size)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], SEED) for a, b in zip(first, last)], dtype="<u8")
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):  # the unpacked bits of a long text stay small
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (signed long) of every row, from the whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, shingle) for t in binary(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(col(id_col).alias("doc_id"), col(text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, fp bigint")


class Forest:
    """BK-trees over the points of many shards at once, in flat arrays.

    ``points`` are distinct within a group; the first point of each group is its
    root.  Edges are kept sorted by (parent, distance), so the children of a
    node within a range of distances are one slice.
    """

    def __init__(self, points: np.ndarray, group: np.ndarray):
        self.points = points
        new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
        roots = np.flatnonzero(new)
        self.root = roots[np.cumsum(new) - 1] if len(group) else roots
        at = self.root.copy()
        left = np.flatnonzero(~new)
        keys, kids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(left):
            key = at[left] * (BITS + 1) + np.bitwise_count(points[left] ^ points[at[left]])
            unique, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            kids.append(left[first])
            keys.append(unique)
            rest = np.ones(len(left), bool)
            rest[first] = False
            at[left[rest]] = left[first][inverse[rest]]
            left = left[rest]
        key, kid = np.concatenate(keys), np.concatenate(kids)
        order = np.argsort(key, kind="stable")
        self.key, self.kid = key[order], kid[order]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query number, point number) of every pair within the radius, frontier by frontier."""
        q, node = np.arange(len(queries)), roots
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.points[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            low = np.searchsorted(self.key, node * (BITS + 1) + np.maximum(d - radius, 0))
            high = np.searchsorted(self.key, node * (BITS + 1) + np.minimum(d + radius, BITS), side="right")
            n = np.maximum(high - low, 0)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            q, node = np.repeat(q, n), self.kid[np.repeat(low, n) + step]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a and b; every label stays the smallest index of its group."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _stars(points: np.ndarray, group: np.ndarray, asks: np.ndarray, ask_group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (point, centre) of the links between tree points and queries of the same group.

    Without queries the points of a group query their own tree.  Queries go in blocks
    that keep (queries x largest tree), and so the frontier, below a few million.
    """
    forest = Forest(points, group)
    block = int(max(64, min(20_000, 4_000_000 // np.bincount(group).max())))
    if not len(asks):
        asks, roots = points, forest.root
    else:
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        roots = starts[np.searchsorted(group[starts], ask_group)]
    names, where = np.unique(np.concatenate([points, asks]), return_inverse=True)
    of_point, of_ask = where[: len(points)], where[len(points) :]
    label = np.arange(len(names))
    for at in range(0, len(asks), block):
        for q, node in forest.search(asks[at : at + block], roots[at : at + block], radius):
            _merge(label, of_ask[at + q], of_point[node])
    linked = np.flatnonzero(label != np.arange(len(names)))
    return names[linked], names[label[linked]]


def _linker(radius: int, max_tree: int):
    """Streams sorted (shard, piece, kind, fp) rows; holds one tree and one block of queries at most."""

    def solve(shard, piece, kind, fp):
        group = np.zeros(len(shard), np.int64)
        if len(shard):
            group[1:] = np.cumsum((shard[1:] != shard[:-1]) | (piece[1:] != piece[:-1]))
        tree = kind == 0
        size = np.bincount(group, minlength=1)
        asked = np.bincount(group[~tree], minlength=len(size)) > 0
        out = []
        own = tree & ~asked[group] & (size[group] > 1)
        if own.any():
            out.append(_stars(fp[own], group[own], fp[:0], group[:0], radius))
        cut = tree & asked[group]
        if cut.any():
            ask = ~tree & np.isin(group, group[cut])
            out.append(_stars(fp[cut], group[cut], fp[ask], group[ask], radius))
        for a, b in out:
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for b in batches:
            new = [b.column(i).to_numpy() for i in range(4)]
            new[3] = new[3].view(np.uint64)
            held = [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) < 4 * max_tree:
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = len(last) - int(last.sum())
            yield from solve(*[x[:cut] for x in held])
            held = [x[cut:] for x in held]
            if len(held[0]) >= 2 * max_tree:  # one cut shard: its queries so far, then only its tree stays
                yield from solve(*held)
                held = [x[held[2] == 0] for x in held]
        yield from solve(*held)

    return run


def masks(radius: int, blocks: int) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` blocks of the fingerprint, as signed longs."""
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    out = [sum(c) for c in combinations(part, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def links(fps: DataFrame, radius: int = 3, max_tree: int = 50_000) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose closure is every link within ``radius`` bits.

    ``fps`` has the distinct fingerprints in ``fp``.  The number of blocks follows
    from their number, so that an even shard stays near 64 members; the links are
    the same for any number of blocks.
    """
    n = fps.count()
    blocks = radius + 1
    while n >> min(62, (blocks - radius) * BITS // blocks) > 64 and blocks < radius + 4:
        blocks += 1
    tables = F.array(
        *[F.struct(F.lit(i).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks(radius, blocks))]
    )
    rows = fps.select("fp", F.explode(tables).alias("s")).select(
        "fp", F.xxhash64("s.t", "s.v").alias("shard")  # two shards under one hash make one larger shard, no lost link
    )
    pieces = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_tree)
    pieces = written(pieces.select("shard", F.ceil(F.col("n") / F.lit(max_tree / 2)).cast("long").alias("pieces")), "cut-shards")
    if pieces.isEmpty():
        dealt = rows.select("shard", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("kind"), "fp")
        spread = ["shard"]
    else:
        cut = rows.join(pieces, "shard", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        cut = cut.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("pieces")))
        tree = cut.select("shard", F.col("own").alias("piece"), F.lit(0).cast("long").alias("kind"), "fp")
        # A member queries its own piece and those after it: each pair of pieces meets once.
        ask = cut.filter("pieces > 1").select("shard", F.explode(F.sequence("own", F.col("pieces") - 1)).alias("piece"), F.lit(1).cast("long").alias("kind"), "fp")
        dealt, spread = tree.unionByName(ask), ["shard", "piece"]
    dealt = dealt.repartition(*spread).sortWithinPartitions("shard", "piece", "kind")
    return dealt.mapInArrow(_linker(radius, max_tree), "a bigint, b bigint")


def closure(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, label)`` for every node of ``edges (a, b)``; the label is the smallest node reachable.

    Alternating large-star and small-star steps on written tables: work per round
    is linear in the edges, a hub's rows spread (map-side minima, skew-split joins),
    and nothing but two sums per round reaches the driver.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written(now, "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v"), F.col("v")).distinct())
        seen = state
    raise RuntimeError("the star steps did not settle")


def groups(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row; the component is the smallest id reachable."""
    prints = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    return assign(prints, radius)


def assign(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Add ``component_id`` to a table with ``doc_id`` and ``fp``."""
    each = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    label = closure(links(each.select("fp"), radius))
    named = each.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    component = named.join(least, "label").select("fp", "component_id")
    return prints.join(component, "fp").select(*prints.columns, "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with its columns unchanged: the one of the smallest id.

    A null id counts as larger than any other; among rows of one id the smallest row
    hash stays, and of wholly equal rows one.
    """
    cols = docs.columns
    keyed = split_row(docs, id_col, text_col)
    keyed = keyed.withColumn("__key", F.xxhash64("__text", "__row"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = [fingerprint(t, shingle) for t in binary(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], names=["doc_id", "key", "fp"])

    prints = keyed.select(F.col("__id").alias("doc_id"), F.col("__key").alias("key"), "__text").mapInArrow(run, f"doc_id {kind}, key bigint, fp bigint")
    each = written(prints, "fingerprints")
    label = closure(links(each.select("fp").distinct(), radius))
    named = each.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = written(named.select("doc_id", "key", "label"), "group-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("k")))
    stay = named.groupBy("label").agg(first.alias("w"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("label", "w")
    mine = F.col("doc_id").eqNullSafe(F.col("w.id")) & (F.col("key") == F.col("w.k"))
    go = named.join(stay, "label").filter(~mine).select(F.col("doc_id").alias("__go"), F.col("key").alias("__gone")).distinct()
    # Wholly equal rows have one key and would all stay: their number is counted, and all but one of them go.
    twins = named.join(stay, "label").filter(mine).groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    go, twins = written(go, "group-losers"), written(twins.select(F.col("doc_id").alias("__go"), F.col("key").alias("__gone")), "group-twins")
    kept = _without(keyed, go)
    if twins.limit(1).count():
        both = (F.col("__key") == F.col("__gone")) & F.col("__id").eqNullSafe(F.col("__go"))
        once = kept.join(twins, both, "left_semi").groupBy("__key", "__id").agg(F.first("__text").alias("__text"), F.first("__row").alias("__row"))
        kept = _without(kept, twins).select("__key", "__id", "__text", "__row").unionByName(once)
    return join_row(kept, cols, text_col, F.col("__text"))


def _without(keyed: DataFrame, go: DataFrame, most: int = 2_000_000, most_bytes: int = 32 << 20) -> DataFrame:
    """The rows whose id and key are not in ``go``; its list is broadcast below a checked size, else texts are shuffled once."""
    n, size = go.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col("__go").cast("string")) + 16)).first()
    if n <= most and (size or 0) <= most_bytes:
        go = F.broadcast(go)
    return keyed.join(go, (F.col("__key") == F.col("__gone")) & F.col("__id").eqNullSafe(F.col("__go")), "left_anti")
