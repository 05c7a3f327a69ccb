"""Approximate nearest neighbours by NN-descent (operator 11).

``build`` makes a neighbour graph of all vectors: start lists from runs along an order of
pivots, then rounds of joins of neighbours of neighbours.  In a round every node is a centre:
its neighbours and a sample of the nodes that name it are scored against each other, and a
node keeps the best ``links`` it has met.  ``search`` walks the graph greedily for all queries at once:
each round joins the best unexpanded nodes of every query's pool with their links, scores
the links where their vectors are and keeps the ``pool`` best.  It ends when all nodes in all pools are expanded.

Nodes are numbered along the order and live in blocks of ``BLOCK``, queries in groups of ``GROUP``.  Every join
is a shuffle of messages by block or group: a message packs what one of them sends to
another (ids, vectors, scores) as raw numbers, so the rows shuffled are far fewer than the pairs.

Nearness is the inner product.  Where norms differ, the graph is built on vectors with one
more component that brings all to one norm, so that near nodes are near in every direction;
scores are always of the original vectors, in double precision.

Equal vectors are one node with its ``k + 1`` smallest ids, which is all that a list of ``k`` can
hold of them; so a group of copies of any size costs one node and loses no neighbour.

Bounds: a task holds one block with the vectors its lists name, at most ``BLOCK * 2 * links``, or one group
of queries; the driver receives ``2 * PIVOTS`` pivot vectors and a count per range partition; all
else is joins.  Lists per node, reverse samples and pools are the method's own bounds: recall is measured against
brute force, not proven.

Nulls and ties: vectors that are null, empty, zero or hold null or non-finite components take no part;
shorter vectors count as followed by zeros; rows that repeat id and vector are one; an id with several
vectors has the largest score of its pairs; ties go to the smaller id; null ids take no part; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, written

#: Nodes in a block (a power of two: the block of node ``n`` is ``n >> BLOCK_BITS``).
BLOCK_BITS = 11
BLOCK = 1 << BLOCK_BITS
#: Nodes scored against each other to start the graph.
RUN = 512
PIVOTS = 256
#: Queries in a group.
GROUP = 256

#: What blocks and groups send: to whom (``key``), what it is (``kind``: the receiver's own rows come first), from whom.
MESSAGE = "key long, kind int, src long, a binary, b binary, c binary, d binary, e binary"
_NAMES = ["key", "kind", "src", "a", "b", "c", "d", "e"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
Message = tuple


@dataclass
class Index:
    """The written graph: vectors and links by block, ids by node, and the entry points."""

    blocks: DataFrame  # messages: a = vectors
    links: DataFrame  # messages: a = links, -1 where there are fewer
    ids: DataFrame  # nid, ids
    pivot_ids: np.ndarray
    pivots: np.ndarray
    dim: int
    width: int
    n: int
    dtype: type


def _batches(messages: Iterator[Message]) -> Iterator[pa.RecordBatch]:
    """Messages in batches of a few megabytes."""
    held, size = [], 0
    for m in messages:
        m = (*m, *[None] * (8 - len(m)))
        held.append(m)
        size += sum(len(x) for x in m[3:] if x)
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES)], names=_NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES)], names=_NAMES)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Message]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in b.columns)


def _sent(rows: DataFrame, fn: Callable[[Message], Iterator[Message]]) -> DataFrame:
    """What each row sends, without a shuffle."""
    return rows.mapInArrow(lambda batches: _batches(m for r in _rows(batches) for m in fn(r)), MESSAGE)


def _met(rows: DataFrame, fn: Callable[[int, Iterator[Message]], Iterator[Message]], schema: str = MESSAGE) -> DataFrame:
    """What each key sends after it has received its messages, its own rows (the lowest kinds) first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(m for key, group in groupby(_rows(batches), key=lambda r: r[0]) for m in fn(key, group))

    return rows.repartition("key").sortWithinPartitions("key", "kind", "src").mapInArrow(run, schema)


def _all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _kind(rows: DataFrame, kind: int) -> DataFrame:
    return rows.withColumn("kind", F.lit(kind))


def _split(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted array: value and places."""
    if len(owner):
        edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for i, j in zip(edge, [*edge[1:], len(owner)]):
            yield int(owner[i]), slice(int(i), int(j))


def usable(x: F.Column) -> F.Column:
    """Whether a vector takes part: finite throughout and not zero."""
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int, dtype=np.float64) -> np.ndarray:
    """A list column as rows of ``dim`` numbers, short lists filled with zeros (longer ones are cut: the rest would meet zeros)."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim).astype(dtype, copy=False)
    out = np.zeros((len(lengths), dim), dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row[at < dim], at[at < dim]] = flat[at < dim]
    return out


def _even(x: np.ndarray, top: float) -> np.ndarray:
    """Rows brought to squared norm ``top`` by one more component; float32 for the graph."""
    if not top:
        return x.astype(np.float32)
    rest = np.sqrt(np.maximum(top - (x * x).sum(1), 0.0))
    return np.concatenate([x, rest[:, None]], 1).astype(np.float32)


def _best(node: np.ndarray, link: np.ndarray, score: np.ndarray, fresh: np.ndarray, k: int):
    """The ``k`` best distinct links per node (ties to the smaller link), sorted by node; an old entry keeps its mark."""
    order = np.lexsort((fresh, link, node))
    again = np.zeros(len(node), bool)
    again[1:] = (node[order[1:]] == node[order[:-1]]) & (link[order[1:]] == link[order[:-1]])
    order = order[~again]
    order = order[np.lexsort((link[order], -score[order], node[order]))]
    node, link, score, fresh = node[order], link[order], score[order], fresh[order]
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    lengths = np.diff(np.r_[start, len(node)])
    keep = np.arange(len(node)) - np.repeat(start, lengths) < k
    return node[start], np.minimum(lengths, k), link[keep], score[keep], fresh[keep]


def _classes(vectors: DataFrame, id_col: str, vec_col: str, members: int) -> DataFrame:
    """``x, ids``: every distinct usable vector with its ``members`` smallest ids."""
    rows = vectors.select(col(id_col).alias("id"), col(vec_col).alias("x")).filter(F.col("id").isNotNull() & usable(F.col("x"))).distinct()
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("id"))).filter(F.col("r") <= members)
    return ranked.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _ordered(rows: DataFrame, pivots: np.ndarray, top: float, dim: int, n: int) -> DataFrame:
    """``rows (..., x)`` range-partitioned along their best pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = (_even(_matrix(b.column(b.schema.get_field_index("x")), dim), top) @ pivots.T).argmax(1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32())], names=[*b.schema.names, "pivot"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = rows.mapInArrow(run, f"{columns}, pivot int").withColumn("h", F.xxhash64("x"))
    return placed.repartitionByRange(max(1, -(-n // (4 * BLOCK))), "pivot", "h").sortWithinPartitions("pivot", "h")


def _near(x: np.ndarray, k: int):
    """Places and scores of the ``k`` nearest of each row among the rows."""
    m = min(k, len(x) - 1)
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    best = np.argpartition(-near, m - 1, axis=1)[:, :m] if m > 0 else np.zeros((len(x), 0), np.int64)
    return best, np.take_along_axis(near, best, 1)


def _gains(node: np.ndarray, link: np.ndarray, score: np.ndarray, src: int) -> Iterator[Message]:
    """Links offered to nodes (sorted), one message per block of nodes."""
    for block, at in _split(node >> BLOCK_BITS):
        yield block, 1, src, node[at].tobytes(), link[at].tobytes(), score[at].tobytes()


def _first_lists(block: Message, k: int, top: float, dim: int, dtype) -> Iterator[Message]:
    """A block's own graph row: lists from its runs of ``RUN`` nodes.  a = links, b = scores, c = whether new."""
    x = _even(np.frombuffer(block[3], dtype).reshape(-1, dim).astype(np.float64), top)
    links, scores = np.full((len(x), k), -1), np.full((len(x), k), -np.inf, np.float32)
    for at in range(0, len(x), RUN):
        best, near = _near(x[at : at + RUN], k)
        links[at : at + RUN, : best.shape[1]] = (block[0] << BLOCK_BITS) + at + best
        scores[at : at + RUN, : best.shape[1]] = near
    yield block[0], 0, -1, links.tobytes(), scores.tobytes(), (links >= 0).tobytes()


def _run_gains(ordered: DataFrame, k: int, top: float, dim: int) -> DataFrame:
    """Links offered within runs of ``RUN`` nodes of another order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def offers():
            for b in batches:
                ids, x = b.column(0).to_numpy(), _even(_matrix(b.column(1), dim), top)
                for at in range(0, len(ids), RUN):
                    best, near = _near(x[at : at + RUN], k)
                    own = ids[at : at + RUN]
                    node = np.repeat(own, best.shape[1])
                    order = np.argsort(node, kind="stable")
                    yield from _gains(node[order], own[best].ravel()[order], near.ravel()[order].astype(np.float32), int(own[0]))

        yield from _batches(offers())

    return ordered.select("nid", "x").mapInArrow(run, MESSAGE)


def _merged(graph_and_gains: DataFrame, k: int) -> DataFrame:
    """Graph rows (kind 0) with what they gain (kind 1): the ``k`` best links of each node, old ones no longer new."""

    def merge(block: int, group: Iterator[Message]) -> Iterator[Message]:
        own = next(group)
        links = np.frombuffer(own[3], np.int64).reshape(-1, k)
        row, _ = np.nonzero(links >= 0)
        known = links >= 0
        now = [(block << BLOCK_BITS) + row, links[known], np.frombuffer(own[4], np.float32).reshape(-1, k)[known], np.frombuffer(own[5], bool).reshape(-1, k)[known]]
        held, size = [now], len(row)

        def squeeze():
            node, lengths, link, score, fresh = _best(*(np.concatenate(x) for x in zip(*held)), k)
            return [np.repeat(node, lengths), link, score, fresh]

        for m in group:
            node = np.frombuffer(m[3], np.int64)
            held.append([node, np.frombuffer(m[4], np.int64), np.frombuffer(m[5], np.float32), np.ones(len(node), bool)])
            size += len(node)
            if size > 2_000_000:
                held = [squeeze()]
                size = len(held[0][0])
        node, link, score, fresh = squeeze()
        row = node - (block << BLOCK_BITS)
        at = np.arange(len(row)) - np.searchsorted(row, row)
        out = [np.full(links.shape, -1), np.full(links.shape, -np.inf, np.float32), np.zeros(links.shape, bool)]
        for grid, values in zip(out, (link, score, fresh)):
            grid[row, at] = values
        yield block, 0, -1, *(grid.tobytes() for grid in out)

    return _met(graph_and_gains, merge)


def _mix(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of pairs."""
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ ((b.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0xC2B2AE3D27D4EB4F))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _some(node, by, fresh, hashed, most: int):
    """Per node the ``most`` entries with the smallest hash, sorted by node."""
    order = np.lexsort((by, hashed, node))
    node, by, fresh, hashed = node[order], by[order], fresh[order], hashed[order]
    keep = np.arange(len(node)) - np.searchsorted(node, node) < most
    return node[keep], by[keep], fresh[keep], hashed[keep]


def _both_ways(graph: DataFrame, k: int, seed: int, ask: bool) -> DataFrame:
    """Per block its lists with, for each node, up to ``k`` nodes that name it, the first by hash; a new choice each round.

    kind 3: a = members, -1 where there are fewer, b = whether new; only nodes with a new member if ``ask``, and
    then also kind 2, to the blocks of the members: a = whose vectors the block needs.
    """

    def reverse(row: Message) -> Iterator[Message]:
        yield row[0], 0, row[2], row[3], None, row[5]
        links, fresh = np.frombuffer(row[3], np.int64).reshape(-1, k), np.frombuffer(row[5], bool).reshape(-1, k)
        i, j = np.nonzero(links >= 0)
        by, node = (row[0] << BLOCK_BITS) + i, links[i, j]
        node, by, new, _ = _some(node, by, fresh[i, j], _mix(node, by, seed), k)
        for block, at in _split(node >> BLOCK_BITS):
            yield block, 1, row[0], node[at].tobytes(), by[at].tobytes(), new[at].tobytes()

    def centres(block: int, group: Iterator[Message]) -> Iterator[Message]:
        own = next(group)
        links, fresh = np.frombuffer(own[3], np.int64).reshape(-1, k), np.frombuffer(own[5], bool).reshape(-1, k)
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint64)]
        held, size = [kept], 0
        for m in group:
            node, by = np.frombuffer(m[3], np.int64), np.frombuffer(m[4], np.int64)
            held.append([node, by, np.frombuffer(m[5], bool), _mix(node, by, seed)])
            size += len(node)
            if size > 1_000_000:
                held, size = [list(_some(*(np.concatenate(x) for x in zip(*held)), k))], 0
        node, by, new, _ = _some(*(np.concatenate(x) for x in zip(*held)), k)
        row = node - (block << BLOCK_BITS)
        back, back_new = np.full(links.shape, -1), np.zeros(links.shape, bool)
        at = np.arange(len(row)) - np.searchsorted(row, row)
        back[row, at], back_new[row, at] = by, new
        back[(back[:, :, None] == links[:, None, :]).any(2)] = -1
        members, new = np.concatenate([links, back], 1), np.concatenate([fresh, back_new], 1) & (np.concatenate([links, back], 1) >= 0)
        if not ask:
            yield block, 0, -1, members.tobytes()
            return
        busy = new.any(1)
        if not busy.any():
            return
        members, new = members[busy], new[busy]
        yield block, 3, block, members.tobytes(), new.tobytes()
        needed = np.unique(members[members >= 0])
        for home, at in _split(needed >> BLOCK_BITS):
            yield home, 2, block, needed[at].tobytes()

    return _met(_sent(graph, reverse), centres)


def _round(graph: DataFrame, blocks: DataFrame, k: int, top: float, dim: int, dtype, seed: int) -> DataFrame:
    """Messages to blocks: links that the members of a centre gain from each other, where they beat what a node has."""
    asked = written(_both_ways(graph, k, seed, True), "ann-centres")

    def reply(block: int, group: Iterator[Message]) -> Iterator[Message]:
        x = np.frombuffer(next(group)[3], dtype).reshape(-1, dim)
        worst = np.frombuffer(next(group)[4], np.float32).reshape(-1, k).min(1)
        for m in group:
            at = np.frombuffer(m[3], np.int64) - (block << BLOCK_BITS)
            yield m[2], 0, block, m[3], x[at].tobytes(), worst[at].tobytes()

    vectors = _met(_all(_kind(blocks, 0), _kind(graph, 1), asked.filter("kind = 2")), reply)

    def join(block: int, group: Iterator[Message]) -> Iterator[Message]:
        held, found = [], []
        for m in group:
            if m[1] == 0:
                held.append((np.frombuffer(m[3], np.int64), np.frombuffer(m[4], dtype).reshape(-1, dim), np.frombuffer(m[5], np.float32)))
                continue
            ids, x, bar = (np.concatenate(v) for v in zip(*held))  # in order: messages come sorted by block
            x = _even(x.astype(np.float64), top)
            members = np.frombuffer(m[3], np.int64).reshape(-1, 2 * k)
            new = np.frombuffer(m[4], bool).reshape(-1, 2 * k)
            place, size = np.where(members >= 0, np.searchsorted(ids, members), -1), 0
            for at in range(0, len(place), 128):
                p, f = place[at : at + 128], new[at : at + 128]
                near = x[p]
                near = near @ near.transpose(0, 2, 1)
                ok = near > bar[p][:, :, None]
                ok &= f[:, :, None] | f[:, None, :]
                ok &= (p >= 0)[:, :, None] & (p >= 0)[:, None, :]
                ok &= p[:, :, None] != p[:, None, :]
                c, i, j = np.nonzero(ok)
                found.append((p[c, i], p[c, j], near[c, i, j], np.ones(len(c), bool)))
                size += len(c)
                if size > 2_000_000:
                    node, lengths, link, score, fresh = _best(*(np.concatenate(v) for v in zip(*found)), k)
                    found, size = [(np.repeat(node, lengths), link, score, fresh)], len(link)
            node, lengths, link, score, _ = _best(*(np.concatenate(v) for v in zip(*found)), k)
            yield from _gains(np.repeat(ids[node], lengths), ids[link], score, block)

    return _met(_all(vectors, asked.filter("kind = 3")), join)


def _numbered(found: DataFrame, ordered: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``nid, x, ids``: nodes numbered without gaps along the order."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pid] * b.num_rows, pa.int32()), pa.array(np.arange(at, at + b.num_rows, dtype=np.int64)), b.column(0), b.column(1)], names=["pid", "i", "x", "ids"])
            at += b.num_rows

    rows = written(ordered.select("x", "ids").mapInArrow(number, f"pid int, i long, x {kinds['x']}, ids {kinds['ids']}"), "ann-order")
    sizes = sorted((r.pid, r.n) for r in rows.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per range partition
    starts, total = [], 0
    for pid, n in sizes:
        starts.append((pid, total))
        total += n
    first = rows.sparkSession.createDataFrame(starts, "pid int, first long")
    return rows.join(F.broadcast(first), "pid").select((F.col("first") + F.col("i")).alias("nid"), "x", "ids")


def _packed(nodes: DataFrame, dim: int, dtype) -> DataFrame:
    """The vectors of each block as one message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            now, held = None, []
            for b in batches:
                ids, x = b.column(0).to_numpy() >> BLOCK_BITS, _matrix(b.column(1), dim, dtype)
                for block, at in _split(ids):
                    if block != now and held:
                        yield now, 0, -1, np.concatenate(held).tobytes()
                        held = []
                    now = block
                    held.append(x[at])
            if held:
                yield now, 0, -1, np.concatenate(held).tobytes()

        yield from _batches(blocks())

    rows = nodes.select("nid", "x").repartition(F.shiftright("nid", BLOCK_BITS)).sortWithinPartitions("nid")
    return rows.mapInArrow(run, MESSAGE)


def build(vectors: DataFrame, k: int = 20, links: int = 40, rounds: int = 5, settled: float = 0.08, id_col: str = "vec_id", vec_col: str = "embedding") -> Index:
    """The graph of all vectors, ready for searches of up to ``k`` neighbours.

    Rounds end after ``rounds``, or when under ``settled`` of all links are new.
    """
    found = written(_classes(vectors, id_col, vec_col, k + 1), "ann-classes")
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    n, dim, least, most = found.agg(F.count(F.lit(1)), F.max(F.size("x")), F.min(norm), F.max(norm)).first()
    if not n:
        none = vectors.sparkSession.createDataFrame([], MESSAGE)
        return Index(none, none, found.select(F.lit(0).cast("long").alias("nid"), "ids"), np.zeros(0, np.int64), np.zeros((0, 1)), 1, 1, 0, np.float64)
    top = 0.0 if most - least <= 1e-5 * most else float(most)
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    dtype = np.float32 if kinds["x"] == "array<float>" else np.float64
    drawn = np.array([(list(r.x) + [0.0] * dim)[:dim] for r in found.orderBy(F.xxhash64("x"), "x").select("x").limit(PIVOTS).collect()], np.float64)
    sides = [_even(drawn[t::2] if len(drawn) > 1 else drawn, top) for t in range(2)]
    nodes = written(_numbered(found, _ordered(found, sides[0], top, dim, n), kinds), "ann-nodes")
    blocks = written(_packed(nodes, dim, dtype), "ann-blocks")
    first = _sent(blocks, lambda row: _first_lists(row, links, top, dim, dtype))
    graph = written(_merged(_all(first, _run_gains(_ordered(nodes.select("nid", "x"), sides[1], top, dim, n), links, top, dim)), links), "ann-graph")
    for seed in range(rounds):
        gained = _round(graph, blocks, links, top, dim, dtype, seed)
        old = graph.mapInArrow(_aged, MESSAGE)
        graph = written(_merged(_all(old, gained), links), "ann-graph")
        if _share_new(graph) <= settled:
            break
    joined = written(_both_ways(graph, links, -1, False), "ann-links")
    largest = nodes.orderBy(F.desc(norm), "nid").limit(PIVOTS if top else 0)
    entry = nodes.orderBy(F.xxhash64("x"), "nid").limit(PIVOTS).unionByName(largest).dropDuplicates(["nid"]).select("nid", "x").collect()
    pivots = np.array([(list(r.x) + [0.0] * dim)[:dim] for r in entry], np.float64)
    return Index(blocks, joined, nodes.select("nid", "ids"), np.array([r.nid for r in entry], np.int64), pivots, int(dim), 2 * links, int(n), dtype)


def _aged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Graph rows with no link new."""
    yield from _batches((*r[:5], bytes(len(r[3]) // 8)) for r in _rows(batches))


def _share_new(graph: DataFrame) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(r[5], bool).sum())]), pa.array([int((np.frombuffer(r[3], np.int64) >= 0).sum())])], names=["new", "links"])

    new, links = graph.mapInArrow(run, "new long, links long").agg(F.sum("new"), F.sum("links")).first()
    return new / links if links else 0.0


# ---- search ------------------------------------------------------------------------------------------------


class _Group:
    """A group's state: a = query numbers, b = vectors, c = pools, d = scores, e = whether still to be expanded."""

    def __init__(self, m: Message, dim: int, pool: int):
        self.key, self.q, self.x = m[0], np.frombuffer(m[3], np.int64), np.frombuffer(m[4], np.float64).reshape(-1, dim)
        self.nodes, self.scores = np.frombuffer(m[5], np.int64).reshape(-1, pool).copy(), np.frombuffer(m[6], np.float64).reshape(-1, pool).copy()
        self.open = np.frombuffer(m[7], bool).reshape(-1, pool).copy()

    def message(self) -> Message:
        return self.key, 0, int(self.open.sum()), self.q.tobytes(), self.x.tobytes(), self.nodes.tobytes(), self.scores.tobytes(), self.open.tobytes()


def _entered(queries: DataFrame, index: Index, pool: int, starts: int) -> DataFrame:
    """Groups of ``queries (q long, x array)`` with their best pivots."""
    dim, pivot_ids, pivots = index.dim, index.pivot_ids, index.pivots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            number = TaskContext.get().partitionId() << 32
            for b in batches:
                for at in range(0, b.num_rows, GROUP):
                    part = b.slice(at, GROUP)
                    x = _matrix(part.column(1), dim)
                    score = np.stack([(pivots * v).sum(1) for v in x])
                    m = min(starts, len(pivot_ids), pool)
                    best = np.argsort(-score, axis=1, kind="stable")[:, :m]
                    nodes, scores, wide = np.full((len(x), pool), -1), np.full((len(x), pool), -np.inf), np.zeros((len(x), pool), bool)
                    nodes[:, :m], scores[:, :m], wide[:, :m] = pivot_ids[best], np.take_along_axis(score, best, 1), True
                    yield number, 0, int(wide.sum()), part.column(0).to_numpy().tobytes(), x.tobytes(), nodes.tobytes(), scores.tobytes(), wide.tobytes()
                    number += 1

        yield from _batches(groups())

    return queries.select("q", "x").mapInArrow(run, MESSAGE)


def search(index: Index, queries: DataFrame, pool: int = 256, frontier: int = 64, starts: int = 16) -> DataFrame:
    """``q, place, nid, score`` of ``queries (q long, x array)``: per query the ``pool`` best nodes that a greedy walk of the graph meets."""
    dim, width, dtype = index.dim, index.width, index.dtype
    if not index.n:
        return queries.select("q", F.lit(0).alias("place"), F.lit(0).cast("long").alias("nid"), F.lit(0.0).alias("score")).limit(0)

    def expand(m: Message) -> Iterator[Message]:
        g = _Group(m, dim, pool)
        step = g.open & (np.cumsum(g.open, 1) <= frontier)
        g.open &= ~step
        yield g.message()
        row, at = np.nonzero(step)
        node = g.nodes[row, at]
        order = np.argsort(node, kind="stable")
        row, node = row[order].astype(np.int32), node[order]
        for block, part in _split(node >> BLOCK_BITS):
            yield block, 1, g.key, row[part].tobytes(), node[part].tobytes()

    def linked(block: int, group: Iterator[Message]) -> Iterator[Message]:
        links = np.frombuffer(next(group)[3], np.int64).reshape(-1, width)
        for m in group:
            near = links[np.frombuffer(m[4], np.int64) - (block << BLOCK_BITS)]
            row, known = np.repeat(np.frombuffer(m[3], np.int32), width), near.ravel() >= 0
            pairs = np.unique((row[known].astype(np.int64) << 48) | near.ravel()[known])
            yield m[2], 1, block, pairs.tobytes()

    def ask(key: int, group: Iterator[Message]) -> Iterator[Message]:
        g = _Group(next(group), dim, pool)
        held = [np.frombuffer(m[3], np.int64) for m in group]
        if not held:
            return
        pairs = np.unique(np.concatenate(held))
        row, at = np.nonzero(g.nodes >= 0)
        pairs = pairs[~np.isin(pairs, (row << 48) | g.nodes[row, at])]
        row, node = (pairs >> 48).astype(np.int32), pairs & ((1 << 48) - 1)
        order = np.argsort(node, kind="stable")
        row, node, bar = row[order], node[order], g.scores[:, -1]
        for block, part in _split(node >> BLOCK_BITS):
            own = np.unique(row[part])
            yield block, 1, key, row[part].tobytes(), node[part].tobytes(), own.tobytes(), g.x[own].tobytes(), bar[own].tobytes()

    def score(block: int, group: Iterator[Message]) -> Iterator[Message]:
        x = np.frombuffer(next(group)[3], dtype).reshape(-1, dim).astype(np.float64)
        for m in group:
            row, node, own = np.frombuffer(m[3], np.int32), np.frombuffer(m[4], np.int64), np.frombuffer(m[5], np.int32)
            at = np.searchsorted(own, row)
            got = (x[node - (block << BLOCK_BITS)] * np.frombuffer(m[6], np.float64).reshape(-1, dim)[at]).sum(1)
            keep = got >= np.frombuffer(m[7], np.float64)[at]
            if keep.any():
                yield m[2], 1, block, row[keep].tobytes(), node[keep].tobytes(), got[keep].tobytes()

    def keep(key: int, group: Iterator[Message]) -> Iterator[Message]:
        g = _Group(next(group), dim, pool)
        row, at = np.nonzero(g.nodes >= 0)
        held = [(row, g.nodes[row, at], g.scores[row, at], g.open[row, at])]
        for m in group:
            row = np.frombuffer(m[3], np.int32).astype(np.int64)
            held.append((row, np.frombuffer(m[4], np.int64), np.frombuffer(m[5], np.float64), np.ones(len(row), bool)))
        row, lengths, node, value, wide = _best(*(np.concatenate(v) for v in zip(*held)), pool)
        row = np.repeat(row, lengths)
        at = np.arange(len(row)) - np.searchsorted(row, row)
        for grid, empty, values in ((g.nodes, -1, node), (g.scores, -np.inf, value), (g.open, False, wide)):
            grid[:] = empty
            grid[row, at] = values
        yield g.message()

    state = written(_entered(queries, index, pool, starts), "ann-pools")
    while state.filter("src > 0").limit(1).count():
        step = written(_sent(state, expand), "ann-steps")
        groups = step.filter("kind = 0")
        links = _met(_all(index.links, step.filter("kind = 1")), linked)
        asked = _met(_all(groups, links), ask)
        state = written(_met(_all(groups, _met(_all(index.blocks, asked), score)), keep), "ann-pools")

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            g = _Group(r, dim, pool)
            row, at = np.nonzero(g.nodes >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(g.q[row]), pa.array(at.astype(np.int32)), pa.array(g.nodes[row, at]), pa.array(g.scores[row, at])], names=["q", "place", "nid", "score"])

    return state.mapInArrow(out, "q long, place int, nid long, score double")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, links: int = 40, rounds: int = 5, pool: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row of ``queries``, own id aside.

    ``queries`` has the columns of ``vectors``; ids are integers.
    """
    index = build(vectors, k, links, rounds, id_col=id_col, vec_col=vec_col)
    asked = queries.select(col(id_col).cast("long").alias("id"), col(vec_col).alias("x")).filter(F.col("id").isNotNull() & usable(F.col("x"))).distinct()
    asked = written(asked.withColumn("q", F.monotonically_increasing_id()), "ann-queries")
    # k + 1 nodes hold the k nearest ids besides the query's own
    best = search(index, asked.select("q", "x"), max(pool, 2 * k)).filter(F.col("place") <= k)
    pairs = best.join(index.ids, "nid").join(asked.select("q", "id"), "q").select(F.col("id").alias("query_id"), F.explode("ids").alias("vec_id"), "score")
    pairs = pairs.filter(F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.cast("int").alias("rank"), F.col("vec_id").cast("long").alias("vec_id"), "score").filter(F.col("rank") <= k)
