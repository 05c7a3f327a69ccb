"""Reversible line deduplication (operator 2).

State: two exact tables and one filter per shard.

* ``refs(shard, key, doc_id)``: which document holds which line, one row each.
* ``counts(shard, key, n_docs, last_doc)``: the reference count of every line key
  and the largest id that holds it.
* ``filters(shard, cells)``: a cuckoo filter of the keys with at least
  ``min_docs`` references.  A key enters when its count reaches the bound and leaves
  when a deletion takes it below, so inserting and deleting documents in any
  order gives the state of the documents that remain.

The filter only saves work: a line that misses it is kept without a look at the
tables, a line that hits it is decided by the exact table.  Keys are SHA-256
digests of the normalised line.

Nulls and ties: a null or empty text is one empty line; a null id is one document,
smaller than any other; two rows of one id are one document for the counts, and
both are rewritten; a key inside one text counts once; an empty table gives an
empty result; other columns are carried unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, binary, col, join_row, looked_up, split_row, written

STRIP = SPACE.encode()
SLOTS = 4
KICKS = 500


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line's key, or None below ``min_chars`` code points."""
    key = line.strip(STRIP).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.sha256(key).digest()


class CuckooFilter:
    """Sixteen-bit prints in buckets of four, with insertion, deletion and lookup.

    Both buckets of a print follow from either one (partial-key hashing), so a
    deletion finds what an insertion left.  ``insert`` returns False when the
    filter is too full; the caller builds a larger one from the exact table.
    """

    def __init__(self, capacity: int = 64, cells: np.ndarray | None = None):
        if cells is None:
            buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85)))))
            cells = np.zeros((buckets, SLOTS), np.uint16)
        self.cells = cells
        self.mask = len(cells) - 1

    @staticmethod
    def from_bytes(raw: bytes) -> CuckooFilter:
        return CuckooFilter(cells=np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, h):
        """Print and both buckets of 64-bit hashes (scalars or arrays of uint64)."""
        h = np.asarray(h, np.uint64)
        tag = np.maximum(h >> np.uint64(48), np.uint64(1))
        first = h & np.uint64(self.mask)
        return tag, first, self._other(first, tag)

    def _other(self, bucket, tag):
        jump = (tag * np.uint64(0x5BD1E995)) ^ (tag >> np.uint64(3))
        return (bucket ^ jump) & np.uint64(self.mask)

    def contains(self, h) -> np.ndarray:
        tag, a, b = self._places(h)
        tag = tag.astype(np.uint16)[..., None]
        return (self.cells[a.astype(np.int64)] == tag).any(-1) | (self.cells[b.astype(np.int64)] == tag).any(-1)

    def _place(self, h: int) -> tuple[int, int, int]:
        """The same for one Python integer."""
        tag, first = max(h >> 48, 1), h & self.mask
        return tag, first, (first ^ (tag * 0x5BD1E995) ^ (tag >> 3)) & self.mask

    def insert(self, h: int) -> bool:
        tag, a, b = self._place(h)
        for bucket in (a, b):
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = tag
                return True
        bucket = a
        for kick in range(KICKS):
            slot = (tag + kick) % SLOTS
            tag, self.cells[bucket, slot] = int(self.cells[bucket, slot]), tag
            bucket = (bucket ^ (tag * 0x5BD1E995) ^ (tag >> 3)) & self.mask
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = tag
                return True
        return False

    def delete(self, h: int) -> bool:
        tag, a, b = self._place(h)
        for bucket in (a, b):
            at = np.flatnonzero(self.cells[bucket] == tag)
            if len(at):
                self.cells[bucket, at[0]] = 0
                return True
        return False

    @staticmethod
    def build(hashes: np.ndarray) -> CuckooFilter:
        """A filter of all ``hashes`` (distinct keys), grown until they fit."""
        capacity = max(64, len(hashes))
        while True:
            out = CuckooFilter(capacity)
            if all(out.insert(h) for h in hashes.tolist()):
                return out
            capacity *= 2


def _hash64(key: pa.Array) -> np.ndarray:
    """The first eight bytes of each digest."""
    return np.array([int.from_bytes(k[:8], "little") for k in key.to_pylist()], np.uint64)


@dataclass
class LineState:
    """The reversible state; every member is a written table."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int


def references(docs: DataFrame, shards: int, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``shard, key, doc_id``: one row per document and distinct long line."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys = [], []
            for i, text in enumerate(binary(b.column(1))):
                own = {line_key(x, min_chars) for x in text.split(b"\n")} if text and len(text) >= min_chars else set()
                own.discard(None)
                keys.extend(own)
                at.extend([i] * len(own))
            shard = [int.from_bytes(k[8:12], "little") % shards for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(keys, pa.binary()), b.column(0).take(pa.array(at, pa.int64()))], names=["shard", "key", "doc_id"]
            )

    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("t")).mapInArrow(run, f"shard int, key binary, doc_id {kind}")
    return rows.distinct()


def _counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


def _filters(changes: DataFrame, old: DataFrame | None) -> DataFrame:
    """Filters per shard after ``changes (shard, key, into)``, each shard streamed past its old filter.

    Where an insertion no longer fits, the shard is marked with null cells and built
    anew by the caller from the exact counts.
    """
    rows = changes.select("shard", F.lit(1).alias("kind"), "key", "into", F.lit(None).cast("binary").alias("cells"))
    if old is not None:
        rows = rows.unionByName(old.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("boolean").alias("into"), "cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            if now is not None:
                cells = None if state is False else CuckooFilter.build(np.array(fresh, np.uint64)).to_bytes() if state is None else state.to_bytes()
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([cells], pa.binary())], names=["shard", "cells"])

        now, state, fresh = None, None, []  # fresh: the hashes of a shard without an old filter
        for b in batches:
            for shard, kind, key, into, cells in zip(*(c.to_pylist() for c in b.columns)):
                if shard != now:
                    yield from done()
                    now, state, fresh = shard, None, []
                if kind == 0:
                    state = CuckooFilter.from_bytes(cells)
                    continue
                h = int.from_bytes(key[:8], "little")
                if state is None:
                    fresh.append(h)
                elif state is not False and not (state.insert(h) if into else state.delete(h)):
                    state = False
        yield from done()

    return rows.repartition("shard").sortWithinPartitions("shard", "kind", "into").mapInArrow(run, "shard int, cells binary")


def _state(refs: DataFrame, old: LineState | None, shards: int, min_docs: int, min_chars: int) -> LineState:
    refs = refs if old is None else written(refs, "line-refs")
    counts = written(_counts(refs), "line-counts")
    heavy = counts.filter(F.col("n_docs") >= min_docs).select("shard", "key")
    if old is None:
        filters = written(_filters(heavy.withColumn("into", F.lit(True)), None), "line-filters")
    else:
        was = old.counts.filter(F.col("n_docs") >= min_docs).select("shard", "key")
        changes = heavy.join(was, ["shard", "key"], "left_anti").withColumn("into", F.lit(True))
        changes = changes.unionByName(was.join(heavy, ["shard", "key"], "left_anti").withColumn("into", F.lit(False)))
        new = written(_filters(changes, old.filters), "line-filters")
        full = new.filter("cells is null").select("shard")
        rebuilt = _filters(heavy.join(full, "shard", "left_semi").withColumn("into", F.lit(True)), None)
        filters = written(new.filter("cells is not null").unionByName(rebuilt), "line-filters")
    return LineState(refs, counts, filters, shards, min_docs, min_chars)


def start(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, shard_keys: int = 250_000, id_col: str = "doc_id", text_col: str = "text") -> LineState:
    """The state of a first set of documents.

    The number of shards follows from the number of references, ``shard_keys`` each,
    so that one filter stays about a megabyte at any size.
    """
    refs = written(references(docs, 1 << 30, min_chars, id_col, text_col), "line-refs")
    shards = max(8, -(-refs.count() // shard_keys))
    refs = refs.withColumn("shard", F.pmod("shard", F.lit(shards)).cast("int"))
    return _state(refs, None, shards, min_docs, min_chars)


def insert(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineState:
    """The state after more documents; ids already there gain the new lines."""
    new = references(docs, 1 << 30, state.min_chars, id_col, text_col).withColumn("shard", F.pmod("shard", F.lit(state.shards)).cast("int"))
    return _state(state.refs.unionByName(new).distinct(), state, state.shards, state.min_docs, state.min_chars)


def delete(state: LineState, ids: DataFrame, id_col: str = "doc_id") -> LineState:
    """The state after the documents with these ids are taken out."""
    gone = ids.select(col(id_col).alias("__gone")).distinct()
    left = state.refs.join(gone, state.refs["doc_id"].eqNullSafe(gone["__gone"]), "left_anti")
    return _state(left, state, state.shards, state.min_docs, state.min_chars)


def dropped_keys(state: LineState, salts: int = 16) -> DataFrame:
    """``doc_id, keys``: per document the digests of the lines it loses.

    References stream past the filter of their shard; a shard is salted by document,
    so a line in a third of all documents spreads over ``salts`` tasks, and a filter is
    sent once per salt.  What hits is decided by the exact counts; those of the few hottest lines are broadcast.
    """
    ask = state.refs.select(
        "shard", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), F.lit(1).alias("kind"), "key", "doc_id", F.lit(None).cast("binary").alias("cells")
    )
    send = state.filters.select(
        "shard",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast(state.refs.schema["doc_id"].dataType).alias("doc_id"),
        "cells",
    )
    kind = state.refs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, here = None, None
        for b in batches:
            shards, kinds = b.column(0).to_numpy(), b.column(2).to_numpy()
            edge = np.flatnonzero(np.r_[True, (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1]) | (kinds[1:] == 0)])
            for i, j in zip(edge, [*edge[1:], len(shards)]):
                if kinds[i] == 0:
                    held, here = CuckooFilter.from_bytes(b.column(5)[int(i)].as_py()), shards[i]
                elif here == shards[i]:  # no filter: nothing of that shard is frequent
                    part = b.slice(int(i), int(j - i))
                    part = part.filter(pa.array(held.contains(_hash64(part.column(3)))))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), part.column(4)], names=["shard", "key", "doc_id"])

    rows = ask.unionByName(send).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    hits = written(rows.mapInArrow(run, f"shard int, key binary, doc_id {kind}"), "line-hits")
    heavy = state.counts.filter(F.col("n_docs") >= state.min_docs).select("shard", "key", "last_doc", "n_docs")
    total = heavy.agg(F.sum("n_docs")).first()[0] or 0
    lost = looked_up(hits, heavy, ["shard", "key"], "n_docs", total).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def apply(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id, __row, kept, n_lines, n_dropped`` of every row: the text without its dropped lines."""
    rows = split_row(docs, id_col, text_col)
    lost = dropped_keys(state)
    joined = rows.join(lost, rows["__id"].eqNullSafe(lost["doc_id"]), "left").select("__id", "__row", "__text", "keys")
    min_chars = state.min_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, total, gone = [], [], []
            for text, keys in zip(binary(b.column(2)), b.column(3).to_pylist()):
                text = text or b""
                n = text.count(b"\n") + 1
                if keys:
                    lose = set(keys)
                    lines = [x for x in text.split(b"\n") if line_key(x, min_chars) not in lose]
                    text, left = b"\n".join(lines), len(lines)
                else:
                    left = n
                kept.append(text)
                total.append(n)
                gone.append(n - left)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                names=["__id", "__row", "kept", "n_lines", "n_dropped"],
            )

    schema = T.StructType([joined.schema["__id"], joined.schema["__row"]]).add("kept", "string").add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(run, schema)


def dedup(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kept, n_lines, n_dropped`` of every row of one whole table."""
    out = apply(start(docs, min_docs, min_chars, id_col=id_col, text_col=text_col), docs, id_col, text_col)
    return out.select(F.col("__id").alias("doc_id"), "kept", "n_lines", "n_dropped")


def rewrite(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with its columns unchanged and every text without its dropped lines."""
    out = apply(start(docs, min_docs, min_chars, id_col=id_col, text_col=text_col), docs, id_col, text_col)
    return join_row(out, docs.columns, text_col, F.col("kept"))
