"""Prefix trie of conversations by block digests (operator 13).

A conversation is its turns in order; a node of the trie is a distinct sequence of first turns.
Every turn has a 16-byte digest of role and text, and a prefix the polynomial sum of its turns'
digests modulo a prime, so prefixes of one conversation are running sums: they are
taken over range partitions and joined at the cuts, and no conversation has to fit in one task.

Conversations are grouped by the prefixes at the ends of successive blocks of ``block`` turns.  A
block whose start has one continuation is a chain: its nodes follow from the group.  Only the
continuations of a start that has several are taken apart by turn and grouped again.
Sums over subtrees add up within blocks first (a node has fewer than ``block`` ancestors in
its own), then between blocks by pointer doubling, which takes as many rounds as the
logarithm of the largest number of blocks.

Bounds: a row holds the digests of one block, or of one conversation the places where range partitions cut it.
A key that many rows refer to (the root, a common opening) is looked up by broadcast: at
most 1000 keys can have more than one in 1000 of the rows.  The ids of a node's ends are joined in parts by
range; only the chain of its SHA-256 runs over the parts in one task, streaming.

Nulls and ties: a null role or text is empty; a null turn comes first; equal turns are ordered by role, then by the
text's first 256 characters, then by digest; repeated rows are turns of their own; rows without a conversation
id belong to none and are left out; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import binary, col, looked_up, written

PRIME = (1 << 127) - 1
#: A fixed number to the powers of which digests are weighted.
BASE = 0x5A8F_26C1_9D37_4EB1_63D9_07F5_B84C_21AD
ROOT = bytes(16)
#: Original turns that a rebuilt conversation may take from another one.
MOST_SHARED = 3


def _raw(x: int) -> bytes:
    return x.to_bytes(16, "little")


def _int(x: bytes) -> int:
    return int.from_bytes(x, "little")


def _digests(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, role, head, x, words``: a digest and a word count in place of every text."""
    rows = turns.select(
        col(conv).cast("long").alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text")
    ).filter("conv_id is not null")
    rows = rows.select("conv_id", "turn", "role", F.substring("text", 1, 256).alias("head"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, words = [], []
            for r, t in zip(binary(b.column(2)), binary(b.column(4))):
                h = hashlib.blake2b(len(r).to_bytes(8, "little") + r, digest_size=16)
                h.update(t)
                x.append(h.digest())
                words.append(len(t.split()))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(x, pa.binary()), pa.array(words, pa.int64())], names=["conv_id", "turn", "role", "head", "x", "words"])

    return rows.mapInArrow(run, f"conv_id long, turn {rows.schema['turn'].dataType.simpleString()}, role string, head string, x binary, words long")


def _sums(digests: DataFrame) -> DataFrame:
    """``conv_id, pid, i, a, words``: turns numbered, and their digests summed, within each range partition ``pid``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, now, i, a, power = TaskContext.get().partitionId(), None, 0, 0, 1
        for b in batches:
            at, sums = [], []
            for c, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if c != now:
                    now, i, a, power = c, 0, 0, 1
                i, power = i + 1, power * BASE % PRIME
                a = (a + _int(x) * power) % PRIME
                at.append(i)
                sums.append(_raw(a))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([pid] * b.num_rows, pa.int32()), pa.array(at, pa.int64()), pa.array(sums, pa.binary()), b.column(2)], names=["conv_id", "pid", "i", "a", "words"]
            )

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "head", "x"]
    rows = digests.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("conv_id", "x", "words").mapInArrow(run, "conv_id long, pid int, i long, a binary, words long")


def _conversations(sums: DataFrame) -> DataFrame:
    """One row per conversation: its length, its first prefixes and their last words, and per run (``pid``) the turns and the sum before it."""
    firsts = [F.max(F.when(F.col("i") == t, F.struct("a", "words"))).alias(f"f{t}") for t in range(1, MOST_SHARED + 1)]
    runs = sums.groupBy("conv_id", "pid").agg(F.max("i").alias("n"), F.max_by("a", "i").alias("end"), *firsts)
    rows = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pid", "n", "end", *(f"f{t}" for t in range(1, MOST_SHARED + 1))))).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for c, pieces in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, a, first, last_words, cuts = 0, 0, [], [], []
                for p in pieces:
                    power = pow(BASE, n, PRIME)
                    for t in range(1, MOST_SHARED + 1):
                        if p[f"f{t}"] and len(first) < MOST_SHARED:
                            first.append(_raw((a + _int(p[f"f{t}"]["a"]) * power) % PRIME))
                            last_words.append(p[f"f{t}"]["words"])
                    cuts.append({"pid": p["pid"], "before": n, "sum": _raw(a)})
                    n, a = n + p["n"], (a + _int(p["end"]) * power) % PRIME
                out.append({"conv_id": c, "n": n, "first": first, "first_words": last_words, "cuts": cuts})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("n", pa.int64()), ("first", pa.list_(pa.binary())), ("first_words", pa.list_(pa.int64())),
            ("cuts", pa.list_(pa.struct([("pid", pa.int32()), ("before", pa.int64()), ("sum", pa.binary())]))),
        ]
    )
    return rows.mapInArrow(run, "conv_id long, n long, first array<binary>, first_words array<long>, cuts array<struct<pid:int,before:long,sum:binary>>")


def prefixes(sums: DataFrame, convs: DataFrame, shared: Column | None = None, origin: Column | None = None) -> DataFrame:
    """``conv_id, depth, p, words, ends`` of every rebuilt conversation: one row per turn, ``ends`` on its last one.

    ``shared`` (0 to 3) is how many first turns come from conversation ``origin`` in place of the same number of
    own ones; both are expressions of ``conv_id``, None for conversations as they are.
    """
    h, base = (F.lit(0), F.col("conv_id")) if shared is None else (shared.cast("int"), origin)
    given = convs.select(F.col("conv_id").alias("base"), F.col("first").alias("given"), F.col("first_words").alias("given_words"))
    rows = convs.withColumn("h", h).withColumn("base", base.cast("long")).join(given, "base", "left")
    rows = rows.withColumn("took", F.least("h", F.coalesce(F.size("given"), F.lit(0)))).withColumn("length", F.col("took") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))

    heads = rows.filter("took > 0").select("conv_id", "length", F.posexplode(F.slice(F.arrays_zip("given", "given_words"), 1, F.col("took"))).alias("at", "e"))
    heads = heads.select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), F.col("e.given").alias("p"), F.col("e.given_words").alias("words"), (F.col("at") + 1 == F.col("length")).alias("ends"))

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per run: a prefix is ``add + times * a``."""
        for b in batches:
            out = []
            for c, h, took, length, n, first, given, cuts in zip(*(x.to_pylist() for x in b.columns)):
                head = _int(given[took - 1]) if took else 0
                left_out, back = _int(first[h - 1]) if h else 0, pow(BASE, took - h, PRIME)
                for cut in cuts:
                    add = (head + (_int(cut["sum"]) - left_out) * back) % PRIME
                    times = pow(BASE, cut["before"], PRIME) * back % PRIME
                    out.append({"conv_id": c, "pid": cut["pid"], "skip": h - cut["before"], "shift": cut["before"] + took - h, "length": length, "add": _raw(add), "times": _raw(times)})
            yield pa.RecordBatch.from_pylist(out, schema=move_schema)

    move_schema = pa.schema(
        [("conv_id", pa.int64()), ("pid", pa.int32()), ("skip", pa.int64()), ("shift", pa.int64()), ("length", pa.int64()), ("add", pa.binary()), ("times", pa.binary())]
    )
    runs = rows.filter("n > h").select("conv_id", "h", "took", "length", "n", "first", "given", "cuts").mapInArrow(
        moves, "conv_id long, pid int, skip long, shift long, length long, add binary, times binary"
    )
    # a long conversation is in many runs, so this join has no hot key
    own = sums.join(runs, ["conv_id", "pid"]).filter("i > skip").select("conv_id", (F.col("i") + F.col("shift")).alias("depth"), "length", "words", "a", "add", "times")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [_raw((_int(add) + _int(times) * _int(a)) % PRIME) for a, add, times in zip(*(b.column(i).to_pylist() for i in (4, 5, 6)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.binary()), b.column(3), b.column(2)], names=["conv_id", "depth", "p", "words", "length"])

    own = own.mapInArrow(place, "conv_id long, depth long, p binary, words long, length long")
    return heads.unionByName(own.select("conv_id", "depth", "p", "words", (F.col("depth") == F.col("length")).alias("ends")))


def _segments(turns: DataFrame, block: int) -> DataFrame:
    """``start, last, n, conv_id, items``: the distinct blocks of turns with the conversations that run through each."""
    b = F.lit(block)
    own = turns.select("conv_id", F.floor((F.col("depth") - 1) / b).alias("j"), F.lit(None).cast("binary").alias("start"), F.struct("depth", "p", "words").alias("item"))
    edge = turns.filter(F.col("depth") % b == 0).select("conv_id", F.floor(F.col("depth") / b).alias("j"), F.col("p").alias("start"), F.lit(None).cast(own.schema["item"].dataType).alias("item"))
    parts = own.unionByName(edge).groupBy("conv_id", "j").agg(F.max("start").alias("start"), F.sort_array(F.collect_list("item")).alias("items")).filter(F.size("items") > 0)
    parts = parts.select("conv_id", F.coalesce("start", F.lit(ROOT)).alias("start"), F.element_at("items", -1)["p"].alias("last"), "items")
    return parts.groupBy("start", "last").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.first("items").alias("items"))


def _nodes(segments: DataFrame, total: int) -> DataFrame:
    """``p, depth, n_convs, conv_id, words, parent, above, start``: every node but the root, with its ancestors in its block."""
    starts = segments.groupBy("start").agg(F.count(F.lit(1)).alias("ways"))
    known = looked_up(segments, starts.withColumn("branches", F.col("ways") > 1), ["start"], "ways", total)
    turns = known.select("start", "n", "conv_id", "branches", "items", F.posexplode("items").alias("at", "item")).select(
        F.col("item.p").alias("p"),
        F.col("item.depth").alias("depth"),
        F.col("n").alias("n_convs"),
        "conv_id",
        F.col("item.words").alias("words"),
        F.when(F.col("at") == 0, F.col("start")).otherwise(F.get("items", F.col("at") - 1)["p"]).alias("parent"),
        F.transform(F.slice("items", 1, F.col("at")), lambda e: e["p"]).alias("above"),
        "start",
        "branches",
    )
    chains = turns.filter(~F.col("branches")).drop("branches")
    parted = turns.filter("branches").groupBy("p").agg(
        F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        *(F.first(c).alias(c) for c in ("words", "parent", "above", "start")),
    )
    return chains.unionByName(parted)


def _below(nodes: DataFrame, block: int, total: int) -> DataFrame:
    """``p, leaves, saved``: sums over everything below each block end, by pointer doubling."""
    sums = [F.sum("leaf").alias("leaves"), F.sum("save").alias("saved")]
    regions = nodes.filter(F.col("start") != F.lit(ROOT)).groupBy("start").agg(*sums).withColumnRenamed("start", "p")
    ends = nodes.filter(F.col("depth") % block == 0).select("p", F.when(F.col("start") != F.lit(ROOT), F.col("start")).alias("up"))
    state = written(ends.join(regions, "p", "left").select("p", "up", F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved")), "trie-blocks")
    while True:
        left = state.filter("up is not null")
        gain = left.groupBy("up").agg(F.count(F.lit(1)).alias("asks"), F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        if not gain.limit(1).count():
            return state.select("p", "leaves", "saved")
        gain = written(gain, "trie-gain")
        facts = state.select(F.col("p").alias("up"), F.col("up").alias("next")).join(gain.select("up", "asks"), "up")
        moved = looked_up(left.select("p", "up"), facts, ["up"], "asks", total).select("p", F.col("next").alias("up"))
        added = state.drop("up").join(gain.select(F.col("up").alias("p"), "l", "s"), "p", "left")
        added = added.select("p", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        state = written(added.join(moved, "p", "left").select("p", "up", "leaves", "saved"), "trie-blocks")


def _ends(rows: DataFrame, part: int = 4096) -> DataFrame:
    """``p, ends_sha256`` of ``rows (p, conv_id)``: the digest of each node's ids, ascending and joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["p", "first", "ids"])

        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (p != now or len(ids) >= part):
                    yield out()
                    ids = []
                now = p
                ids.append(c)
        if ids:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            done = []
            for p, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if p == now:
                    h.update(b"," + text.encode())
                    continue
                if h is not None:
                    done.append((now, h.hexdigest()))
                now, h = p, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["p", "ends_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.hexdigest()])], names=["p", "ends_sha256"])

    parts = rows.select("p", "conv_id").repartitionByRange("p", "conv_id").sortWithinPartitions("p", "conv_id").mapInArrow(join, "p binary, first long, ids string")
    return parts.repartition("p").sortWithinPartitions("p", "first").mapInArrow(digest, "p binary, ends_sha256 string")


def trie(
    turns: DataFrame, block: int = 4, shared: Column | None = None, origin: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Every node of the prefix trie, the root included.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    ``shared`` and ``origin`` rebuild conversations first, as :func:`prefixes` says.
    """
    sums = written(_sums(_digests(turns, conv_col, turn_col, role_col, text_col)), "trie-sums")
    convs = written(_conversations(sums), "trie-conversations")
    rows = written(prefixes(sums, convs, shared, origin), "trie-prefixes")
    segments = written(_segments(rows, block), "trie-segments")
    n_segments = segments.count()
    nodes = written(_nodes(segments, n_segments), "trie-nodes")
    n_nodes = nodes.count()

    children = nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children.withColumnRenamed("parent", "p"), "p", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    marked = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("save", (F.col("n_convs") - 1) * F.col("words"))
    marked = written(marked, "trie-marked")

    below = _below(marked, block, n_nodes)
    full = marked.join(below, "p", "left").select(
        F.explode(F.concat("above", F.array("p"))).alias("p"), (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("leaf"), (F.col("save") + F.coalesce("saved", F.lit(0))).alias("save")
    )
    subtree = full.groupBy("p").agg(F.sum("leaf").alias("n_leaves"), F.sum("save").alias("saved_tokens"))

    n_convs, smallest = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    ways, n_leaves, saved = marked.agg(F.count_if(F.col("depth") == 1), F.sum("leaf"), F.sum("save")).first()
    root = [(bytearray(ROOT), None, smallest, 0, n_convs, ways, max(n_leaves or 0, 1), saved or 0)] if n_convs else []
    schema = "p binary, parent binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    tree = marked.join(subtree, "p").select("p", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
    tree = written(tree.unionByName(turns.sparkSession.createDataFrame(root, schema)), "trie-tree")
    names = tree.filter("n_children > 0").select(F.col("p").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("asks"))
    named = looked_up(tree.filter("parent is not null"), names, ["parent"], "asks", n_nodes)
    named = named.unionByName(tree.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(named.columns))

    turnless = convs.select("conv_id").join(rows.filter("ends").select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("p"), "conv_id")
    ends = _ends(rows.filter("ends").select("p", "conv_id").unionByName(turnless))
    out = named.join(ends, "p", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def shared_turns(conv: Column) -> tuple[Column, Column]:
    """The rebuilding of the registered query: ``crc32(conv_id) % 4`` turns of conversation ``conv_id - conv_id % 20``."""
    return F.crc32(conv.cast("string").cast("binary")) % 4, conv - conv % 20
