"""Benchmark decontamination with FM-indexes (operator 4).

Every task indexes its own shard of the training texts: a word-level FM-index (suffix
array by prefix doubling, Burrows-Wheeler transform in a wavelet matrix, sampled
suffix positions).  All benchmark windows are searched backward at once, located
through the samples, and the occurrences merge into removal spans.

What is indexed: with the windows of one length L, a word that no such window has
can't lie in an occurrence, nor can a run of fewer than L words that they have.  The
index holds the runs that are left for any L, divided by separators; it finds
every occurrence that an index of all words would.

The benchmark is searched in blocks of about ``block_bytes`` of item text, one after the other: each is a bounded
broadcast, and what it finds is written before the next one starts, so a task holds the windows of one
block only.  Long items are cut into pieces of ``PIECE`` words that overlap by a window less one word, which
have the same windows.

Nulls and ties: a null or wordless text has no words and no hits; a null or wordless
item has no windows; an item with a null id contaminates but isn't named; repeated
items or rows count once and per row; an empty benchmark leaves every text clean;
other columns are carried unread.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary, col, join_row, split_row, written

WINDOW = 10
#: Bytes of a word: digits, letters and everything beyond ASCII.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SAMPLE = 16
#: Words of one piece of a long item.
PIECE = 50_000


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Wavelet:
    """Wavelet matrix over small integers: ranks of a symbol before a position, and access."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.n = bits, len(seq)
        self.rank1, self.zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.rank1.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        low, high = np.zeros_like(at), at
        for k in range(self.bits):
            ones, bit = self.rank1[k], (symbol >> (self.bits - 1 - k)) & 1
            a, b = ones[low], ones[high]
            low, high = np.where(bit, self.zeros[k] + a, low - a), np.where(bit, self.zeros[k] + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there."""
        low, high, symbol = np.zeros_like(at), at, np.zeros_like(at)
        for k in range(self.bits):
            ones = self.rank1[k]
            bit = ones[high + 1] - ones[high]
            symbol = symbol * 2 + bit
            a, b = ones[low], ones[high]
            low, high = np.where(bit == 1, self.zeros[k] + a, low - a), np.where(bit == 1, self.zeros[k] + b, high - b)
        return symbol, high - low


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; zeros sort by position, so no suffix is compared beyond one."""
    n = len(seq)
    rank = seq.astype(np.int64) + np.count_nonzero(seq == 0)
    rank[seq == 0] = np.arange(np.count_nonzero(seq == 0))
    order, step = np.argsort(rank, kind="stable"), 1
    while True:
        # Ranks become dense; a pair's second half is the rank ``step`` further on.
        sorted_rank = rank[order]
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(np.r_[0, (sorted_rank[1:] != sorted_rank[:-1]).astype(np.int64)])
        if dense[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - step] = dense[step:] + 1 if step < n else 0
        rank = dense * (n + 1) + after
        # Only tied positions need sorting again; the rest keep their places.
        size = np.bincount(dense)
        tied = size[dense[order]] > 1
        part = order[tied]
        order[tied] = part[np.argsort(rank[part], kind="stable")]
        step *= 2


class FmIndex:
    """Backward search and location over one sequence of word numbers (0 separates runs)."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.sa = suffix_array(seq)
        bwt = seq[self.sa - 1]  # the first wraps to the last, which is a separator
        self.wavelet = Wavelet(bwt.astype(np.int64), max(1, int(symbols).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols + 1))])
        # Samples: every SAMPLE-th position and every start of a run, so no walk crosses a separator.
        mark = (self.sa % SAMPLE == 0) | (bwt == 0)
        self.marked = mark
        self.sample = np.where(mark, self.sa, -1)[mark]
        self.sample_at = np.cumsum(mark) - 1
        self.sa = None

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of patterns of one length (rows), all at once."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.wavelet.n, np.int64)
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k]
            low[live] = self.before[c] + self.wavelet.rank(c, low[live])
            high[live] = self.before[c] + self.wavelet.rank(c, high[live])
            live = live[low[live] < high[live]]
        low[low >= high] = high[low >= high]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix ranks, walking back to the nearest sample."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            here = at[todo]
            done = self.marked[here]
            got = todo[done]
            out[got] = self.sample[self.sample_at[at[got]]] + steps[got]
            todo = todo[~done]
            if len(todo):
                symbol, rank = self.wavelet.access(at[todo])
                at[todo] = self.before[symbol] + rank
                steps[todo] += 1
        return out


@dataclass
class Phrases:
    """The windows of one block of items: distinct per length, with the items that have each."""

    vocabulary: dict  # word -> number from 1
    lengths: dict  # L -> (windows as rows of word numbers, list of item numbers per window)
    items: list  # the item ids


def phrases(items: list[tuple[object, bytes | None]], window: int) -> Phrases:
    vocabulary: dict = {}
    found: dict = defaultdict(lambda: defaultdict(set))
    names = []
    for number, (item, text) in enumerate(items):
        names.append(item)
        w = tuple(vocabulary.setdefault(x, len(vocabulary) + 1) for x in words_of(text))
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            found[k][w[i : i + k]].add(number)
    lengths = {k: (np.array(list(x), np.int64).reshape(-1, k), [sorted(v) for v in x.values()]) for k, x in found.items()}
    return Phrases(vocabulary, lengths, names)


def _runs(known: np.ndarray, length: int) -> np.ndarray:
    """Where a run of at least ``length`` true values stands."""
    edge = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= length
    cover = np.zeros(len(known) + 1, np.int64)
    np.add.at(cover, begin[long], 1)
    np.add.at(cover, end[long], -1)
    return np.cumsum(cover[:-1]) > 0


class Shard:
    """Collects texts until the index is worth building, then answers for all of them."""

    def __init__(self, block: Phrases):
        self.block = block
        self.of_length = {}
        for k, (rows, _) in block.lengths.items():
            has = np.zeros(len(block.vocabulary) + 1, bool)
            has[np.unique(rows)] = True
            self.of_length[k] = has
        self.clear()

    def clear(self):
        self.parts, self.doc, self.word, self.size, self.n = [np.zeros(1, np.int64)], [np.array([-1])], [np.array([-1])], 1, 0

    def add(self, words: list[bytes]) -> None:
        """Queue the runs of one text that could hold an occurrence."""
        ids = np.fromiter(map(self.block.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        keep = np.zeros(len(ids), bool)
        if ids.any():
            for k, has in self.of_length.items():
                keep |= _runs(has[ids], k)
        if keep.any():
            at = np.flatnonzero(keep)
            gap = np.flatnonzero(np.diff(at) > 1) + 1
            part = np.insert(ids[at], gap, 0)
            word = np.insert(at, gap, -1)
            self.parts += [part, np.zeros(1, np.int64)]
            self.word += [word, np.array([-1])]
            self.doc += [np.full(len(part), self.n), np.array([-1])]
            self.size += len(part) + 1
        self.n += 1

    def answers(self) -> list[tuple[np.ndarray, np.ndarray, list[int]]]:
        """Per queued text: starts and ends of merged spans of words, and the item numbers found."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), [])] * self.n
        if self.size > 1:
            seq, doc, word = np.concatenate(self.parts), np.concatenate(self.doc), np.concatenate(self.word)
            index = FmIndex(seq, len(self.block.vocabulary))
            docs, begins, ends, names = [], [], [], defaultdict(set)
            for k, (rows, items) in self.block.lengths.items():
                low, high = index.search(rows)
                count = high - low
                which = np.repeat(np.arange(len(rows)), count)
                ranks = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                at = index.locate(ranks)
                docs.append(doc[at])
                begins.append(word[at])
                ends.append(word[at] + k)
                pairs = np.unique(doc[at] * len(rows) + which)
                for d, w in zip((pairs // len(rows)).tolist(), (pairs % len(rows)).tolist()):
                    names[d].update(items[w])
            docs, begins, ends = np.concatenate(docs), np.concatenate(begins), np.concatenate(ends)
            order = np.lexsort((begins, docs))
            docs, begins, ends = docs[order], begins[order], ends[order]
            edge = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
            for i, j in zip(edge, [*edge[1:], len(docs)]):
                b, e = begins[i:j], np.maximum.accumulate(ends[i:j])
                new = np.r_[True, b[1:] > e[:-1]]
                out[docs[i]] = (b[new], e[np.r_[new[1:], True]], sorted(names[int(docs[i])]))
        self.clear()
        return out


def _pass(block, window: int, shard_words: int):
    """One block of the benchmark against a stream of texts; adds its spans and items to each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(phrases(block.value, window))

        def done(rows):
            table = pa.Table.from_batches(rows)
            got = shard.answers()
            begin, end, items = [], [], []
            for (b, e, names), b0, e0, n0 in zip(got, table["begins"].to_pylist(), table["ends"].to_pylist(), table["items"].to_pylist()):
                begin.append([*b0, *b.tolist()])
                end.append([*e0, *e.tolist()])
                items.append([*n0, *(str(x) for x in dict.fromkeys(shard.block.items[n] for n in names) if x is not None)])
            longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
            table = table.set_column(3, "begins", pa.array(begin, longs)).set_column(4, "ends", pa.array(end, longs)).set_column(5, "items", pa.array(items, strings))
            yield from table.to_batches()

        held = []
        for b in batches:
            n = []
            for text in binary(b.column(1)):
                words = words_of(text)
                shard.add(words)
                n.append(len(words))
            held.append(b.set_column(2, "n_words", pa.array(n, pa.int64())))
            if shard.size > shard_words or sum(x.nbytes for x in held) > 64 << 20:
                yield from done(held)
                held = []
        if held:
            yield from done(held)

    return run


def _chained(first, second):
    """Two functions of batches as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return second(first(batches))

    return run


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """``i, t`` with long items in overlapping pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, texts = [], []
            for n, text in enumerate(binary(b.column(1))):
                words = words_of(text)
                step = range(0, max(1, len(words) - window + 1), PIECE) if len(words) > PIECE else (None,)
                texts += [text if i is None else b" ".join(words[i : i + PIECE + window - 1]) for i in step]
                at += [n] * len(step)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(texts, pa.binary())], names=["i", "t"])

    return items.mapInArrow(run, T.StructType([items.schema["i"]]).add("t", T.BinaryType()))


def find(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = 1_000_000, block_bytes: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", finish=None,
) -> DataFrame:
    """``__id, __text, __row, n_words, begins, ends, items`` of every row.

    ``begins`` and ``ends`` are spans of word numbers; with more than one block of
    items they may overlap.  ``items`` are the item ids found, as strings.

    ``finish`` gets the schema of these rows and returns a function of their batches with the schema of its own; it
    runs behind the last block in the same Python worker, so a task has one worker, not one for each step.
    """
    spark = docs.sparkSession
    asked = _pieces(benchmark.select(col(item_col).alias("i"), col(item_text).alias("t")).filter("t is not null"), window)
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes))
    if blocks > 1:
        asked = asked.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    rows = split_row(docs, id_col, text_col).select(
        "__id", "__text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<bigint>").alias("begins"),
        F.array().cast("array<bigint>").alias("ends"), F.array().cast("array<string>").alias("items"), "__row",
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
    for b in range(blocks):
        part = asked.filter(F.col("b") == b) if blocks > 1 else asked
        sent = spark.sparkContext.broadcast([(r["i"], bytes(r["t"])) for r in part.toLocalIterator()])
        step, out = _pass(sent, window, shard_words), schema
        if finish and b == blocks - 1:
            last, out = finish(schema)
            step = _chained(step, last)
        rows = rows.mapInArrow(step, out)
        if blocks > 1:
            rows = written(rows, "decontam-found")
            sent.unpersist()
    return rows


def merged(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(zip(begins, ends)):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted, distinct) of every row."""
    kind = found.schema["__id"].dataType
    schema = T.StructType().add("doc_id", kind).add("n_words", "long").add("n_hit", "long").add("items", T.ArrayType(T.StringType()))

    def run(batches):
        for b in batches:
            hit = [sum(e - s for s, e in merged(x, y)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            items = [sorted(set(x), key=str.encode) for x in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "items"]
            )

    return found.select("__id", "n_words", "begins", "ends", "items").mapInArrow(run, schema)


def remove(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The table with its columns unchanged and every text without its contaminated spans.

    A span goes from the first byte of its first word to the last byte of its last
    word; clean texts are untouched, null stays null.
    """

    def run(batches):
        for b in batches:
            texts = binary(b.column("__text"))
            for i, (begin, end) in enumerate(zip(b.column("begins").to_pylist(), b.column("ends").to_pylist())):
                if begin:
                    at = [m.span() for m in WORD.finditer(texts[i])]
                    left, last = [], 0
                    for s, e in merged(begin, end):
                        left.append(texts[i][last : at[s][0]])
                        last = at[e - 1][1]
                    texts[i] = b"".join([*left, texts[i][last:]])
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(pa.string()), b.column("__row")], names=["__text", "__row"])

    def finish(found):
        return run, T.StructType().add("__text", "string").add(found["__row"])

    out = find(docs, benchmark, id_col=id_col, text_col=text_col, finish=finish, **options)
    return join_row(out, docs.columns, text_col, F.col("__text"))
