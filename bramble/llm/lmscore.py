"""Language-model scoring by cross-entropy difference (operator 6).

Two interpolated bigram models over one vocabulary, every word of the corpus: a target model of
trusted texts and a background model of all texts, with the same interpolation and smoothing and with counts
on the same scale (the target's are raised to the background's total).  The score of a text is the
mean over its tokens of ``log p_target - log p_background`` given the word before: above 0 it is
closer to the target than to the corpus.

    p(w | v) = (pair(v, w) + PAIR_PRIOR * p(w)) / (history(v) + PAIR_PRIOR)
    p(w)     = (word(w) + WORD_PRIOR) / ((1 + WORD_PRIOR) * tokens)

All counts are exact, for every word and pair; words are known by 63 bits of their XXH64.  They are never
gathered anywhere: texts go in chunks, and what a chunk's texts hold is sent once to the
buckets of its words, where the counts meet and the logarithms are taken, and sums per text come
back.  A bucket gets the pairs that end in its words.  So it also counts these words as
histories (all their occurrences, less those that end a text), and the history's part of the
logarithm, which does not depend on the pair, is added there.

Hot words: the ``heavy`` words most frequent in a sample of texts are counted first, alone and in pairs
with each other, in a table of at most ``(heavy + 1) ** 2`` cells that is broadcast.  Pairs of two of
them are scored where the text is; pairs of one of them and another word go to the bucket of the other.
Which words are in the list changes where a pair is scored, not its counts.  A bucket holds
about ``bucket_tokens`` tokens, so their number, and what is sent, follows the corpus.

Nulls and ties: a null or wordless text has no tokens and a null score; a text's first word
is predicted from a start mark; labels with a null id are not trusted; repeated rows count
and score each; without any trusted text all scores are 0; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import binary, col

#: Weight of the word model under the pair model (absolute pseudo-counts), and of the uniform one under the word model.
PAIR_PRIOR, WORD_PRIOR = 16.0, 4.0
#: Frequent words counted apart; longer ones are never in the list.
HEAVY, HEAVY_BYTES = 1000, 64
#: Codes: 0 is the start mark, 1..HEAVY the frequent words, from 2**63 all others; END marks a text's last word.
OTHER, END = np.uint64(1 << 63), np.uint64((1 << 63) - 1)
CHUNK_BYTES = 8 << 20


def _frequent(rows: DataFrame, heavy: int, sample: int = 4096) -> list[bytes]:
    """The ``heavy`` most frequent words of about ``sample`` texts chosen by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for b in batches:
            for text in binary(b.column(0)):
                total.update(w for w in text.lower().split() if len(w) <= HEAVY_BYTES)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["w", "n"])

    some = rows.filter(F.col("t").isNotNull()).filter(F.pmod(F.xxhash64("t"), F.lit(max(1, rows.count() // sample))) == 0)
    words = some.select("t").mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(heavy)
    return [bytes(r.w) for r in words.collect()]


class _Table:
    """Exact counts of the frequent words: pairs among them, alone and as histories, of all texts and of trusted ones."""

    def __init__(self, words: list[bytes], cells: np.ndarray):
        self.words, side = words, len(words) + 1
        self.pair = cells[:, : side * side].reshape(2, side, side)
        self.word, self.before = cells[:, side * side : side * side + side], cells[:, side * side + side : side * side + 2 * side]
        self.tokens, self.good = (float(x) for x in cells[:, -1])
        self.scale = self.tokens / self.good if self.good else 0.0
        one = word_share(self.word[0], self.word[1], self)
        self.history = history_loss(self.before[0], self.before[1], self)
        self.loss = pair_loss(self.pair[0], self.pair[1], one[0][None, :], one[1][None, :], self)


def word_share(n, m, t: _Table):
    """``PAIR_PRIOR * p(w)`` of background and target."""
    whole = PAIR_PRIOR / ((1 + WORD_PRIOR) * max(t.tokens, 1.0))
    return (n + WORD_PRIOR) * whole, (m * t.scale + WORD_PRIOR) * whole


def pair_loss(n, m, own, target, t: _Table):
    return np.log(m * t.scale + target) - np.log(n + own)


def history_loss(n, m, t: _Table):
    return np.log(m * t.scale + PAIR_PRIOR) - np.log(n + PAIR_PRIOR)


def _heavy_counts(rows: DataFrame, words: list[bytes], part: int = 1 << 16) -> np.ndarray:
    """Counts of the frequent words' cells, two rows: all texts, trusted texts; tokens last."""
    side = len(words) + 1
    cells = side * side + 2 * side + 1
    sent = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {w: i + 1 for i, w in enumerate(sent.value)}.get
        total = np.zeros((2, cells), np.int64)
        for b in batches:
            held, kinds, size = [], [], 0
            for good, text in zip(b.column(0).to_pylist(), binary(b.column(1))):
                tokens = text.lower().split() if text else ()
                if tokens:
                    at = np.array([get(w, -1) for w in tokens], np.int64)
                    before = np.r_[0, at[:-1]]
                    both = (before >= 0) & (at > 0)
                    held.append(np.concatenate([before[both] * side + at[both], side * side + at[at > 0], side * side + side + before[before >= 0], np.full(len(at), cells - 1)]))
                    kinds.append(good)
                    size += len(held[-1])
                if size > 1 << 21:
                    _tally(total, held, kinds)
                    held, kinds, size = [], [], 0
            _tally(total, held, kinds)
        for at in range(0, cells, part):
            hit = np.flatnonzero(total[0, at : at + part])
            if len(hit):
                blobs = [hit.astype(np.int32), total[0, at + hit], total[1, at + hit]]
                yield pa.RecordBatch.from_arrays([pa.array([at // part], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], names=["part", "at", "n", "m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for p, at, n, m in zip(*(c.to_pylist() for c in b.columns)):
                total, hit = totals.setdefault(p, np.zeros((2, part), np.int64)), np.frombuffer(at, np.int32)
                total[0, hit] += np.frombuffer(n, np.int64)
                total[1, hit] += np.frombuffer(m, np.int64)
        for p, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "cells"])

    parts = rows.select("good", "t").mapInArrow(run, "part int, at binary, n binary, m binary").repartition("part").mapInArrow(add, "part int, cells binary")
    out = np.zeros((2, -(-cells // part) * part), np.int64)
    for r in parts.collect():  # at most (heavy + 1) ** 2 cells
        out[:, r.part * part : (r.part + 1) * part] = np.frombuffer(bytes(r.cells), np.int64).reshape(2, part)
    return out[:, :cells]


def _tally(total: np.ndarray, held: list, kinds: list) -> None:
    if held:
        total[0] += np.bincount(np.concatenate(held), minlength=total.shape[1])
    good = [h for h, k in zip(held, kinds) if k]
    if good:
        total[1] += np.bincount(np.concatenate(good), minlength=total.shape[1])


def _codes(texts: list, get, memo: dict):
    """Codes of all tokens of a chunk, the code before each, and the text each is in."""
    digest, out, sizes = xxhash.xxh64_intdigest, [], []
    for text in texts:
        tokens = text.lower().split() if text else ()
        for w in tokens:
            v = memo.get(w)
            if v is None:
                v = memo[w] = get(w) or digest(w, 7) | (1 << 63)
            out.append(v)
        sizes.append(len(tokens))
        if len(memo) > 500_000:
            memo.clear()
    code = np.array(out, np.uint64)
    before = np.concatenate([[np.uint64(0)], code[:-1]]) if len(code) else code
    sizes = np.array(sizes, np.int64)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[first] = 0
    return code, before, np.repeat(np.arange(len(texts)), sizes), sizes


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys starts, in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _chunks(rows: DataFrame, table, buckets: int, schema: str) -> DataFrame:
    """What each chunk of texts sends: its entries to the buckets, and its own texts with what is known of them (kind 1)."""
    id_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, memo, number = table.value, {}, 0
        get = {w: i + 1 for i, w in enumerate(t.words)}.get
        base = TaskContext.get().partitionId() << 32
        for b in batches:
            texts, good = binary(b.column(2)), b.column(1).to_numpy(zero_copy_only=False)
            size = np.cumsum([len(x) if x else 0 for x in texts]) // CHUNK_BYTES
            edge = _runs(size)
            for lo, hi in zip(edge, [*edge[1:], len(texts)]):
                chunk, number = base + number, number + 1
                code, before, doc, sizes = _codes(texts[lo:hi], get, memo)
                known, after = code < OTHER, before < OTHER
                own = np.zeros(hi - lo)
                both = known & after
                np.add.at(own, doc[both], t.loss[before[both].astype(np.int64), code[both].astype(np.int64)])
                np.add.at(own, doc[after], -t.history[before[after].astype(np.int64)])
                last = np.cumsum(sizes)[sizes > 0] - 1
                last = last[code[last] >= OTHER]
                w, v, d = np.concatenate([code[~both], code[last]]), np.concatenate([before[~both], np.full(len(last), END)]), np.concatenate([doc[~both], doc[last]])
                d = d * 2 + good[lo:hi][d]
                bucket = (np.where(w >= OTHER, w, v) % np.uint64(buckets)).astype(np.int32)
                order = np.lexsort((d, v, w, bucket))
                bucket, w, v, d = bucket[order], w[order], v[order], d[order]
                start = _runs(bucket, w, v, d)
                count = np.diff(np.r_[start, len(w)]).astype(np.int32)
                bucket, w, v, d = bucket[start], w[start], v[start], d[start].astype(np.int32)
                cut = _runs(bucket)
                for i, j in zip(cut, [*cut[1:], len(bucket)]):
                    blobs = [pa.array([x[i:j].tobytes()], pa.binary()) for x in (w, v, d, count)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket[i]], pa.int32()), pa.array([chunk], pa.int64()), pa.array([0], pa.int32()), *blobs, pa.array([None], pa.list_(id_type))], names=names
                    )
                ids = pa.ListArray.from_arrays(pa.array([0, int(hi - lo)], pa.int32()), b.column(0).slice(int(lo), int(hi - lo)))
                blobs = [pa.array([x], pa.binary()) for x in (sizes.tobytes(), own.tobytes(), b"", b"")]
                yield pa.RecordBatch.from_arrays([pa.array([chunk % buckets], pa.int32()), pa.array([chunk], pa.int64()), pa.array([1], pa.int32()), *blobs, ids], names=names)

    names = ["bucket", "chunk", "kind", "w", "v", "d", "c", "ids"]
    return rows.select("id", "good", "t").mapInArrow(run, schema)


def _met(parts: list, t: _Table):
    """``chunk, text, sum`` of one bucket's ``parts (chunk, w, v, d, c)``."""
    parts.sort(key=lambda p: p[0])
    w, v, d, c = (np.concatenate([np.frombuffer(p[i], k) for p in parts]) for i, k in ((1, np.uint64), (2, np.uint64), (3, np.int32), (4, np.int32)))
    at = np.repeat(np.arange(len(parts)), [len(p[3]) // 4 for p in parts])
    order = np.lexsort((v, w))
    w, v, d, c, at = w[order], v[order], d[order], c[order], at[order]
    n, m, ends = c.astype(np.float64), c * (d & 1).astype(np.float64), v == END
    sums = lambda x, start: np.add.reduceat(x, start)

    by_word = _runs(w)
    size = np.diff(np.r_[by_word, len(w)])
    word, sign = w[by_word], np.where(ends, -1.0, 1.0)
    word_n, word_m = sums(np.where(ends, 0, n), by_word), sums(np.where(ends, 0, m), by_word)
    history = history_loss(sums(n * sign, by_word), sums(m * sign, by_word), t)
    frequent = word < OTHER  # their other pairs are elsewhere: counts from the table, histories where the text is
    place = word[frequent].astype(np.int64)
    word_n[frequent], word_m[frequent], history[frequent] = t.word[0, place], t.word[1, place], 0.0
    own, target = word_share(word_n, word_m, t)

    by_pair = _runs(w, v)
    times = np.diff(np.r_[by_pair, len(w)])
    at_word = np.repeat(np.arange(len(by_word)), size)
    loss = pair_loss(sums(n, by_pair), sums(m, by_pair), own[at_word[by_pair]], target[at_word[by_pair]], t)
    value = n * (np.where(ends, 0.0, np.repeat(loss, times)) - sign * np.repeat(history, size))

    key = (at.astype(np.int64) << 31) | (d >> 1)
    order = np.argsort(key, kind="stable")
    start = _runs(key[order])
    return np.array([p[0] for p in parts], np.int64)[key[order][start] >> 31], (key[order][start] & ((1 << 31) - 1)).astype(np.int32), np.add.reduceat(value[order], start)


def score(docs: DataFrame, trusted_ids: DataFrame, heavy: int = HEAVY, bucket_tokens: int = 500_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score`` of every row."""
    spark = docs.sparkSession
    ids = trusted_ids.select(col(trusted_ids.columns[0]).alias("__good")).filter("__good is not null").distinct()
    size = ids.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col("__good").cast("string")))).first()
    if size[0] <= 2_000_000 and (size[1] or 0) <= 32 << 20:
        ids = F.broadcast(ids)
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("t"))
    rows = rows.join(ids, F.col("id") == F.col("__good"), "left").select("id", F.col("__good").isNotNull().alias("good"), "t")
    words = _frequent(rows, heavy)
    counts = _Table(words, _heavy_counts(rows, words))
    table = spark.sparkContext.broadcast(counts)
    buckets = max(16, int(counts.tokens // bucket_tokens))
    kind = rows.schema["id"].dataType
    sent = _chunks(rows, table, buckets, f"bucket int, chunk long, kind int, w binary, v binary, d binary, c binary, ids array<{kind.simpleString()}>")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, now, held = table.value, None, []

        def done():
            if held:
                chunk, doc, total = _met(held, t)
                cut = _runs(chunk)
                ends = [*cut[1:], len(chunk)]
                blobs = [pa.array([x[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()) for x in (doc, total)]
                yield pa.RecordBatch.from_arrays([pa.array(chunk[cut]), pa.array([0] * len(cut), pa.int32()), pa.array([now] * len(cut), pa.int32()), *blobs, pa.nulls(len(cut), id_list)], names=names)

        for b in batches:
            for i, (bucket, chunk, texts) in enumerate(zip(*(b.column(k).to_pylist() for k in (0, 1, 2)))):
                if bucket != now:
                    yield from done()
                    now, held = bucket, []
                if texts:
                    yield pa.RecordBatch.from_arrays([*(pa.array([x], k) for x, k in ((chunk, pa.int64()), (1, pa.int32()), (-1, pa.int32()))), b.column(3).slice(i, 1), b.column(4).slice(i, 1), b.column(7).slice(i, 1)], names=names)
                else:
                    held.append((chunk, *(b.column(k)[i].as_py() for k in (3, 4, 5, 6))))
        yield from done()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, total, own = None, None, None, None

        def done():
            if now is not None:
                mean = np.divide(total, n, out=np.zeros(len(n)), where=n > 0) if table.value.good else np.zeros(len(n))
                yield pa.RecordBatch.from_arrays([own, pa.array(n), pa.array(mean, mask=n == 0)], names=["doc_id", "n_tokens", "score"])

        for b in batches:
            for i, (chunk, texts, x, y) in enumerate(zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4)))):
                if texts:
                    yield from done()
                    now, n, total, own = chunk, np.frombuffer(x, np.int64), np.frombuffer(y, np.float64).copy(), b.column(5).slice(i, 1).flatten()
                else:
                    total[np.frombuffer(x, np.int32)] += np.frombuffer(y, np.float64)
        yield from done()

    names = ["chunk", "texts", "bucket", "x", "y", "ids"]
    id_list = pa.list_(to_arrow_type(kind))
    met = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, f"chunk long, texts int, bucket int, x binary, y binary, ids array<{kind.simpleString()}>")
    home = met.repartition("chunk").sortWithinPartitions("chunk", F.desc("texts"), "bucket")
    return home.mapInArrow(finish, T.StructType().add("doc_id", kind).add("n_tokens", T.LongType()).add("score", T.DoubleType()))
