"""Operators 11 to 13 against brute force: nearest neighbours, ranked lexical search, conversation trie."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bramble.llm import ann, common, lexical, queries, trie  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# ---- operator 11 -------------------------------------------------------------------------------------------


def nearest(rows, k):
    """``{query: [(id, score)]}`` by brute force over (id, vector) rows that take part."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            best = {}
            for i, y in good:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float((x * y).sum()))
            mine = out.setdefault(q, {})
            for i, s in best.items():
                mine[i] = max(mine.get(i, -math.inf), s)
    return {q: sorted(b.items(), key=lambda e: (-e[1], e[0]))[:k] for q, b in out.items()}


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id bigint, embedding array<float>, x string, nid string")


def test_neighbours_recall_and_scores(spark):
    """Recall on the given vectors, every score exact, lists full and in order."""
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = found(queries.op11_nearest_neighbours(spark, SMALL))
    want = nearest([(r.vec_id, r.embedding) for r in df.collect()], 20)
    assert set(got) == set(want)
    hits = 0
    vec = {r.vec_id: np.array(r.embedding) for r in df.collect()}
    for q, near in got.items():
        assert len(near) == 20 and near == sorted(near, key=lambda e: (-e[1], e[0]))
        hits += len({i for i, _ in near} & {i for i, _ in want[q]})
        assert all(abs(s - vec[q] @ vec[i]) < 1e-12 for i, s in near)
    assert hits / (20 * len(want)) >= 0.9


def test_neighbours_of_more_than_one_block(spark):
    """Several blocks, lists far shorter than the table, vectors of very different norms."""
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((5000, 12)) * rng.uniform(0.2, 3, (5000, 1))).astype(np.float32)
    df = vectors(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)])
    got = found(ann.neighbours(df, df.filter("vec_id % 20 = 0"), k=5, links=16, pool=64))
    scores = x[::20].astype(float) @ x.T.astype(float)
    scores[np.arange(250), np.arange(0, 5000, 20)] = -np.inf
    want = np.argsort(-scores, 1)[:, :5]
    assert set(got) == set(range(0, 5000, 20))
    assert sum(len({i for i, _ in got[20 * n]} & set(w.tolist())) for n, w in enumerate(want)) / want.size >= 0.9


def test_neighbours_defined_cases(spark):
    """Nulls, zero and non-finite vectors, short vectors, copies, ties, repeated rows and ids, fewer rows than k."""
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.5, 0.5]), (5, [0.5, -0.5]), (6, None), (7, []), (40, [0.0, 0.0])]
    rows += [(60, [float("nan"), 1.0]), (61, [float("inf"), 1.0]), (62, [None, 1.0]), (None, [1.0, 1.0]), (8, [2.0]), (9, [-1.0, 0.0]), (9, [0.25, 0.0])]
    df = vectors(spark, rows)
    got = found(ann.neighbours(df, df.filter("vec_id % 20 = 0"), k=20))
    assert got == nearest(rows, 20)
    assert found(ann.neighbours(df, df.filter("vec_id % 20 = 0"), k=3)) == nearest(rows, 3)
    copies = [(i, [0.6, 0.8]) for i in range(300)] + [(1000 + i, [0.8, 0.6 + i / 1000]) for i in range(50)]
    df = vectors(spark, copies)
    assert {q: [i for i, _ in v] for q, v in found(ann.neighbours(df, df.filter("vec_id % 20 = 0"), k=20)).items()} == {q: [i for i, _ in v] for q, v in nearest(copies, 20).items()}
    assert ann.neighbours(df.limit(0), df.limit(0)).count() == 0
    assert found(ann.neighbours(df.limit(0), df.filter("vec_id = 20"))) == {}
    assert found(ann.neighbours(df.filter("vec_id = 20"), df.filter("vec_id = 20"))) == {}


# ---- operator 12 -------------------------------------------------------------------------------------------


def lexical_brute(docs, items, k):
    word = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    split = lambda t: word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    held = [(d, Counter(split(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m, s = 25 + (75 * sum(c.values()) * n) // total, 0
            for t in split(text):
                if t in c:
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0))
        out += [(item, i + 1, None if gone else d, -s) for i, (s, gone, d) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, item_id string, rank int"), spark.createDataFrame(
        [(*i, 0) for i in items], "item_id bigint, text string, doc_id int"
    )


def ranked(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_lexical_search_given_tables(spark):
    rows = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]
    assert ranked(queries.op12_lexical_search(spark, SMALL)) == lexical_brute(rows("documents", "doc_id"), rows("benchmark", "item_id"), 10)


def test_lexical_search_cases(spark):
    """Small leaves and shards, several item blocks, ties, nulls, empty and long texts, repeated rows and ids."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)] + ["Größe", "ÀB", "naïve", "X2"]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 12))))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "!? --"), (None, "w1 w2 w3"), (203, "w1 w2 w3"), (203, "w1 w2 w3"), (203, "w9"), (204, "W1-w2_w3"), (205, "w1 " * 50_000)]
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 9))))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "absent words only"), (103, "w1 w1 w1 w2"), (103, "w4"), (103, "w4"), (None, "w5 größe ÀB"), (104, "w1 " * 3000)]
    d, i = frames(spark, docs, items)
    want = lexical_brute(docs, items, 10)
    assert ranked(lexical.search(d, i, leaf=2, shard_docs=16)) == want
    assert ranked(lexical.search(d.repartition(7), i, block_bytes=300)) == want
    assert lexical.search(d.limit(0), i).count() == 0 and lexical.search(d, i.limit(0)).count() == 0


def test_ball_tree_prunes_and_bounds_hold():
    """Bounds cover every member, and a search with a high floor reads fewer leaves than there are."""
    rng = np.random.default_rng(8)
    rows = []
    for group in range(20):
        for _ in range(100):
            at = np.unique(rng.choice(np.arange(group * 10, group * 10 + 10), 6))
            rows.append((at.astype(np.int32), rng.integers(1, 10**10, len(at))))
    ptr = np.r_[0, np.cumsum([len(a) for a, _ in rows])]
    tree = lexical.BallTree(ptr, np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows]), 200)
    dense = np.zeros(200, np.int64)
    term, count = np.array([3, 5, 8]), np.array([2, 1, 1])
    dense[term] = count
    true = np.array([int((v * dense[a]).sum()) for a, v in rows])
    for node, (lo, hi, *_) in enumerate(tree.nodes):
        assert tree.bound(node, term, count) >= true[tree.order[lo:hi]].max()
    best = []

    def offer(docs, scores):
        best.extend(zip((-scores).tolist(), docs.tolist()))
        best.sort()
        del best[10:]
        return -best[-1][0] if len(best) == 10 else 1

    leaves = sum(n[2] < 0 for n in tree.nodes)
    assert tree.search(term, count, dense, 1, offer) < leaves / 4
    assert [-s for s, _ in best] == sorted(true.tolist(), reverse=True)[:10]


# ---- operator 13 -------------------------------------------------------------------------------------------


def trie_brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        full[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(m) - 1) * len(re.findall("[^\x20\x09-\x0d]+", s[-1][1])) if s else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return Counter((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], sha(ends[s])) for s, m in members.items())


def grown(df):
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def turns(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, p binary, depth int")


def test_trie_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert grown(queries.op13_conversation_trie(spark, SMALL)) == trie_brute(rows)


@pytest.mark.parametrize("block", [1, 4])
def test_trie_cases(spark, block, monkeypatch):
    """Nulls, ties, repeated rows, growing prefixes, hot openings, bases absent or short, turnless conversations, a long one."""
    monkeypatch.setattr(common, "HEAVY", 4)
    rows = [(1, None, None, None), (1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, 0, "assistant", ""), (1, 3, "user", "z"), (None, 0, "user", "gone")]
    rows += [(100 + k, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for k in range(30) for t in range(k)]
    rows += [(200 + k, t, "user", "hot opening" if t < 3 else f"own {k % 5} {t}") for k in range(40) for t in range(6)]
    rows += [(300 + k, 0, "user", "only one") for k in range(45)]
    rows += [(400, t, "user", f"long {t} " + "w " * (t % 3)) for t in range(150)] + [(401, t, "user", f"long {t} " + "w " * (t % 3)) for t in range(160)]
    rows += [(500, 0, "user", "x" * 300_000), (501, 0, "user", "x" * 300_000), (501, 1, "user", "tail")]
    df = turns(spark, rows)
    shared, origin = trie.shared_turns(F.col("conv_id"))
    assert grown(trie.trie(df.repartition(5), block, shared, origin)) == trie_brute(rows)
    if block == 4:
        assert grown(trie.trie(df, block)) == trie_brute(rows, rebuild=False)
        assert grown(trie.trie(turns(spark, [(21, 0, "user", "u")]), block, shared, origin)) == trie_brute([(21, 0, "user", "u")])
        assert trie.trie(df.limit(0), block).count() == 0


def test_conversation_cut_by_partitions(spark):
    """A conversation that range partitions cut many times has the same prefixes."""
    rows = [(7, t, "user", f"t{t}") for t in range(500)] + [(8, t, "user", f"t{t}") for t in range(480)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = turns(spark, rows).repartition(9)
        assert trie._sums(trie._digests(df, "conv_id", "turn", "role", "text")).select("pid").distinct().count() > 10
        assert grown(trie.trie(df)) == trie_brute(rows, rebuild=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
