"""The operators of ``bramble.llm`` against brute force, with the cases that every one must take:
nulls in any column, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import os
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bramble.llm import chat, decontam, html_extract, licenses, lines, lmscore, mixing, quality_clf, quality_rules, queries, simhash  # noqa: E402

LINE = "A passage of well over forty characters that many documents share."
LONG = " ".join(f"word{i % 997}" for i in range(20_000))
CLASH = ["fp", "key", "n_lines", "kept", "size", "place", "label", "__x", "words", "row", "h", "a.b"]


def docs(spark, rows):
    """Documents with the columns of the table and many that clash with names used inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(*r, *["x"] * len(CLASH)) for r in rows], schema)


def cases(spark):
    rows = [(i, f"Text number {i} has some words.\n{LINE}\n" + f"tail {i} " * 12, "en", "a" if i % 3 else None, 10) for i in range(12)]
    rows += [(20, None, None, None, None), (21, "", "en", "b", 0), (22, " \n\t\n", "en", "b", 3), (23, LONG, "en", "c", 1), (None, f"no id\n  {LINE.upper()}  ", None, "a", None)]
    rows += [rows[3], rows[3], (30, "Twin text " * 30, "en", "a", 1), (31, "Twin text " * 30, "en", "a", 1)]
    return docs(spark, rows), rows


def empty(spark):
    return docs(spark, [])


# -- chat ---------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"<>/[]\\sé", "INST", "s>"]), max_size=20).map("".join))
def test_chat_escape_round_trip(text):
    out = chat.escape(pa.array([text], pa.large_string()))[0].as_py()
    assert chat.unescape(out.encode()).decode() == text
    assert not re.search(r"</?s>|\[/?INST\]", out)


def test_chat_digests_against_brute_force(spark):
    rows = [(1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 0, "user", "<s>\\<s>"), (2, 0, None, None), (2, 0, "assistant", "é"), (None, None, "ro\\le\nx", "t"), (3, 5, "system", ""), (5, 0, "</s>", "</s>\n<s>"), (5, 1, "<\\/s>\n[INST]", "[\\INST]")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i} " * 50) for i in range(400)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for size in (1 << 20, 500):
        got = {r["conv_id"]: r for r in chat.digests(chat.conversations(turns, block_bytes=size)).collect()}
        for conv in (1, 2, 3, 4, 5, None):
            own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
            said = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
            loss = "".join(x for _, _, r, x in own if r == "assistant")
            r = got[conv]
            assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(said.encode()).hexdigest())
            assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert len(got) == 6
    assert chat.digests(chat.conversations(turns.limit(0))).count() == 0


# -- line dedup ---------------------------------------------------------------


def brute_lines(rows, min_docs=5, min_chars=40):
    key = lambda x: re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", x).translate({c: c + 32 for c in range(65, 91)})
    held = {}
    for i, text, *_ in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    last = {k: max((x for x in v if x is not None), default=None) for k, v in held.items() if len(v) >= min_docs}
    return sorted((repr(i), "\n".join(x for x in (t or "").split("\n") if key(x) not in last or last[key(x)] == i)) for i, t, *_ in rows)


def test_line_dedup_against_brute_force(spark):
    df, rows = cases(spark)
    got = sorted((repr(r["doc_id"]), r["kept"]) for r in lines.dedup(df).collect())
    assert got == brute_lines(rows)
    out = lines.rewrite(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert lines.dedup(empty(spark)).count() == 0


def test_line_state_is_reversible(spark):
    df, rows = cases(spark)
    first, second = docs(spark, rows[:4]), docs(spark, rows[4:12])
    state = lines.insert(lines.start(first), second)
    whole = lines.start(docs(spark, rows[:12]))
    table = lambda s: sorted(map(tuple, s.counts.select("key", "n_docs", "last_doc").collect()))
    assert table(state) == table(whole)
    assert lines.dropped_keys(state).count() == lines.dropped_keys(whole).count() == 11
    back = lines.delete(state, second)
    assert table(back) == table(lines.start(first)) and lines.dropped_keys(back).count() == 0
    for r in back.filters.collect():
        assert not np.frombuffer(r["cells"], np.uint16).any()


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.randoms())
def test_cuckoo_filter(keys, rnd):
    f = lines.CuckooFilter.build(np.array(sorted(keys), np.uint64))
    assert f.contains(np.array(sorted(keys), np.uint64)).all()
    gone = set(rnd.sample(sorted(keys), len(keys) // 2))
    assert all(f.delete(k) for k in gone)
    assert f.contains(np.array(sorted(keys - gone), np.uint64)).all()
    assert int((f.cells > 0).sum()) == len(keys) - len(gone)


# -- simhash ------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(points, radius=3):
    label = {p: p for p in points}
    changed = True
    while changed:
        changed = False
        for a in points:
            for b in points:
                if (a ^ b).bit_count() <= radius and label[a] != label[b]:
                    low = min(label[a], label[b])
                    label[a] = label[b] = low
                    changed = True
    return label


def test_simhash_against_brute_force(spark):
    df, rows = cases(spark)
    got = simhash.groups(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["fp"] & (2**64 - 1) == brute_fingerprint({repr(x[0]): x[1] for x in rows}[repr(r["doc_id"])])
    assert simhash.groups(empty(spark)).count() == 0
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len({r["component_id"] for r in got})


@pytest.mark.parametrize("max_tree", [50_000, 8])
def test_links_find_every_component(spark, max_tree):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = {int(s) ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 64, (8, 2))} | {int(s) for s in seeds} | {0, 7}
    signed = [p - 2**64 if p >> 63 else p for p in points]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id bigint, fp bigint")
    got = {r["fp"] & (2**64 - 1): r["component_id"] for r in simhash.assign(df, 3).collect()} if max_tree > 100 else None
    if got is None:
        label = {r["node"]: r["label"] for r in simhash.closure(simhash.links(df.select("fp"), 3, max_tree=max_tree)).collect()}
        got = {p & (2**64 - 1): label.get(p, p) for p in signed}
    want = brute_components(sorted(points))
    pairs = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert pairs(got) == pairs(want)


# -- decontamination ----------------------------------------------------------


def brute_hits(text, items):
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    w, hit, found = words(text), set(), set()
    for name, item in items:
        x = words(item)
        k = min(10, len(x))
        windows = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if x else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(name)
    return len(w), len(hit), sorted(str(f) for f in found if f is not None)


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(2)
    say = lambda n: " ".join(rng.choice(["the", "a", "cat", "dog", "ran", "é9"], n))
    items = [(i, say(14)) for i in range(12)] + [(50, "the cat"), (51, None), (52, ", ."), (None, say(11)), (53, "dog")]
    rows = [(i, f"{say(40)} {items[i % 12][1].upper()}! {say(30)}" if i % 2 else say(60), "en", "a", 1) for i in range(40)]
    rows += [(60, None, None, None, None), (61, "", "", "", 0), rows[1], (None, items[0][1], None, None, 1), (62, LONG, None, None, 1)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = docs(spark, rows)
    for options in ({}, {"block_bytes": 200, "shard_words": 300}):
        got = decontam.report(decontam.find(df, bench, **options)).collect()
        assert sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted((repr(r[0]), *brute_hits(r[1], items)) for r in rows)
    out = decontam.remove(df, bench)
    assert out.columns == df.columns and out.count() == len(rows)
    assert {r["text"] for r in out.filter("doc_id in (60, 61)").collect()} == {None, ""}
    assert decontam.find(empty(spark), bench).count() == 0
    assert decontam.report(decontam.find(df, bench.limit(0))).filter("n_hit > 0").count() == 0


def test_decontamination_cuts_in_the_worker_that_searches(spark):
    bench = spark.createDataFrame([(1, "one two three"), (2, "four five six"), (3, "é seven")], "item_id bigint, text string")
    rows = [(1, "a One, two THREE b four five six c", "en", "a", 9), (2, "clean", "en", "a", 5), (3, None, None, None, None), (4, "x é-seven", "en", "b", 1)]
    df = docs(spark, rows)
    out = decontam.remove(df, bench)
    # Two Python steps in one stage would need two workers for each running task.
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    for got in (out, decontam.remove(df, bench, block_bytes=16, shard_words=2)):
        assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "a  b  c", 2: "clean", 3: None, 4: "x "}
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in df.schema]


# -- mixing -------------------------------------------------------------------


def test_mixing_targets_and_repeats(spark):
    df, rows = cases(spark)
    out, pieces = mixing.mix(df)
    got = out.collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(df)[0].collect()), key=repr)
    assert len(got) == len(rows)
    size = Counter()
    for _, text, _, source, _ in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = {r["source"]: r["target"] for r in got}
    weight = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), [3, 1, 2] * 9))
    want, open_, left = {}, set(size), 1.5 * sum(size.values())
    while open_:  # reshare by weight until nothing is above its cap
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * size[s]]
        if not over:
            want |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            want[s] = 2.0 * size[s]
            left -= want[s]
            open_.discard(s)
    for s, t in target.items():
        assert t == pytest.approx(want[s])
        assert sum(r["taken"] for r in got if r["source"] == s) == int(t + 0.5)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert pieces.count() > 0
    assert mixing.mix(empty(spark))[0].count() == 0


# -- quality rules ------------------------------------------------------------


def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = Counter(zip(w, w[1:], w[2:]))
    rep = {i + k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)


def test_quality_rules_against_brute_force(spark):
    df, rows = cases(spark)
    rows = rows + [(70, "a b a b a b c#|d x y z x y z", "en", "a", 1), (71, "\n".join(["one two three"] * 30 + [f"q{i} r s" for i in range(40)]), "en", "a", 1)]
    df = docs(spark, rows)
    trusted = spark.createDataFrame([(i,) for i in range(12)] + [(None,)], "doc_id bigint")
    got = quality_rules.judged(df, trusted).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((repr(r["doc_id"]), *(r[f] for f in fields)) for r in got) == sorted((repr(r[0]), *brute_base(r[1])) for r in rows)
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD) for r in got)
    kept = quality_rules.passing(df, trusted)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality_rules.judged(df, trusted.limit(0)).filter("kept = base_failed").count() == 0
    assert quality_rules.judged(empty(spark), trusted).count() == 0


# -- license scan, LM scoring, classifier, pages ---------------------------------


def test_license_scan(spark):
    header = licenses.TEMPLATES["apache-2.0-header"]
    words = header.split()
    worn = " ".join(words[:12] + words[14:])  # two words lost in the middle
    rows = [(1, f"x y z {header} a b"), (2, worn), (3, "Released under the MIT  License!"), (4, None), (5, ""), (6, "under the License you may obtain a copy"), (7, LONG), (3, "Released under the MIT License."), (None, LONG + " " + header.upper())]
    df = docs(spark, [(i, t, None, None, None) for i, t in rows])
    got = licenses.scan(df, licenses.template_table(spark)).collect()
    found = Counter((r["doc_id"], r["template"]) for r in got)
    assert found[(1, "apache-2.0-header")] == found[(None, "apache-2.0-header")] == 1 and found[(3, "mit-short")] == 2
    assert not any(d in (4, 5, 6, 7) for d, _ in found)

    def sets(text):
        w = re.sub(r"[\W_]+", " ", text.lower()).split()
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    want, shingles = sets(header), sets(worn)
    best = max(len(set(want) & set(shingles[i : i + len(want)])) / len(set(want)) for i in range(len(shingles)))
    assert ((2, "apache-2.0-header") in found) == (best >= 0.8)
    assert {r["start"] for r in got if r["doc_id"] == 1} == {3}
    assert licenses.scan(empty(spark), licenses.template_table(spark)).count() == 0
    assert licenses.scan(df, licenses.template_table(spark).limit(0)).count() == 0


#: The five notices that the given documents hold, as a regular expression and the template that names them.
NOTICES = {
    r"Licensed under the Apache License, Version 2\.0": "apache-2.0-short",
    r"Released under the MIT License": "mit-short",
    r"licensed under the GNU General Public License, version 3": "gpl-3.0-short",
    r"Licensed under CC BY-NC 4\.0": "cc-by-nc-4.0-short",
    r"All rights reserved": "all-rights-reserved-short",
}


def test_license_scan_finds_every_notice_of_the_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {(r["doc_id"], r["template"]) for r in licenses.scan(df, licenses.template_table(spark)).collect()}
    held = {(r["doc_id"], name) for r in df.filter("text is not null").collect() for notice, name in NOTICES.items() if re.search(rf"\b{notice}\b", r["text"])}
    assert {name for _, name in held} == set(NOTICES.values()) and held <= found


def test_license_scan_of_texts_that_open_inside_a_notice(spark):
    words = licenses.TEMPLATES["apache-2.0-header"].split()
    df = docs(spark, [(n, " ".join(words[n:]) + tail, None, None, None) for n, tail in ((1, ""), (2, " and more words"), (3, " " + LONG))])
    got = licenses.scan(df, licenses.template_table(spark)).filter("template = 'apache-2.0-header'").collect()
    assert {r["doc_id"]: r["start"] for r in got} == {1: 0, 2: 0, 3: 0}


def test_license_scan_against_every_window(spark):
    """Brute force over all windows of all texts: starts, numbers of windows and containments, templates of very different lengths."""
    rng = np.random.default_rng(2)
    long = " ".join(f"term{int(i)}" for i in rng.integers(0, 900, 1200))
    templates = {"long": long, "one": "notice", "two": "All rights", "six": "this work is free to use", "twin": "this work is free to use", **{k: licenses.TEMPLATES[k] for k in ("mit-short", "isc", "zlib")}}
    worn = long.split()
    for i in rng.choice(len(worn), 15, replace=False):
        worn[int(i)] = "worn"
    texts = [long, "intro words " + long + " and " + long, " ".join(worn), "This work, is free to use! this work is free to use. Notice: all RIGHTS", None, "", licenses.TEMPLATES["isc"][40:], "x " + licenses.TEMPLATES["zlib"] + " y"]
    split = lambda t: re.sub(r"[\W_]+", " ", t.lower()).split()
    want = {}
    for d, text in enumerate(texts):
        w = split(text or "")
        for name, t in templates.items():
            t = split(t)
            k = min(5, len(t))
            shingles = lambda ws: {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}  # noqa: E731,B023
            own, hits = shingles(t), []
            for start in range(max(0, len(w) - k + 1)):
                share = len(shingles(w[start : start + len(t)]) & own) / len(own)
                if share >= 0.8:
                    hits.append((share, -start))
            if hits:
                want[d, name] = max(hits)
    got = {(r["doc_id"], r["template"]): (r["containment"], -r["start"]) for r in licenses.scan(docs(spark, [(d, t, None, None, None) for d, t in enumerate(texts)]), licenses.template_table(spark, templates)).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == (pytest.approx(want[k][0]), want[k][1]) for k in want)


def lm_brute(rows, trusted):
    """Scores by position, from counts of the words and pairs themselves."""
    n, m = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    texts = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    for (i, _), ws in zip(rows, texts):
        before = [None, *ws[:-1]]
        for counts in (n, m) if i in trusted else (n,):
            counts[0].update(ws)
            counts[1].update(zip(before, ws))
            counts[2].update(before if ws else [])
    total, good = sum(n[0].values()), sum(m[0].values())
    out = []
    for ws in texts:
        score = 0.0
        for v, w in zip([None, *ws[:-1]], ws):
            p = []
            for counts, scale in ((m, total / good if good else 0), (n, 1)):
                one = (counts[0][w] * scale + lmscore.WORD_PRIOR) / ((1 + lmscore.WORD_PRIOR) * total)
                p.append((counts[1][v, w] * scale + lmscore.PAIR_PRIOR * one) / (counts[2][v] * scale + lmscore.PAIR_PRIOR))
            score += math.log(p[0]) - math.log(p[1])
        out.append((len(ws), score / len(ws) if ws else None))
    return out


def lm_same(got, rows, trusted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    want = sorted(((i, *w) for (i, _), w in zip(rows, lm_brute(rows, trusted))), key=key)
    got = sorted(((r["doc_id"], r["n_tokens"], r["score"]) for r in got), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(g[2] == w[2] if w[2] is None else g[2] == pytest.approx(w[2], abs=1e-9) for g, w in zip(got, want))


@pytest.mark.parametrize("heavy, bucket_tokens", [(1000, 500_000), (3, 50), (0, 1000)])
def test_lm_scores_against_direct_counts(spark, heavy, bucket_tokens):
    """Exact for any list of frequent words and any number of buckets."""
    df, rows = cases(spark)
    trusted = spark.createDataFrame([(0,), (1,), (None,)], "doc_id bigint")
    lm_same(lmscore.score(df, trusted, heavy, bucket_tokens).collect(), [r[:2] for r in rows], {0, 1})
    assert {r["score"] for r in lmscore.score(df, trusted.limit(0), heavy, bucket_tokens).collect()} == {0.0, None}
    assert lmscore.score(empty(spark), trusted, heavy, bucket_tokens).count() == 0


def test_lm_scores_of_every_given_document(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "CHUNK_BYTES", 200_000)
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    trusted = {r[0] for r in quality_rules.trusted_ids(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    lm_same(queries.op6_lm_scoring(spark, sf).collect(), rows, trusted)


def test_classifier(spark, sf_small):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_clf.scores(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out")
    right = out.selectExpr("avg(cast(predicted = quality as int)) a", "min(score) lo", "max(score) hi").first()
    assert right["a"] > 0.95 and 0 <= right["lo"] <= right["hi"] <= 1
    df, rows = cases(spark)
    assert quality_clf.scores(df, labels.limit(0)).filter("score = 0.5").count() == len(rows)
    some = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id bigint, quality int")
    assert quality_clf.scores(df, some).filter("score between 0 and 1").count() == len(rows)
    assert quality_clf.scores(empty(spark), some).count() == 0


def test_pooled_is_isotonic():
    n, s = np.array([1.0, 2, 1, 4, 2]), np.array([0.0, 2, 0, 1, 2])
    out = quality_clf.pooled(n, s)
    assert (np.diff(out) >= 0).all() and out @ n == pytest.approx(s.sum())


PAGES = {
    "<body><nav><a href=x>Home</a></nav><article><h1>Big  News</h1><p>One &amp; two<br>three.<p>Four <b>five</b>!</article><footer>&copy; us</footer>": "Big News\n\nOne & two three.\n\nFour five!",
    "<body><div class='cookie-notice'>We use cookies</div><article><p>Text here is long enough.</p></article><div class=comments><p>Nice post!</p></div></body>": "Text here is long enough.",
    "<article><script>x='<p>no</p>'</script><style>p{}</style><p>Only this.</p><form><input><label>Mail</label></form></article>": "Only this.",
}


def test_html_extraction(spark):
    rows = [(i, f"u{i}", h) for i, h in enumerate(PAGES)] + [(10, None, None), (11, "u", ""), (12, "u", "<p"), (None, "u", "a < b <!-- c"), (13, "u", "<article><p>" + LONG)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert [got[i] for i in range(len(PAGES))] == list(PAGES.values())
    assert got[10] == got[11] == "" and got[13] == LONG
    assert len(got) == len(rows)
    assert html_extract.extract(pages.limit(0)).count() == 0


FORMS = {
    "<body><form id=aspnetForm action=x><div class=menu><a href=x>Home</a></div><article><h1>Big News</h1><p>One and two are here.</p><form><p>Subscribe to us</p></form></article><footer>us</footer></form></body>": "Big News\n\nOne and two are here.",
    "<body><form id=form1><div class=content><p>Text here is long enough.</p><p>And some more of it.</p></div><div class=sidebar><p>Related</p></div></form></body>": "Text here is long enough.\n\nAnd some more of it.",
    "<body><form><p>Search the site</p></form><article><p>Text here is long enough.</p><fieldset><p>Vote</p></fieldset></article></body>": "Text here is long enough.",
}


def test_html_form_around_the_page(spark):
    given = [(i, "u", h) for i, h in enumerate([*FORMS, *PAGES])]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(given, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(len(given))] == [*FORMS.values(), *PAGES.values()]


@pytest.mark.parametrize(
    "tag", ["<svg viewBox='0 0 1 1'/>", "<math/>", "<object data=x />", "<video src='a>b'/>", "<audio/>", "<canvas/>", "<svg>", "<object data=x>", "<video controls>", "<select>", "<iframe src=x>", "<noscript>", "<video-player>", "<audio-player src=x></audio-player>", "<select-menu>"],
)
def test_html_text_after_an_element_without_end(tag):
    page = f"<article><p>One {tag} two.</p><p>Three.</p></article>"
    assert [text for text, _, _ in html_extract.blocks(page)] == ["One two.", "Three."]


def test_html_raw_elements_and_math():
    said = lambda page: [text for text, _, _ in html_extract.blocks(page)]
    assert said("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.") == ["Let x=2 hold."]
    assert said("<p>a<video src=v>no</video><svg><text>no</text></svg><SCRIPT src='x'/>no</script >b<svg/>c<svg>no</svg>d") == ["abcd"]
    assert said("<p>a<script>if (x) y = '<p>no'") == ["a"]
    assert said("<p>a" + "<object>" * 50_000 + "b") == ["ab"]


def test_labeller_gradients():
    rng = np.random.default_rng(0)
    pages = [rng.normal(size=(n, 5)).astype(np.float32) for n in (3, 6, 1, 9)]
    labels = [(p[:, 0] + np.r_[0, p[:-1, 1]] > 0).astype(np.float32) for p in pages]  # needs the block before
    model = html_extract.Labeller(5, 8).fit(pages * 20, labels * 20, epochs=40, batch=20)
    assert np.mean(np.concatenate([(z > 0) != y for z, y in zip(model.logits(pages), labels)])) < 0.06


# -- pipeline -----------------------------------------------------------------


def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    columns = frame.columns
    rows = {r["doc_id"] for r in quality_rules.judged(frame, quality_rules.trusted_ids(spark.read.parquet(f"{sf}/labels.parquet"))).filter("kept").collect()}
    first = corpus_pipeline.written(corpus_pipeline.quality(spark, frame, sf), "t")
    assert {r["doc_id"] for r in first.collect()} == rows
    second = corpus_pipeline.written(corpus_pipeline.line_dedup(spark, first, sf), "t")
    assert sorted((repr(r["doc_id"]), r["text"]) for r in second.collect()) == brute_lines([(r["doc_id"], r["text"]) for r in first.collect()])
    third = corpus_pipeline.written(corpus_pipeline.near_dedup(spark, second, sf), "t")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in second.collect()}
    label = brute_components(sorted(set(prints.values())))
    assert {r["doc_id"] for r in third.collect()} == {min(d for d, p in prints.items() if label[p] == v) for v in set(label.values())}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    fourth = corpus_pipeline.written(corpus_pipeline.decontamination(spark, third, sf), "t")
    before = {r["doc_id"]: r["text"] for r in third.collect()}
    for r in fourth.collect():
        assert r["n_chars"] == len(r["text"]) and (r["text"] == before[r["doc_id"]]) == (brute_hits(before[r["doc_id"]], items)[1] == 0)
    last = corpus_pipeline.mixing_stage(spark, fourth, sf)
    assert last.count() == fourth.count()
    for df in (first, second, third, fourth):
        assert df.columns == columns
    nothing = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf).count() == 0
