"""Registered queries of this subpackage, and the DuckDB statements of those that SQL can state.

Each ``opN_<name>`` applies one operator to its whole table with the parameters of
production and derives the contract's columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import ann, chat, decontam, html_extract, lexical, licenses, lines, lmscore, mixing, quality_clf, quality_rules, simhash, trie


#: A conversation whose texts hold the template's own control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.conversations(turns.unionByName(probe)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.groups(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    out = decontam.report(found)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = mixing.mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document: target the texts labelled good, background all."""
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    return lmscore.score(read_table(spark, sf_dir, "documents"), trusted)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice found: the fullest window of each template in each document."""
    found = licenses.scan(read_table(spark, sf_dir, "documents"), licenses.template_table(spark))
    return found.select("doc_id", "template", "n_windows", "start", "containment")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    out = quality_rules.judged(read_table(spark, sf_dir, "documents"), trusted)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_clf.scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20, among all others."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest-scoring documents of every benchmark item."""
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    shared, origin = trie.shared_turns(F.col("conv_id"))
    return trie.trie(read_table(spark, sf_dir, "conversations"), block=4, shared=shared, origin=origin)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_source_mixing": op5_source_mixing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_license_scan": op7_license_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_trie": op13_conversation_trie,
    "pipeline": pipeline,
}

ORACLE = {
    "op1_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text)),
f AS (
  SELECT *, length(regexp_replace(regexp_replace(text, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g'))
            + length(name) + 9 + length(regexp_replace(name, '[^\n\\]', '', 'g')) AS chars
  FROM (SELECT *, regexp_replace(regexp_replace(role, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g') AS name FROM t))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""",
    "op2_line_dedup": r"""
WITH l AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
k AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (k.key IS NOT NULL AND l.doc_id <> k.last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (k.key IS NULL OR l.doc_id = k.last), '')) AS kept_sha256
FROM l LEFT JOIN k USING (key) GROUP BY l.doc_id""",
    "op4_benchmark_decontamination": r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM hits GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS mix FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM d GROUP BY source),
c AS (SELECT *, [3.0, 1.0, 2.0][CAST((place - 1) % 3 + 1 AS INT)]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM s),
f AS (
  SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS want, coalesce(sum(cap) OVER u, 0.0) AS "full", sum(w) OVER () - coalesce(sum(w) OVER u, 0.0) AS rest
  FROM c WINDOW u AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, max(CASE WHEN (want - "full") / rest * w <= cap THEN (want - "full") / rest END) OVER () AS level FROM f),
t AS (SELECT source, source_size, place, least(cap, coalesce(level * w, cap)) AS target FROM v),
o AS (
  SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS quota,
         coalesce(sum(size) OVER (PARTITION BY place ORDER BY (mix >> 40) % 1024, mix, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(least(a + size, quota) - a, 0) + greatest(least(source_size + a + size, quota) - source_size - a, 0) AS BIGINT) AS taken
FROM o""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
c AS (SELECT count(*) AS big_n, CAST(sum(len(ws)) AS BIGINT) AS big_l FROM d WHERE len(ws) > 0),
q AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest(ws) AS term FROM b) GROUP BY item_id, term),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, c GROUP BY term),
m AS (SELECT doc_id, 25 + (75 * len(ws) * big_n) // big_l AS m FROM d, c WHERE len(ws) > 0),
s AS (
  SELECT item_id, doc_id, CAST(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op13_conversation_trie": r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
ids AS (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations), crc),
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations),
r AS (
  SELECT c, 0 AS part, i, role, text FROM ids JOIN o ON o.conv_id = base AND i <= h
  UNION ALL SELECT c, 1, i, role, text FROM ids JOIN o ON o.conv_id = c AND i > h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS depth, role, text FROM r),
p AS (
  SELECT c, depth, string_agg(md5(CAST(length(role) AS VARCHAR) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY depth) AS path,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, depth = max(depth) OVER (PARTITION BY c) AS ends FROM s
  UNION ALL SELECT c, 0, '', 0, c NOT IN (SELECT c FROM s) FROM ids),
n AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY path, depth),
k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
u AS (
  SELECT left(path, 32 * a) AS path, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, u.saved_tokens, m.ends_sha256
FROM m JOIN u USING (path) LEFT JOIN m AS q ON m.depth > 0 AND q.path = left(m.path, 32 * (m.depth - 1))""",
}
