"""DuckDB statements of the fitted models: least squares of least norm, and a small forest."""

from __future__ import annotations

import math
from collections.abc import Sequence


def _label_ctes(prefix: str, source: str, cats: Sequence[str], weight: str) -> list[str]:
    return [
        f"{prefix}lab{i} AS MATERIALIZED (SELECT {c} AS label, row_number() OVER (ORDER BY sum({weight}) DESC, {c}) - 1 AS i FROM {source} GROUP BY {c})"
        for i, c in enumerate(cats)
    ]


def _offsets(prefix: str, first: int, cats: Sequence[str]) -> list[str]:
    out = [str(first)]
    for i in range(len(cats)):
        out.append(f"{out[-1]} + (SELECT count(*) FROM {prefix}lab{i})")
    return out


def _swept(name: str, start: str, n: str, last: str, tolerance: str) -> str:
    """A recursive CTE of in-place Gauss-Jordan steps ``k = 1..last`` on the matrix ``m`` of ``start``; a step whose pivot is spent is left out."""
    cell = (
        "CASE WHEN i = k AND j = k THEN 1 / a[k][k] WHEN i = k THEN a[k][j] / a[k][k] WHEN j = k THEN -a[i][k] / a[k][k] "
        "ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END"
    )
    live = f"a[k][k] > {tolerance} * m[k][k]"
    return (
        f"{name} AS (SELECT 1 AS k, m AS a, CAST([] AS BIGINT[]) AS used FROM {start} UNION ALL "
        f"SELECT k + 1, CASE WHEN {live} THEN list_transform(range(1, {n} + 1), lambda i: list_transform(range(1, {n} + 1), lambda j: {cell})) ELSE a END, "
        f"CASE WHEN {live} THEN list_append(used, CAST(k AS BIGINT)) ELSE used END FROM {name}, {start} WHERE k <= {last})"
    )


def least_squares_ctes(source: str, nums: Sequence[str], cats: Sequence[str], label: str) -> list[str]:
    """CTEs up to ``rgram(i, j, s)`` (1 = intercept, then features, then the label), ``rbeta(slot, name, b)`` and ``ricpt(b)``."""
    cols = [*nums, *cats]
    out = [f"rp AS MATERIALIZED (SELECT *, row_number() OVER () AS key FROM (SELECT {', '.join(cols)}, {label} AS y, count(*) AS w FROM {source} GROUP BY {', '.join(cols)}, {label}))"]
    out += _label_ctes("r", "rp", cats, "w")
    shift = _offsets("r", 2 + len(nums), cats)
    parts = ["SELECT key, w, 1 AS slot, 1.0::DOUBLE AS x FROM rp"]
    parts += [f"SELECT key, w, {i + 2}, CAST({c} AS DOUBLE) FROM rp" for i, c in enumerate(nums)]
    parts += [f"SELECT key, w, {shift[i]} + l.i, 1.0::DOUBLE FROM rp JOIN rlab{i} l ON l.label = {c}" for i, c in enumerate(cats)]
    parts += [f"SELECT key, w, {shift[-1]}, CAST(y AS DOUBLE) FROM rp"]
    out.append("rx AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")")
    out.append("rn AS MATERIALIZED (SELECT CAST(max(slot) AS BIGINT) AS n FROM rx)")
    out.append("rgram AS MATERIALIZED (SELECT a.slot AS i, b.slot AS j, sum(a.w * a.x * b.x) AS s FROM rx a JOIN rx b USING (key) GROUP BY a.slot, b.slot)")
    out.append("rside AS MATERIALIZED (SELECT unnest(range(1, n + 1)) AS i FROM rn)")
    out.append(
        "rm AS MATERIALIZED (SELECT list(r ORDER BY i) AS m, any_value(n) AS n FROM (SELECT x.i, list(coalesce(g.s, 0.0) ORDER BY y.i) AS r "
        "FROM rside x CROSS JOIN rside y LEFT JOIN rgram g ON g.i = x.i AND g.j = y.i GROUP BY x.i), rn)"
    )
    out.append(_swept("rsw", "rm", "n", "n - 1", "1e-7"))
    out.append("rfin AS MATERIALIZED (SELECT a, used, n FROM rsw, rn WHERE k = n)")
    out.append("rbasic AS MATERIALIZED (SELECT i AS slot, CASE WHEN list_contains(used, i) THEN a[i][n] ELSE 0 END AS b FROM rfin, rside WHERE i > 1 AND i < n)")
    out.append(
        "rfree AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY d.i) AS r, j.i AS slot, CASE WHEN j.i = d.i THEN 1.0 WHEN list_contains(used, j.i) THEN -a[j.i][d.i] ELSE 0 END AS x "
        "FROM rfin, rside d, rside j WHERE d.i > 1 AND d.i < n AND j.i > 1 AND j.i < n AND NOT list_contains(used, d.i))"
    )
    out.append(
        "rs AS MATERIALIZED (SELECT list(r ORDER BY i) AS m, count(*) AS n FROM (SELECT i, list_append(list(s ORDER BY j), any_value(c)) AS r FROM "
        "(SELECT a.r AS i, b.r AS j, sum(a.x * b.x) AS s FROM rfree a JOIN rfree b USING (slot) GROUP BY a.r, b.r) "
        "JOIN (SELECT r AS i, sum(x * b) AS c FROM rfree JOIN rbasic USING (slot) GROUP BY r) USING (i) GROUP BY i))"
    )
    # rows of the small system have one more column than there are rows: the right-hand side
    cell = "CASE WHEN i = k THEN a[k][j] / a[k][k] ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END"
    out.append(
        "rsw2 AS (SELECT CAST(1 AS BIGINT) AS k, m AS a, n FROM rs UNION ALL SELECT k + 1, "
        f"list_transform(range(1, n + 1), lambda i: list_transform(range(1, n + 2), lambda j: {cell})), n FROM rsw2 WHERE k <= n)"
    )
    out.append("rlam AS (SELECT r, a[r][n + 1] AS v FROM (SELECT a, n, unnest(range(1, n + 1)) AS r FROM rsw2 WHERE k = n + 1))")
    names = [f"SELECT {i + 2} AS slot, '{c}' AS name" for i, c in enumerate(nums)]
    names += [f"SELECT {shift[i]} + i, '{c}_vec_' || label FROM rlab{i}" for i, c in enumerate(cats)]
    out.append("rname AS (" + " UNION ALL ".join(names) + ")")
    out.append(
        "rbeta AS MATERIALIZED (SELECT slot, name, b - coalesce(f.v, 0) AS b FROM rbasic JOIN rname USING (slot) "
        "LEFT JOIN (SELECT slot, sum(x * v) AS v FROM rfree JOIN rlam USING (r) GROUP BY slot) f USING (slot))"
    )
    out.append(
        "ricpt AS MATERIALIZED (SELECT (SELECT s FROM rgram, rn WHERE i = 1 AND j = n) / (SELECT s FROM rgram WHERE i = 1 AND j = 1) "
        "- (SELECT sum(b * s) FROM rbeta JOIN rgram ON i = 1 AND j = slot) / (SELECT s FROM rgram WHERE i = 1 AND j = 1) AS b)"
    )
    return out


def least_squares_prediction(row: str, nums: Sequence[str], cats: Sequence[str]) -> str:
    """The prediction for a row of alias ``row``."""
    parts = ["(SELECT b FROM ricpt)"] + [f"CAST({row}.{c} AS DOUBLE) * (SELECT b FROM rbeta WHERE name = '{c}')" for c in nums]
    return " + ".join([*parts, *(f"coalesce((SELECT b FROM rbeta WHERE name = '{c}_vec_' || {row}.{c}), 0)" for c in cats)])


def forest_ctes(source: str, test: str, nums: Sequence[str], cats: Sequence[str], label: str, trees: int, depth: int, doubles: Sequence[str] = (), seed: int = 42, bins: int = 32) -> list[str]:
    """CTEs up to ``fbest{level}(t, node, slot, v, gain, n)`` per level, ``fname(slot, name)`` and ``fpred`` (the rows of ``test`` with ``p0, p1, prediction``)."""
    cols = [*nums, *cats]
    text = "concat_ws('|', " + ", ".join(f"printf('%.6f', {c})" if c in doubles else f"CAST({c} AS VARCHAR)" for c in [*cols, "y"]) + ")"
    out = [
        f"fp AS MATERIALIZED (SELECT *, {text} AS txt, row_number() OVER () AS key FROM (SELECT {', '.join(cols)}, {label} AS y, count(*) AS n FROM {source} GROUP BY {', '.join(cols)}, {label}))",
        *_label_ctes("f", "fp", cats, "n"),
        f"ft AS MATERIALIZED (SELECT *, row_number() OVER () AS key FROM {test})",
    ]
    shift = _offsets("f", len(nums), cats)

    def dense(rows: str) -> str:
        parts = [f"SELECT key, {i} AS slot, CAST({c} AS DOUBLE) AS x FROM {rows}" for i, c in enumerate(nums)]
        parts += [f"SELECT key, {shift[i]} + l.i, CASE WHEN {c} = l.label THEN 1.0 ELSE 0.0 END FROM {rows}, flab{i} l" for i, c in enumerate(cats)]
        return " UNION ALL ".join(parts)

    out += [f"fd AS MATERIALIZED ({dense('fp')})", f"ftd AS MATERIALIZED ({dense('ft')})"]
    names = [f"SELECT {i} AS slot, '{c}' AS name" for i, c in enumerate(nums)] + [f"SELECT {shift[i]} + i, '{c}_vec_' || label FROM flab{i}" for i, c in enumerate(cats)]
    out.append("fname AS MATERIALIZED (" + " UNION ALL ".join(names) + ")")
    probs = ", ".join(repr(i / bins) for i in range(1, bins))
    cuts = []
    for i, c in enumerate(nums):
        many = f"(SELECT count(DISTINCT {c}) FROM fp) > {bins}"
        cuts.append(f"SELECT {i} AS slot, (v + nx) / 2 AS v FROM (SELECT v, lead(v) OVER (ORDER BY v) AS nx FROM (SELECT DISTINCT CAST({c} AS DOUBLE) AS v FROM fp)) WHERE nx IS NOT NULL AND NOT ({many})")
        cuts.append(f"SELECT DISTINCT {i}, q FROM (SELECT unnest(quantile_cont(CAST({c} AS DOUBLE), [{probs}])) AS q FROM {source}) WHERE q < (SELECT max({c}) FROM fp) AND {many}")
    cuts.append(f"SELECT slot, 0.5::DOUBLE FROM fname WHERE slot >= {len(nums)}")
    out.append("fthr AS MATERIALIZED (" + " UNION ALL ".join(cuts) + ")")
    poisson, acc = [], 0.0
    for i in range(12):
        acc += math.exp(-1) / math.factorial(i)
        poisson.append(f"CASE WHEN u > CAST({acc!r} AS DOUBLE) THEN 1 ELSE 0 END")
    out.append(
        f"fw AS MATERIALIZED (SELECT key, t, y, n * ({' + '.join(poisson)}) AS w FROM (SELECT *, (CAST('0x' || substr(md5('{seed}|' || t || '|' || txt), 1, 8) AS BIGINT) + 1) "
        f"/ CAST(4294967296 AS DOUBLE) AS u FROM fp, (SELECT unnest(range({trees})) AS t)))"
    )
    out += ["fa0 AS (SELECT key, t, 1 AS node FROM fw)", f"fta0 AS (SELECT key, t, 1 AS node FROM ft, (SELECT unnest(range({trees})) AS t))"]
    most = "(SELECT count(*) FROM fname)" if trees == 1 else "ceil(sqrt((SELECT count(*) FROM fname)))"
    gini = lambda n, one: f"(1 - (({n} - {one}) / {n} * (({n} - {one}) / {n}) + {one} / {n} * ({one} / {n})))"
    for d in range(depth):
        out.append(
            f"flook{d} AS MATERIALIZED (SELECT t, node, slot FROM (SELECT t, node, slot, row_number() OVER (PARTITION BY t, node ORDER BY md5('{seed}|' || t || '|' || node || '|' || slot)) AS r "
            f"FROM (SELECT DISTINCT t, node FROM fa{d}), fname) WHERE r <= {most})"
        )
        out.append(
            f"fcand{d} AS MATERIALIZED (SELECT a.t, a.node, x.slot, h.v, CAST(sum(w) AS DOUBLE) AS n, CAST(sum(w * y) AS DOUBLE) AS n1, "
            f"CAST(sum(CASE WHEN x.x <= h.v THEN w ELSE 0 END) AS DOUBLE) AS l, CAST(sum(CASE WHEN x.x <= h.v THEN w * y ELSE 0 END) AS DOUBLE) AS l1 "
            f"FROM fa{d} a JOIN fw USING (key, t) JOIN flook{d} k ON k.t = a.t AND k.node = a.node JOIN fd x ON x.key = a.key AND x.slot = k.slot JOIN fthr h ON h.slot = x.slot "
            "WHERE w > 0 GROUP BY a.t, a.node, x.slot, h.v)"
        )
        out.append(
            f"fbest{d} AS MATERIALIZED (SELECT t, node, slot, v, gain, n FROM (SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, slot, v) AS r FROM "
            f"(SELECT *, round({gini('n', 'n1')} - l / n * {gini('l', 'l1')} - (n - l) / n * {gini('(n - l)', '(n1 - l1)')}, 12) AS gain FROM fcand{d} WHERE l > 0 AND l < n) WHERE gain > 1e-12) WHERE r = 1)"
        )
        for mine, rows in (("fa", "fd"), ("fta", "ftd")):
            out.append(
                f"{mine}{d + 1} AS MATERIALIZED (SELECT a.key, a.t, CASE WHEN b.node IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN x.x > b.v THEN 1 ELSE 0 END END AS node "
                f"FROM {mine}{d} a LEFT JOIN fbest{d} b ON b.t = a.t AND b.node = a.node LEFT JOIN {rows} x ON x.key = a.key AND x.slot = b.slot)"
            )
    out.append(f"fleaf AS MATERIALIZED (SELECT t, node, CAST(sum(w * y) AS DOUBLE) / sum(w) AS p1 FROM fa{depth} JOIN fw USING (key, t) WHERE w > 0 GROUP BY t, node)")
    out.append(
        "fpred AS MATERIALIZED (SELECT ft.*, 1 - p1 AS p0, p1, CASE WHEN p1 > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM ft JOIN "
        f"(SELECT a.key, avg(p1) AS p1 FROM fta{depth} a JOIN fleaf USING (t, node) GROUP BY a.key) USING (key))"
    )
    return out
