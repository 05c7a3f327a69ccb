"""DuckDB statement of the k-means sweep: its start and a fixed number of iterations, unrolled."""

from __future__ import annotations

from collections.abc import Sequence


def _far(a: str, b: str, nums: Sequence[str], cats: Sequence[str]) -> str:
    """Squared distance of two rows: numbers, and 2 for every category they differ in."""
    parts = [f"(CAST({a}.{c} AS DOUBLE) - {b}.{c}) * (CAST({a}.{c} AS DOUBLE) - {b}.{c})" for c in nums]
    return " + ".join([*parts, *(f"CASE WHEN {a}.{c} = {b}.{c} THEN 0 ELSE 2 END" for c in cats)])


def sweep_ctes(source: str, nums: Sequence[str], cats: Sequence[str], ks: Sequence[int], iterations: int, doubles: Sequence[str] = (), seed: int = 42) -> list[str]:
    """CTEs from ``pts`` (distinct rows with ``key`` and weight ``w``) to ``asg{iterations}``
    (``key, k, c, dist``: the cluster of every point and k, ties to the lower number)."""
    cols = [*nums, *cats]
    text = "concat_ws('|', " + ", ".join(f"printf('%.6f', {c})" if c in doubles else f"CAST({c} AS VARCHAR)" for c in cols) + ")"
    out = [f"pts AS MATERIALIZED (SELECT *, {text} AS txt, md5({text}) AS key FROM (SELECT {', '.join(cols)}, count(*) AS w FROM {source} GROUP BY {', '.join(cols)}))"]
    for j in range(max(ks)):
        u = f"(CAST('0x' || substr(md5('{seed}|{j}|' || p.txt), 1, 8) AS BIGINT) + 1) / CAST(4294967296 AS DOUBLE)"
        far = f"least({', '.join(_far('p', f'c{i}', nums, cats) for i in range(j))})" if j else "1"
        frm = ", ".join(["pts p", *(f"c{i}" for i in range(j))])
        out.append(f"c{j} AS MATERIALIZED (SELECT p.* FROM {frm} WHERE {far} > 0 ORDER BY -ln({u}) / ({far}), p.key LIMIT 1)")
    for i, c in enumerate(cats):
        out.append(f"lab{i} AS MATERIALIZED (SELECT {c} AS label, row_number() OVER (ORDER BY sum(w) DESC, {c}) - 1 AS i FROM pts GROUP BY {c})")
    shift = [str(len(nums))]
    for i in range(len(cats)):
        shift.append(f"{shift[-1]} + (SELECT count(*) FROM lab{i})")
    slots = [f"SELECT key, w, {i} AS slot, CAST({c} AS DOUBLE) AS x FROM pts" for i, c in enumerate(nums)]
    slots += [f"SELECT key, w, {shift[i]} + l.i, 1.0::DOUBLE FROM pts JOIN lab{i} l ON l.label = {c}" for i, c in enumerate(cats)]
    out.append("xl AS MATERIALIZED (" + " UNION ALL ".join(slots) + ")")
    out.append("sq AS MATERIALIZED (SELECT key, sum(x * x) AS q FROM xl GROUP BY key)")
    first = [f"SELECT {k} AS k, {j} AS c, slot, x AS v FROM xl JOIN c{j} USING (key)" for k in ks for j in range(k)]
    out.append("cen0 AS MATERIALIZED (" + " UNION ALL ".join(first) + ")")
    for t in range(iterations + 1):
        out.append(f"dot{t} AS (SELECT key, k, c, sum(x * v) AS d FROM xl JOIN cen{t} USING (slot) GROUP BY key, k, c)")
        out.append(f"len{t} AS (SELECT k, c, sum(v * v) AS q FROM cen{t} GROUP BY k, c)")
        out.append(
            f"asg{t} AS MATERIALIZED (SELECT key, k, c, dist FROM (SELECT key, k, c, dist, row_number() OVER (PARTITION BY key, k ORDER BY dist, c) AS r "
            f"FROM (SELECT d.key, d.k, d.c, sq.q - 2 * d.d + n.q AS dist FROM dot{t} d JOIN sq USING (key) JOIN len{t} n ON n.k = d.k AND n.c = d.c)) WHERE r = 1)"
        )
        if t < iterations:
            out.append(
                f"cen{t + 1} AS MATERIALIZED (SELECT k, c, slot, sum(x.w * x) / any_value(n.n) AS v FROM asg{t} JOIN xl x USING (key) "
                f"JOIN (SELECT k, c, sum(w) AS n FROM asg{t} JOIN pts USING (key) GROUP BY k, c) n USING (k, c) GROUP BY k, c, slot)"
            )
    return out
