"""Deterministic random columns.

A draw is a pure function of ``(seed, tag, row id)``:

    u = int(first 8 hex digits of md5("{seed}:{tag}:{id}"), 16) / 2**32   in [0, 1)

so every value depends on the row's id and the seed only, never on how the
rows are partitioned or ordered, and DuckDB can state the same numbers.  One
tag per random decision (age, product, division, ..., one per null injection).
One digest holds four such draws, so four decisions can share an md5 (:func:`draw`).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(id_col: Column | str, tag: str, seed: int) -> Column:
    """The md5 of seed, tag and row id as hex text: four draws' worth of bits (see :func:`draw`)."""
    return F.md5(F.concat(F.lit(f"{seed}:{tag}:"), F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")))


def draw(digest_col: Column, slot: int = 0) -> Column:
    """The uniform double in [0, 1) of one of a digest's four 32-bit slots."""
    return F.conv(F.substring(digest_col, 8 * slot + 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform(id_col: Column | str, tag: str, seed: int) -> Column:
    """A uniform double in [0, 1) for this row, tag and seed."""
    return draw(digest(id_col, tag, seed))


def rand_int(u: Column, lo: int | Column, hi: int | Column) -> Column:
    """G1: uniform integer in ``[lo, hi]`` (both ends included)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (lo_c + F.floor(u * (hi_c - lo_c + F.lit(1)))).cast("int")


def rand_choice(u: Column, values: Sequence) -> Column:
    """Uniform pick from ``values``."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * F.lit(len(values))) + F.lit(1)).cast("int"))


def cumulative(weights: Sequence[float]) -> list[float]:
    total = float(sum(weights))
    return [c / total for c in accumulate(float(w) for w in weights)]


def weighted_choice(u: Column, values: Sequence, weights: Sequence[float]) -> Column:
    """Pick ``values[i]`` with probability ``weights[i] / sum(weights)``."""
    cum = cumulative(weights)
    expr = F.lit(values[-1])
    for v, c in reversed(list(zip(values[:-1], cum[:-1]))):
        expr = F.when(u < F.lit(c), F.lit(v)).otherwise(expr)
    return expr


def conditional_bernoulli(u: Column, branches: Sequence[tuple[Column, float]], default_p: float) -> Column:
    """1 with probability ``p`` of the first branch whose condition holds (else ``default_p``).

    As with a two-way weighted pick ``[0, 1]`` with weights ``[1 - p, p]``:
    the draw returns 0 when ``u < 1 - p``.
    """

    def draw(p: float) -> Column:
        return F.when(u < F.lit(cumulative([1.0 - p, p])[0]), F.lit(0)).otherwise(F.lit(1))

    expr = draw(default_p)
    for cond, p in reversed(list(branches)):
        expr = F.when(cond, draw(p)).otherwise(expr)
    return expr.cast("int")


def dependent_choice(parent: Column, u: Column, table: dict, default: Sequence) -> Column:
    """Pick uniformly from ``table[parent]`` (a list, or a single fixed value)."""
    expr = rand_choice(u, default) if len(default) > 1 else F.lit(default[0])
    for key, options in reversed(list(table.items())):
        pick = rand_choice(u, options) if len(options) > 1 else F.lit(options[0])
        expr = F.when(parent == F.lit(key), pick).otherwise(expr)
    return expr


def fill_template(template: Column, **values: Column) -> Column:
    """Replace ``{name}`` placeholders in a template column."""
    out = template
    for name, v in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), v)
    return out


def null_with_rate(value: Column, u: Column, rate: float) -> Column:
    """Null with probability ``rate``, else ``value``."""
    return F.when(u < F.lit(float(rate)), F.lit(None)).otherwise(value)
