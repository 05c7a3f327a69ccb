"""Joining a small per-group statistic table back onto a large table.

The small side is materialised once (a reliable checkpoint in the session's
checkpoint folder when one is set, otherwise a persisted copy), its rows and bytes are
measured, and only then is it broadcast.  Beyond either bound the join falls back to
a plain shuffle join, where AQE splits skewed keys (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_ROWS = 500_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage where the cluster allows it.

    With a checkpoint folder configured (``spark.checkpoint.dir``) the result is
    written there, so it survives the loss of any executor.  Otherwise it is
    persisted (lost blocks are recomputed from lineage).
    """
    if df.sparkSession.sparkContext.getCheckpointDir():
        # Writing a reliable checkpoint runs a second job over the plan; with the
        # frame cached first, that job reads the cache instead of recomputing.
        cached = df.persist()
        out = cached.checkpoint(eager=True)
        cached.unpersist(blocking=False)
        return out
    out = df.persist()
    out.count()
    return out


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a frame: text and binary columns by their content, others 16 bytes a value."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = F.lit(16 * len(df.columns))
    for c in wide:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
    row = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return row[0], row[1] or 0


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``small`` (one row per key, of flat columns) onto ``big``; broadcast only below a checked size."""
    small = materialize(small)
    n, size = measured(small)
    if n <= max_broadcast_rows and size <= max_broadcast_bytes:
        small = F.broadcast(small)
    return big.join(small, on=on, how=how)
