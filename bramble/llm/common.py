"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The ASCII white space that separates words and is stripped from lines: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"
#: The same set as a Java regular expression class body.
SPACE_RE = r"\x20\x09-\x0D"

_written: list = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's checkpoint folder (shared on a cluster)."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint folder and read it back.

    Cuts the lineage and survives lost executors; the files go when the driver
    exits (a lazy result may still read them before that).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_written() -> None:
    for spark, path in _written:
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session has gone; its folder is not ours to force
            return


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def binary(column: pa.Array) -> list:
    """The UTF-8 bytes of a string column, None for null, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def split_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__id``, ``__text`` and every other column packed into ``__row``, so no name can clash."""
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(
        col(id_col).alias("__id"), col(text_col).alias("__text"), F.struct(*[col(c) for c in rest]).alias("__row")
    )


def join_row(df: DataFrame, columns: list[str], text_col: str, text: Column, replace: dict[str, Column] | None = None) -> DataFrame:
    """The columns of the table that :func:`split_row` took apart, with a new text."""
    replace = replace or {}
    out = []
    for c in columns:
        if c == text_col:
            out.append(text.alias(c))
        elif c in replace:
            out.append(replace[c].alias(c))
        else:
            out.append(F.col("__row").getField(c).alias(c))
    return df.select(*out)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


#: At most this many keys can have more than one in as many of the rows.
HEAVY = 1000


def looked_up(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``facts`` (one per key, no null key); ``weight`` is how many rows refer to a fact, ``total`` how many rows there are.

    Facts that more than one in ``HEAVY`` rows refer to, fewer than ``HEAVY`` of them, are broadcast; no key of the shuffle join is hot.
    """
    heavy = col(weight) > max(1000, total // HEAVY)
    hot = facts.filter(heavy).drop(weight)
    light = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(facts.filter(~heavy).drop(weight), keys)
    return light.unionByName(rows.join(F.broadcast(hot), keys).select(light.columns))
