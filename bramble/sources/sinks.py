"""Sinks (S3): CSV export that reads back as it was written (no driver collect).

Every value is quoted and quotes inside are doubled, so line ends, quotes, delimiters
and padding stay inside their field.  A null is the mark ``\\N``; a text that starts with a
backslash gets one more in front, so no text can be taken for the mark, and an empty text is
an empty pair of quotes.  Values that are not text are written as Spark casts them to text, with all
their digits, binary as base64.  Other readers see ordinary quoted CSV.

A quoted line end means that a file can't be split, so files hold at most
``rows_per_file`` rows, and reading is parallel over files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

NULL = "\\N"
_BOTH = {"quote": '"', "escape": '"', "lineSep": "\n", "header": True, "nullValue": NULL, "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_FLAT = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def own_path(spark: SparkSession, name: str) -> str:
    """A path that no other write has, in the session's checkpoint folder (shared on a cluster)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _written(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    text = c.cast("string")
    if not isinstance(kind, T.StringType):
        return text
    return F.when(text.startswith("\\"), F.concat(F.lit("\\"), text)).otherwise(text)


def _read(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unbase64(c)
    if not isinstance(kind, T.StringType):
        return c.cast(kind)
    return F.when(c.startswith("\\"), F.substr(c, F.lit(2))).otherwise(c)


def write_csv(df: DataFrame, path: str | None = None, mode: str = "error", single_file: bool = False, rows_per_file: int = 1_000_000) -> str:
    """S3: CSV with a header row, written in parallel by the executors; returns the path.

    Without ``path`` the files go to a folder of their own (:func:`own_path`), so
    no two writes meet.  ``single_file=True`` coalesces to one output file for small results; do
    not use it for large tables (it funnels the write through one task).
    """
    nested = [f.name for f in df.schema.fields if not isinstance(f.dataType, _FLAT)]
    if nested:
        raise ValueError(f"CSV holds flat columns only: {nested}")
    path = path or own_path(df.sparkSession, "csv")
    out = df.select(*[_written(_column(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
    writer = (out.coalesce(1) if single_file else out).write.mode(mode).options(**_BOTH).option("quoteAll", True)
    if not single_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a CSV written by :func:`write_csv`; without a schema every column is text.

    A row that doesn't fit the schema raises.
    """
    reader = spark.read.options(**_BOTH).option("multiLine", True).option("mode", "FAILFAST")
    if schema is None:
        rows = reader.csv(path)
        fields = rows.schema.fields
    else:
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        rows = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in fields])).csv(path)
    return rows.select(*[_read(_column(f.name), f.dataType).alias(f.name) for f in fields])
