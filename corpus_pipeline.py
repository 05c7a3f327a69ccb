"""The training-corpus pipeline: five stages over ``documents``, each one operator of ``bramble.llm``.

Every stage reads what the one before wrote.  All but the last return the columns
of ``documents``: a filter drops rows, line dedup and decontamination rewrite
``text`` (and set ``n_chars`` to its new length where it changed).  The last returns
the mix: the documents' ids and sizes with the words the schedule takes of each.
Nulls, ties, repeated rows and empty tables: as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bramble.llm import decontam, lines, mixing, quality_rules, simhash
from bramble.llm.common import written
from bramble.sources.tables import read_table


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio go."""
    return quality_rules.passing(docs, quality_rules.trusted_ids(read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more in at least 5 documents stay in the largest doc_id only."""
    return _measured(lines.rewrite(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: 3-word shingles, at most 3 differing bits."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut from the texts."""
    return _measured(decontam.remove(docs, read_table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: the mix of what is left."""
    return mixing.mix(docs)[0]


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing_stage),
]

#: The likelihood ratio and SimHash need hashes that DuckDB lacks; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
