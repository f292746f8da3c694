"""Documents to packed training sequences: quality, line dedup, near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonweave.llm.common import durable, table
from lessonweave.llm.decontamination import decontaminate
from lessonweave.llm.jaccard import keep_first
from lessonweave.llm.line_dedup import dedup_lines
from lessonweave.llm.packing import pack, with_digest
from lessonweave.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; ``n_chars`` follows the text. A document that loses all it had goes too."""
    found = dedup_lines(docs)
    left = found.where((F.col("__n_dropped") == 0) | F.col("text").rlike(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]"))
    n_chars = F.when(F.col("__n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col("__n_hit") == 0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return with_digest(pack(docs))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL: the classifier, SimHash and the tokenizer have no form in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs)
    return docs
