"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again before the next. All but the last return the columns of
``documents``. Nulls, empty texts, ties, repeated rows, empty tables and further
columns are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontamination, near_duplicates, packing, pii, quality_rules
from tessella.llm.common import documents, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return near_duplicates.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no benchmark window."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("packing", pack),
]

#: Signatures, boosted trees and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
