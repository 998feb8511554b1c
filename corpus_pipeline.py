"""A training corpus from raw documents: score, deduplicate, decontaminate, redact, pack.

Each stage gets all that its predecessor kept and is written to the shared folder before the next
one reads it. All but the last return the columns of `documents`; what a stage decides is applied
there: rows it rejects are gone, texts it changes are changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairprep.llm import near_copies, packing, pii_boost, quality_fm, wu_manber
from pairprep.llm.batches import small_batches
from pairprep.sources.scratch import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    small_batches(spark)
    return quality_fm.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word similarity of 0.8 connects, among the pairs that the
    SimHash index and a longer one propose."""
    small_batches(spark)
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    small_batches(spark)
    return wu_manber.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    return pii_boost.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their place in the training sequences."""
    small_batches(spark)
    pieces = packing.token_pieces(docs).withColumn("ids_crc32", F.crc32("ids"))
    return packing.pack(pieces)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Trained scores, fingerprints and token ids cannot be written in SQL; tests compare the stages
# with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
