"""A corpus pipeline of five stages: each takes (spark, docs, sf_dir) and works on all that its predecessor kept.

toxicity drops documents with a toxicity score of 0.5 or more, similar keeps the document
with the least id of each group of near copies, benchmark drops documents that hold
a benchmark item, secrets replaces secrets in the texts, and pieces segments the texts.
All stages but the last return the columns of ``documents``, others are dropped, whatever their
names; rows without an id pass the filters that need one; null texts stay null and pass; rows that
repeat an id share its fate, so copies under one id stay together; of tied documents the least id
stays; whole texts of any length are read; an empty table passes every stage as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.contain import contained_items
from lakeloom.llm.jaccard import jaccard_classes
from lakeloom.llm.pieces import sample_segmentations
from lakeloom.llm.secrets import redact, scan_secrets
from lakeloom.llm.toxicity import toxicity_scores
from lakeloom.plans.storage import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5."""
    scored = toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=tuple(COLUMNS[1:]))
    return scored.where(F.col("score") < 0.5).select(*COLUMNS)


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group linked by Jaccard 0.8 or more of five-word shingles."""
    later = jaccard_classes(docs).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of every benchmark item."""
    found = contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced; n_chars follows the text."""
    found = scan_secrets(docs, keep=tuple(COLUMNS[1:]))
    return found.withColumn("text", redact(F.col("text"), F.col("spans"))).withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every text."""
    return sample_segmentations(docs, k=2)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", similar), ("benchmark_decontamination", benchmark), ("secret_scans", secrets), ("sentencepiece", pieces)]
#: SQL cannot express a trained classifier or a sampler.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
