"""Training-corpus pipeline: five stages, each on the whole output of the one before.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame.  ``run`` writes each stage's rows to the shared folder as Parquet and
reads them again as the next one's documents.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.durable import written
from marquee.llm import bpe, decontaminate, ngram_join, repetition, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return repetition.quality_rules(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id; of rows with one id, one.
    Five words a shingle, similarity 0.8."""
    like = ngram_join.Likeness(5, 80, 100)
    found = ngram_join.ngram_components(docs, like=like)
    firsts = found.filter("doc_id = component_id").select("doc_id").distinct()
    unnamed = docs.filter("doc_id is null")
    return docs.join(firsts, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns).unionByName(unnamed)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontaminate.contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def secrets_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark."""
    findings, _ = secrets.scan_history(docs)
    clean = secrets.redact(F.col("text"), F.col("spans"))
    length = F.when(F.size("spans") > 0, F.length(clean).cast("bigint")).otherwise(F.col("n_chars"))
    return findings.withColumn("n_chars", length).withColumn("text", clean).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and the digests of ids and decoded text."""
    return bpe.bpe_encode(docs, digests=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scans", secrets_removed),
    ("bpe", encoded),
]

# Alignment scores and BPE have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
