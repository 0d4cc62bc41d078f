"""A training-corpus pipeline: stages over the documents table, each written and read again.

Toxic documents go, one document of each near-duplicate component stays, documents that hold a
benchmark passage go, secrets are replaced by a marker, and the texts become token ids. Every stage
works on all rows that the one before kept, and all but the last return the columns of ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from heliotab.llm import decontaminate, pieces, secret_scan, simhash, toxicity
from heliotab.llm.registry import prepare, table
from heliotab.session import scratch_dir


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the query's folds."""
    prepare(spark)
    return toxicity.remove_toxic(docs, toxicity.train_on_folds(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in a text give way to a marker; the documents stay."""
    prepare(spark)
    return secret_scan.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and the digest of the text that they decode to."""
    prepare(spark)
    return pieces.tokenized(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", clean_of_benchmark),
    ("secret_scan", without_secrets),
    ("sentencepiece", tokenize),
]

# Trained models and fingerprints have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage's result is written as Parquet and reread."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
