"""Training-data pipeline over documents: quality, near copies, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. `run` writes
each stage's result as Parquet and reads it as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontaminate, packing, quality, secrets, simhash
from lakemart.llm.common import importable, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; all columns."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    options = quality.Settings()
    model = quality.train(docs, labels, options=options)
    return quality.keep_good(docs, model, threshold=options.threshold)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; all columns."""
    return simhash.one_per_group(docs, shingle=3, radius=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; all columns."""
    importable(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.uncontaminated(docs, items, window=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and n_chars brought up to date; all columns."""
    return secrets.redacted(docs, size="n_chars" if "n_chars" in docs.columns else None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    importable(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", mask_secrets),
    ("packing", pack_sequences),
]

# The classifier and the fingerprints are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
