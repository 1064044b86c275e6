"""Corpus preparation over ``documents`` in five stages, each written as Parquet and read again
as the next one's input: quality rules, near-duplicates, benchmark decontamination, secret
scan, packing.  All but the last return the columns of ``documents``; each works on all
documents that its predecessor kept.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, neardup, packing, quality, queries, secrets
from tessera.llm.shared import bound_batches, scratch, table

#: Spark operators with models and automata: no SQL statement gives these rows.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a fertility band rejects."""
    bound_batches(spark)
    return quality.keep_good(docs, *queries.vocabularies())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle similarity 0.8 or more."""
    bound_batches(spark)
    return neardup.keep_one(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is in a benchmark window."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    bound_batches(spark)
    out = secrets.redact(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        length = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.contains("text", F.lit(secrets.MARK)), length).otherwise(F.col("n_chars")))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids, in sequences of at most 2048 tokens."""
    bound_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
