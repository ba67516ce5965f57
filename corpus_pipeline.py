"""Corpus preparation: quality, near duplicates, shared passages, source weights, tokens.

Each stage takes what its predecessor kept, stored as Parquet and read again, and hands on the columns of
``documents``; the last one gives token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoptrail.llm import bpe, jaccard_join, mixture, quality_model, substring_dedup
from shoptrail.llm.common import table
from shoptrail.session import new_shared_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
RANKS = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled documents of its input, at most
    ``quality_model.DOCUMENTS_PER_LABEL`` rows of each label, whole, and scores all documents."""
    model = quality_model.learn(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id."""
    return jaccard_join.keep_first(docs).select(*COLUMNS)


def shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; emptied documents go."""
    cleaned = substring_dedup.deduplicate(docs)
    emptied = (F.col("n_removed") > 0) & (F.length(F.translate("text", " \t\n\x0b\x0c\r", "")) == 0)
    return (
        cleaned.where(~emptied)
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
        .select(*COLUMNS)
    )


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixture.repeated(docs).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, token_ids, comes_back): ids as little-endian unsigned 32-bit integers, decoded again;
    ``comes_back`` says that they give the text's very bytes."""
    encoded = bpe.encode_checked(docs.select("doc_id", "source", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    n_tokens = (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens")
    return encoded.select("doc_id", "source", n_tokens, "token_ids", "comes_back")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("shared_passages", shared_passages),
    ("source_mixture", source_mixture),
    ("token_ids", token_ids),
]

#: Learned scores, signatures and merges are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
