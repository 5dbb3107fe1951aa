"""The corpus pipeline: stages that take (spark, docs, sf_dir) and return the documents they keep.

Each stage is one operator of ``crosslink.llm``; what it returns is written as Parquet and read again as the next one's docs. All
stages but the last return the columns of ``docs`` in their order, whatever their names; a text that is null stays null.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslink.llm import bpe_table, decontaminate, simhash, substring_dedup, toxicity
from crosslink.llm.common import fresh, small_batches, table, written


def same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the model learns from labelled rows of ``docs``."""
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    prefix = "__"
    while any(f"{prefix}{c}" in docs.columns for c in ("held_out", "score", "predicted")):
        prefix += "_"
    return same_columns(toxicity.score(docs, model, 0.5, prefix).filter(f"{prefix}predicted = 0"), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that chains of near copies connect (sets of five-word shingles, Jaccard 0.8 and more) the one with the smallest id. Texts without words are a group like any other."""
    small_batches(spark)
    return same_columns(simhash.one_of_each(docs, 5, 0.8), docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of 35 words and more; a column n_chars, if there is one, follows a text that changes. Documents left without words stay, empty."""
    small_batches(spark)
    words, removed = fresh(docs.columns, "__words", "__removed")
    kept = substring_dedup.remove_repeats(docs, 35, (words, removed))
    if "n_chars" in docs.columns:
        changed = F.col(removed) > 0
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return same_columns(kept, docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    small_batches(spark)
    return same_columns(decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), 0.05), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document that is left."""
    small_batches(spark)
    return bpe_table.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near-duplicates", one_of_each_group),
    ("substring dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("BPE encoding and decoding", encoded),
]

#: Classifiers, fingerprints and tokenizers can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
