"""The registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslink.llm import bpe_table, decontaminate, licenses, nearest, piece_agenda, preference, quality, ranked, simhash, spellings, substring_dedup, token_orc, toxicity
from crosslink.llm.oracles import ORACLES
from crosslink.llm.common import scratch, small_batches, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
PIECES = "piece_bpe_32k.model"


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as ORC in order of doc_id, read back: start, n_tokens and checksum of each."""
    small_batches(spark)
    path = scratch(spark, "token-orc")
    token_orc.write_token_orc(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID, temporary=True)
    return token_orc.token_spans(token_orc.read_token_orc(spark, path))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the convolutional network."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, net, 0.3).drop("text")


def op3_bpe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    small_batches(spark)
    return bpe_table.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a document where a benchmark item stands, one edit in twenty characters allowed."""
    small_batches(spark)
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 0.05)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    small_batches(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 3)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and digest of the kept words of every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substring_dedup.kept_texts(docs, 35).withColumn("kept_sha256", F.sha2("kept", 256))
    return substring_dedup.with_kept(docs, kept, ["n_words", "n_removed", "kept_sha256"]).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, 0.5).drop("text")


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with another last answer: shared prompt and two masked completions."""
    return preference.format_exchanged(table(spark, sf_dir, "conversations"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids and decoded text of every document, as digests."""
    small_batches(spark)
    return piece_agenda.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op12_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of five letters and three occurrences with its more frequent neighbour, and where following these ends."""
    return spellings.variants(spellings.counted_words(table(spark, sf_dir, "documents"), 97))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    small_batches(spark)
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
