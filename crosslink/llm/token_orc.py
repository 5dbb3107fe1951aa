"""Token ids as ORC files: sorted by document, run-length encoded integers, row indexes and a Bloom filter on the id."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosslink.llm.common import partitions, remove_at_end, slices
from crosslink.llm.word_bpe import worker_encoder

#: part: number of the sorted part; at: ids of the same part before this document; tokens: the document's ids, end id included.
SCHEMA = "doc_id long, part int, at long, n_tokens long, tokens array<int>"


def encode_sorted(docs: DataFrame, tokenizer: str, end_id: int, parts: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) dealt by ranges of doc_id, sorted, encoded, with ``end_id`` after each document.

    Null texts count as empty, null ids sort first; rows with the same doc_id stay separate rows, in order of their text.
    The ranges also go by the beginning of the text, so an id that very many rows have (null, say) is many tasks. Other columns
    are left out. An empty table gives no rows.
    """
    parts = parts or partitions(docs.sparkSession)

    def encode(batches):
        coder, at = worker_encoder(tokenizer), 0
        for whole in batches:
            for batch in slices(whole):
                counts, ids = coder.encode(batch.column(1))
                ends = np.cumsum(counts + 1)
                flat = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int32)
                flat[np.delete(np.arange(len(flat)), ends - 1)] = ids
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(at + ends - counts - 1), pa.array(counts + 1), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                    names=["doc_id", "part", "at", "n_tokens", "tokens"],
                )
                at += int(ends[-1])

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = dealt.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.left("text", F.lit(64))).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return dealt.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(encode, SCHEMA)


def write_token_orc(docs: DataFrame, path: str, tokenizer: str, end_id: int, parts: int | None = None, stripe_mb: int = 16, bloom_fpp: float = 0.01, temporary: bool = False) -> None:
    """Writes ``encode_sorted`` as ORC under ``path``, one file for each range of doc_id.

    A file's integers are run-length encoded in stripes of about ``stripe_mb``, which readers take in parallel; row indexes and
    the Bloom filter let a reader skip stripes and row groups without a wanted doc_id. ``temporary`` files go when the session ends.
    """
    writer = encode_sorted(docs, tokenizer, end_id, parts).write.option("compression", "zstd")
    for key, value in {"orc.stripe.size": stripe_mb << 20, "orc.row.index.stride": 1000, "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": bloom_fpp}.items():
        writer = writer.option(key, str(value))
    writer.orc(path)
    if temporary:
        remove_at_end(docs.sparkSession, path)


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files again; with ``doc_ids`` only those documents, by the files' own statistics and Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if doc_ids is None else df.filter(F.col("doc_id").isin(doc_ids))


def token_spans(tokens: DataFrame) -> DataFrame:
    """From read files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The ids of each part are one row; their running sum is a window over these rows, one for each file and not each document.
    """
    sizes = tokens.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = sizes.select("part", (F.sum("size").over(W.orderBy("part")) - F.col("size")).alias("base"))

    def checksums(batches):
        for batch in batches:
            lists = batch.column(4)
            offsets, flat = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(), "<u4").view(np.uint8)
            crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], names=["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    summed = tokens.select("doc_id", "part", "at", "n_tokens", "tokens").mapInArrow(checksums, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return summed.join(before, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
