"""Helpers shared by the training-data operators: tables, scratch folders, Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.scratch import remove, remove_at_end, scratch, write, written  # noqa: F401

#: Texts are handled in slices of about this many UTF-8 bytes (a slice holds one text at least).
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows in an Arrow batch, so that a batch of long texts stays small. Call before building a plan with Arrow functions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], more: dict[str, T.DataType] | None = None) -> DataFrame:
    """``df.mapInArrow`` whatever the columns are called: ``run`` yields the columns of ``df``, then those of ``more``, as lists of arrays."""
    more = more or {}
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = T.StructType([*plain.schema.fields, *[T.StructField(f"m{i}", kind) for i, kind in enumerate(more.values())]])
    names = schema.names
    out = plain.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays(columns, names=names) for columns in run(batches)), schema)
    return out.toDF(*df.columns, *more)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def row_keys() -> list[Column]:
    """k1, k2: hashes of doc_id and of text, never null. Rows that agree in both are copies of one row."""
    return [F.xxhash64("doc_id").alias("k1"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k2")]


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column is called so."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def one_row_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each root of ``groups`` (k1, k2, doc_id, root; a row for each row of ``docs``) one row of ``docs``, unchanged: that of the smallest id, nulls last.

    The rows that stay are joined by both keys, so each text moves once and rows with null or repeated ids stay apart.
    """
    keys = fresh(docs.columns, "__k1", "__k2")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("least")
    kept = groups.groupBy("root").agg(least).select(*[F.col(f"least.{c}").alias(k) for c, k in zip(("k1", "k2"), keys)])
    own = docs.select("*", *[c.alias(k) for c, k in zip(row_keys(), keys)])
    return own.join(kept, keys, "left_semi").dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])


def plain_strings(column: pa.Array) -> pa.Array:
    """As string (not large_string), nulls as empty."""
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def slices(batch: pa.RecordBatch, text: str | int = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut so that the texts of a slice hold about ``most`` bytes."""
    column = plain_strings(batch.column(text if isinstance(text, int) else batch.schema.get_field_index(text)))
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)) if len(column) else np.zeros(0, np.int64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and where each text's words begin (one more entry than texts)."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(plain_strings(column)))
    words, starts = lists.flatten(), np.asarray(lists.offsets.to_numpy(), np.int64)
    starts = starts - starts[0]
    if pc.any(pc.equal(words, "")).as_py():  # a text without words gives one empty word
        keep = pc.not_equal(words, "")
        before = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
        words, starts = words.filter(keep), before[starts]
    return words, starts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] entries, then the same for the next one."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    kind = np.int32 if total + int(starts.max()) < 1 << 31 else np.int64
    first = np.cumsum(lengths, dtype=kind) - lengths
    out = np.repeat((starts - first).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out
