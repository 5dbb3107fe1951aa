"""BPE encoding by a table of distinct words, and decoding by a table from id to piece."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.llm.common import mapped, partitions, words_of
from crosslink.llm.word_bpe import MARKS, Words, worker_encoder

IDS_AT_ONCE = 1 << 19
#: Texts of a block hold about this many bytes (a block holds one text at least).
BLOCK_BYTES = 16 << 20


def gathered(batches: Iterator[pa.RecordBatch], text: int, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in blocks whose texts (column ``text``) hold about ``most`` bytes, so that few words stand in many blocks."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)) if batch.num_rows else np.zeros(0, np.int64)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = int(np.searchsorted(ends, done + most - size, side="right"))
            to = max(to, at + (0 if held else 1))
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(ends[to - 1]) - done
            if to < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            at = to
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def packed(columns: dict) -> bytes:
    """Columns as a compressed Arrow stream."""
    table, sink = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all().combine_chunks()


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, their first bytes together, then their second ones and so on, as these pack better."""
    split = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    return packed({f"b{i}": np.ascontiguousarray(split[:, i]) for i in range(4)})


def numbers_of(data: pa.Scalar) -> np.ndarray:
    table = unpacked(data)
    return np.stack([table[f"b{i}"].to_numpy() for i in range(4)], axis=1).view("<u4").ravel().astype(np.int64)


def coded_blocks(docs: DataFrame, keep: list[str], buckets: int) -> tuple[DataFrame, DataFrame]:
    """The texts as word numbers: block, data; and the distinct words of each block: block, bucket, data.

    A block is some texts of one task. Data of a block, packed: the columns ``keep`` and n (words of each text); for each word in
    order 0 if the block has it for the first time, else 1 + the number of the word, numbers given as words come up; and the
    bucket of each number, a hash of the word without trailing marks. Data of a bucket of a block: its words, in order of number.
    The two are read from ``docs`` apart, as writing them would take as much disk as moving them; a block of which not just its
    own words come back (docs that gave other rows the second time) raises when it is joined.
    """
    chosen = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("part"))
    at = len(keep)

    def blocks(batches):
        for number, batch in enumerate(gathered(batches, at)):
            words, starts = words_of(batch.column(at))
            coded = words.dictionary_encode()
            bare = pc.utf8_rtrim(coded.dictionary, MARKS).to_numpy(zero_copy_only=False)
            bucket = (pd.util.hash_array(bare, categorize=False) % np.uint64(buckets)).astype(np.int32) if len(bare) else np.zeros(0, np.int32)
            yield (batch.column(at + 1)[0].as_py() << 32) + number, batch, np.diff(starts), coded, bucket

    def texts(batches):
        for block, batch, n, coded, bucket in blocks(batches):
            indices = coded.indices.to_numpy()
            new = np.zeros(len(indices), bool)
            new[np.unique(indices, return_index=True)[1]] = True
            rows = packed({**{f"k{i}": batch.column(i) for i in range(at)}, "n": n})
            data = packed({"data": [rows, planes(np.where(new, 0, indices + 1)), planes(bucket)]})
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([data], pa.binary())], names=["block", "data"])

    def words(batches):
        for block, _, _, coded, bucket in blocks(batches):
            sizes = np.bincount(bucket, minlength=buckets)
            ends, by_bucket = np.cumsum(sizes), coded.dictionary.take(pa.array(np.argsort(bucket, kind="stable")))
            some = np.flatnonzero(sizes)
            data = [packed({"words": by_bucket.slice(ends[b] - sizes[b], sizes[b])}) for b in some.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(data), block)), pa.array(some.astype(np.int32)), pa.array(data, pa.binary())], names=["block", "bucket", "data"])

    return chosen.mapInArrow(texts, "block long, data binary"), chosen.mapInArrow(words, "block long, bucket int, data binary")


def word_ids(words: DataFrame, tokenizer: str) -> DataFrame:
    """The words of ``coded_blocks`` -> block, bucket, data: how many ids each word has, and all ids.

    All rows of a bucket meet in one group, so each distinct word is encoded once in the whole corpus; a word comes once from each
    block, however often it stands there, so a frequent word is no hot key. A bucket's size falls with the number of buckets.
    """

    def encode(rows: pa.Table) -> pa.Table:
        coder = worker_encoder(tokenizer)
        lists = [unpacked(x)["words"].combine_chunks() for x in rows["data"]]
        coded = pa.concat_arrays(lists).dictionary_encode()
        n, ids = coder.of_words(coded.dictionary, coder.encode_words).take(coded.indices.to_numpy())
        ends = np.cumsum([0, *map(len, lists)])
        upto = np.concatenate([[0], np.cumsum(n)])[ends]
        data = [packed({"found": [packed({"n": n[a:b].astype(np.int32)}), packed({"ids": ids[c:d]})]}) for a, b, c, d in zip(ends[:-1], ends[1:], upto[:-1], upto[1:])]
        return pa.table({"block": rows["block"], "bucket": rows["bucket"], "data": pa.array(data, pa.binary())})

    return words.groupBy("bucket").applyInArrow(encode, "block long, bucket int, data binary")


def joined_back(docs: DataFrame, tokenizer: str, keep: list[str], finish: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``finish`` over batches of the columns ``keep`` and tokens, where ids are joined to the words of each text by block and position."""
    places, words = coded_blocks(docs, keep, partitions(docs.sparkSession))
    ids, size = word_ids(words, tokenizer), len(keep)

    def join(texts: pa.Table, found: pa.Table) -> pa.Table:
        parts = [(b, unpacked(x)["found"]) for b, x in zip(found["bucket"].to_pylist(), found["data"])]
        parts.sort(key=lambda part: part[0])
        counts = [unpacked(p[0])["n"].to_numpy() for _, p in parts]
        flat = np.concatenate([unpacked(p[1])["ids"].to_numpy() for _, p in parts]) if parts else np.zeros(0, np.int32)
        table = Words(None, np.concatenate(counts).astype(np.int64) if parts else np.zeros(0, np.int64), flat)

        def batches():
            if texts.num_rows != 1:
                raise RuntimeError("docs gave other rows when read again; write them first")
            rows, codes, bucket = unpacked(texts["data"][0])["data"]
            rows, codes, bucket = unpacked(rows), numbers_of(codes), numbers_of(bucket)
            if not np.array_equal(np.repeat([b for b, _ in parts], [len(n) for n in counts]) if parts else [], np.sort(bucket)):
                raise RuntimeError("docs gave other rows when read again; write them first")
            place = np.empty(len(bucket), np.int64)
            place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
            new = codes == 0
            codes -= 1
            codes[new] = np.arange(len(bucket))
            at = 0
            for batch in rows.to_batches(max_chunksize=1000):
                n = batch.column(size).to_numpy()
                each, ids = table.take(place[codes[at : at + int(n.sum())]])
                at += int(n.sum())
                upto = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(n)])]
                yield pa.RecordBatch.from_arrays([*batch.columns[:size], pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids))], names=[*keep, "tokens"])

        return pa.Table.from_batches(list(finish(batches())))  # a block has one text at least

    return places.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(join, schema)


def encode(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (no text needed among them) and tokens, array<int>: the ids of the whole text.

    Texts are split into words in the tasks that read them; each distinct word of the corpus is encoded once, and the ids are
    joined back to the words by block and position. The ids equal the tokenizers library's without special tokens. Null and
    blank texts have no ids; rows are independent of each other, repeated or not. A column called tokens is replaced. An empty
    table gives no rows. ``docs`` is read twice and should be a table that was written, not a plan whose rows change places.
    """
    keep = [c for c in keep if c != "tokens"]
    schema = T.StructType([*[docs.select(F.col(f"`{c}`")).schema[0] for c in keep], T.StructField("tokens", T.ArrayType(T.IntegerType()))])
    return joined_back(docs, tokenizer, keep, lambda batches: batches, schema)


@functools.lru_cache(1)
def pieces(tokenizer: str) -> pa.Array:
    """id -> piece; null where the vocabulary has a gap."""
    vocabulary = worker_encoder(tokenizer).tokenizer.get_vocab(with_added_tokens=True)
    out: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        out[i] = piece
    return pa.array(out)


def decode_batches(batches, table: pa.Array, at: int, names: list[str]):
    """All columns and the text of the ids in column ``at``."""
    for whole in batches:
        ends, start = np.cumsum(pc.fill_null(pc.list_value_length(whole.column(at)), 0).to_numpy()), 0
        while start < whole.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + IDS_AT_ONCE, side="right")))
            batch = whole.slice(start, stop - start)
            n, texts = joined(batch.column(at), table)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=names)
            start = stop


def joined(lists: pa.Array, table: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many ids each list has, and the table's strings for them, one blank between; ids without a string are left out."""
    ids = lists.flatten()
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    inside = pc.fill_null(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(table))), False)
    found = table.take(pc.if_else(inside, ids, None))
    known = found.is_valid()
    upto = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False))])[np.concatenate([[0], np.cumsum(n)])]
    return n, pc.binary_join(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), found.drop_null()), " ")


def digest_batches(batches, digits: pa.Array, names: list[str]):
    """From doc_id, tokens, decoded: the id, the number of ids and both digests."""
    hexes = lambda texts: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in texts], pa.string())
    for batch in batches:
        n, text = joined(batch.column(1), digits)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)), hexes(text), hexes(batch.column(2))], names=names)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with decoded, string: the pieces of tokens, special ones too, as the tokenizers library joins them.

    The table from id to piece has the size of the vocabulary, so each worker holds it and joins by id in place: no id is shuffled.
    Ids outside the vocabulary and null ids are left out; a null array and an empty one give an empty text. A column called
    decoded is replaced.
    """
    encoded = encoded.drop("decoded")
    at = encoded.columns.index("tokens")

    def run(batches):
        for batch in batches:
            names = [*batch.schema.names, "decoded"]
            yield from (b.columns for b in decode_batches([batch], pieces(tokenizer), at, names))

    return mapped(encoded, run, {"decoded": T.StringType()})


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, encoded and decoded; see ``encode`` and ``decode``.

    Ids, decoded text and digests follow each other within a block, so that neither ids nor texts are shuffled.
    """

    def finish(batches):
        table = pieces(tokenizer)
        digits = pa.array([str(i) for i in range(len(table))])
        return digest_batches(decode_batches(batches, table, 1, ["doc_id", "tokens", "decoded"]), digits, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType().add("doc_id", "long").add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return joined_back(docs.withColumn("doc_id", F.col("doc_id").cast("long")), tokenizer, ["doc_id"], finish, schema)
