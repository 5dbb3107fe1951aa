"""Exact repeated passages: windows of consecutive words that occur twice anywhere are cut out of the texts.

Anchors: words at positions whose remainder by ``period`` lies in a difference cover start an anchor of
``window - period + 1`` words. For any two equal windows there is a shift below the period that puts both on cover
positions, so both hold an equal anchor at that shift; only windows around anchors that occur twice can be repeats. These
are extended to the whole window and compared by 128 bits of hash, texts by 127.

A passage may stand in very many texts. What a task sees twice among its own texts is known to be repeated: such rows are dealt by
their text and not by their hash, and only two marks for each such hash go where the hash is counted. So the rows of one hash in
one task are no more than a few for each batch of texts, however many texts hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.llm.common import fresh, partitions, slices, words_of

#: Perfect difference covers, by period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
SLICE = 4 << 20
ID = ["t1", "t2"]


def cover_for(window: int, least: int = 5) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of half the window and of ``least`` words at least; period 1 for short windows."""
    fit = [p for p in COVERS if window - p + 1 >= max(least, window * 3 // 7)]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def rolling(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each run of ``length`` values, built from runs of 1, 2, 4, ... values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    block, size, power, out, done = values, 1, np.uint64(base), np.zeros(n, np.uint64), 0
    while True:
        if length & size:
            out = out * power + block[done : done + n]
            done += size
        if done == length:
            return mixed(out)
        block, size = block[:-size] * power + block[size:], 2 * size
        with np.errstate(over="ignore"):
            power = power * power


class Words:
    """The words of a slice of texts as numbers. ``at``: position in its text; ``of``: row of its text; ``n``: words a text has."""

    def __init__(self, texts: pa.Array, keys: int = 1):
        self.words, self.starts = words_of(texts)
        self.n = np.diff(self.starts)
        self.of = np.repeat(np.arange(len(self.n)), self.n)
        self.at = np.arange(len(self.words)) - self.starts[self.of]
        coded = self.words.dictionary_encode()
        names, codes = np.asarray(coded.dictionary.to_pandas(), object), coded.indices.to_numpy()
        self.hashes = [pd.util.hash_array(names, hash_key=f"crosslink-words{k}")[codes] for k in range(keys)]


def anchors(words: Words, window: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Where anchors start (numbers of words of the slice), and their hashes."""
    length = window - period + 1
    hashes = rolling(words.hashes[0], length, 0x5851F42D4C957F2D)
    chosen = np.zeros(period, bool)
    chosen[list(cover)] = True
    at, n = words.at[: len(hashes)], words.n[words.of[: len(hashes)]]
    where = np.flatnonzero(chosen[at % period] & (at + length <= n) & (n >= window))
    return where, hashes[where]


#: The lowest bit of t2 is free: it says that a row is known to be repeated. A mark has no text: both are 0.
SURE = np.uint64(1)


def pre_counted(keys: list[np.ndarray], text: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Keys by which rows are dealt, the texts' ids, and the keys of the marks.

    A row whose keys another row of this slice has is ``SURE`` and is dealt by its text, whose mixed id is added to the keys. Each
    repeated combination of keys gets a mark.
    """
    order = np.lexsort(keys)
    same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    first = again.copy()
    first[1:] &= ~same
    sure = np.zeros(len(order), bool)
    sure[order] = again
    return [np.where(sure, k + mixed(t), k) for k, t in zip(keys, text)], [text[0], np.where(sure, text[1] | SURE, text[1])], [k[order][first] for k in keys]


def repeated(batches: Iterator[pa.RecordBatch], keys: int, out: list[int], text: int | None = None) -> Iterator[pa.RecordBatch]:
    """From rows sorted by their first ``keys`` columns: the columns ``out`` of rows whose keys another row has too.

    ``text``: the column with t1, t2 being the next one; sure rows always come out, marks never. Only one row is held from batch to
    batch, however many rows a key has.
    """
    held, twice = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        k = [batch.column(i).to_numpy() for i in range(keys)]
        same = np.logical_and.reduce([x[1:] == x[:-1] for x in k])
        hit = np.zeros(batch.num_rows, bool)
        hit[1:] |= same
        hit[:-1] |= same
        hit[0] |= twice
        held, twice = batch.slice(batch.num_rows - 1), bool(hit[-1])
        yield from _chosen(batch.slice(0, batch.num_rows - 1), hit[:-1], out, text)
    if held is not None:
        yield from _chosen(held, np.array([twice]), out, text)


def _chosen(batch: pa.RecordBatch, hit: np.ndarray, out: list[int], text: int | None) -> Iterator[pa.RecordBatch]:
    if text is not None:
        t1, t2 = (batch.column(text + i).to_numpy().view(np.uint64) for i in range(2))
        hit = (hit | ((t2 & SURE) > 0)) & ((t1 | t2) > 0)
    if hit.any():
        yield batch.filter(pa.array(hit)).select(out)


def plain_id(t2: pa.Array) -> pa.Array:
    """t2 without its free bit."""
    return pa.array((t2.to_numpy().view(np.uint64) & ~SURE).view(np.int64))


def cut_out(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the words that ``gone`` marks and the white space behind each; nothing else changes."""
    data = np.frombuffer(text, np.uint8)
    word = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    step = np.zeros(len(data) + 1, np.int32)
    np.add.at(step, starts[gone], 1)
    np.add.at(step, np.append(starts[1:], len(data))[gone], -1)
    return data[np.cumsum(step[:-1]) == 0].tobytes()


def distinct_texts(docs: DataFrame) -> DataFrame:
    """t1, t2 (127 bits of hash), text: each text once. Copies meet in map tasks first."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.select(*text_id(), "text").groupBy(*ID).agg(F.first("text").alias("text"))


def text_id(text: str = "text") -> list:
    known = F.coalesce(text, F.lit(""))
    return [F.xxhash64(known).alias("t1"), F.shiftleft(F.xxhash64(F.lit("second"), known), 1).alias("t2")]


def kept_texts(docs: DataFrame, window: int = 35, original: bool = False) -> DataFrame:
    """For each distinct text of ``docs``: t1, t2, n_words, n_removed, kept (its kept words joined by one space; ``original``: the text with its other words cut out)."""
    period, cover = cover_for(window)
    parts = partitions(docs.sparkSession)
    texts = distinct_texts(docs)

    def dealt(keys, text, marks, more):
        """Rows, then two marks for each repeated key."""
        none = np.zeros(2 * len(marks[0]), np.uint64)
        columns = [np.concatenate([k, m, m]).view(np.int64) for k, m in zip(keys, marks)] + [np.concatenate([t, none]).view(np.int64) for t in text]
        columns += [np.concatenate([x, none.astype(x.dtype)]) for x in more.values()]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*(f"w{i + 1}" for i in range(len(keys))), *ID, *more])

    def find_anchors(batches):
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                words = Words(batch.column(2))
                where, hashes = anchors(words, window, period, cover)
                text = [batch.column(i).to_numpy().view(np.uint64)[words.of[where]] for i in range(2)]
                yield dealt(*pre_counted([hashes], text), {})

    def find_windows(batches):
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                words = Words(batch.column(2), keys=2)
                where, hashes = anchors(words, window, period, cover)
                lists = batch.column(3)
                known = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                of = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                twice = np.isin(mixed(hashes + mixed(words.of[where].astype(np.uint64))), mixed(known + mixed(of.astype(np.uint64))))
                upto = np.zeros(len(words.of) + 1, np.int64)
                np.add.at(upto, where[twice] + 1, 1)
                upto = np.cumsum(upto)
                start = np.flatnonzero(words.at + window <= words.n[words.of])
                start = start[upto[start + period] > upto[start]]
                text = [batch.column(i).to_numpy().view(np.uint64)[words.of[start]] for i in range(2)]
                pair = [rolling(h, window, b)[start] for h, b in zip(words.hashes, (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85))]
                yield dealt(*pre_counted(pair, text), {"start": words.at[start].astype(np.int32)})

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                words, starts = words_of(batch.column(2))
                n, lists = np.diff(starts), batch.column(3)
                covered = np.zeros(len(words) + 1, np.int64)
                of = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                first = starts[of] + np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)
                whole_text = np.flatnonzero((batch.column(4).to_numpy() > 1) & (n >= window))
                np.add.at(covered, np.concatenate([first, starts[whole_text]]), 1)
                np.add.at(covered, np.concatenate([first + window, starts[whole_text + 1]]), -1)
                keep = np.cumsum(covered[:-1]) == 0
                upto = np.concatenate([[0], np.cumsum(keep)])[starts]
                removed = n - np.diff(upto)
                if original:
                    known = [x.as_buffer().to_pybytes() for x in batch.column(2)]
                    kept = pa.array([cut_out(t, ~keep[a:b]) if r else t for t, a, b, r in zip(known, starts[:-1], starts[1:], removed)], pa.binary()).cast(pa.string())
                else:
                    kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), words.filter(pa.array(keep))), " ")
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n), pa.array(removed), kept], names=[*ID, "n_words", "n_removed", "kept"])

    def anchor_hits(batches):
        for batch in repeated(batches, 1, [1, 2, 0], 1):
            t1, t2, key = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            hashes = key - np.where(t2 & SURE, mixed(t1), np.uint64(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), plain_id(batch.column(1)), pa.array(hashes.view(np.int64))], names=[*ID, "hash"])

    def window_hits(batches):
        for batch in repeated(batches, 2, [2, 3, 4], 2):
            yield pa.RecordBatch.from_arrays([batch.column(0), plain_id(batch.column(1)), batch.column(2)], names=[*ID, "start"])

    hashed = texts.select(*ID, "text").mapInArrow(find_anchors, "w1 long, t1 long, t2 long")
    hits = hashed.repartition(parts, "w1").sortWithinPartitions("w1").mapInArrow(anchor_hits, "t1 long, t2 long, hash long")
    known = hits.groupBy(*ID).agg(F.collect_list("hash").alias("hashes"))
    windows = texts.join(known, ID).select(*ID, "text", "hashes").mapInArrow(find_windows, "w1 long, w2 long, t1 long, t2 long, start int")
    windows = windows.repartition(parts, "w1", "w2").sortWithinPartitions("w1", "w2")
    found = windows.mapInArrow(window_hits, "t1 long, t2 long, start int")
    starts = found.groupBy(*ID).agg(F.collect_list("start").alias("starts"))
    copies = docs.select(*text_id()).groupBy(*ID).agg(F.count("*").alias("copies"))
    joined = texts.join(copies, ID).join(starts, ID, "left")
    return joined.select(*ID, "text", "starts", "copies").mapInArrow(cut, "t1 long, t2 long, n_words long, n_removed long, kept string")


def with_kept(docs: DataFrame, per_text: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``columns`` of ``per_text``, which replace columns of the same names."""
    old, keys = [c for c in docs.columns if c not in columns], fresh([*docs.columns, *columns], *(f"__{c}" for c in ID))
    own = docs.alias("own").select(*[F.col(f"own.`{c}`") for c in old], *[x.alias(k) for x, k in zip(text_id("own.text"), keys)])
    new = per_text.select(*[F.col(c).alias(k) for c, k in zip(ID, keys)], *columns)
    return own.join(new, keys).select(*[f"`{c}`" for c in old], *columns)


def remove_repeats(docs: DataFrame, window: int = 35, counts: tuple[str, str] = ("n_words", "n_removed")) -> DataFrame:
    """``docs`` with its number of words and of removed ones, called as ``counts`` says, and its text without the words of repeated windows.

    A window is ``window`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one text; it is repeated if the same words also start
    anywhere else, in the same document too. All windows are judged on the input. A text without such a window stays as it is,
    null too; from others the words and the white space behind each are cut out. Null and blank texts have no words. Equal rows
    are copies of each other, so whole copies of at least ``window`` words lose all their words. Other columns are kept; columns
    called like the counts are replaced. An empty table gives no rows.
    """
    # the text comes back with its result, so that it isn't shuffled a second time; only whether it was null goes along
    kept = kept_texts(docs, window, True).select(*ID, F.col("kept").alias("text"), F.col("n_words").alias(counts[0]), F.col("n_removed").alias(counts[1]))
    null = fresh([*docs.columns, *counts], "__null")[0]
    found = with_kept(docs.withColumn(null, F.col("text").isNull()), kept, ["text", *counts])
    text = F.when(~F.col(null), F.col("text")).alias("text")
    more = [c for c in counts if c not in docs.columns]
    return found.select(*[text if c == "text" else F.col(f"`{c}`") for c in [*docs.columns, *more]])
