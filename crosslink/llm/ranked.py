"""Ranked lexical search, a term at a time with a limited set of accumulators.

Documents are read once for their terms: of each, its length and how often it holds which query term stay. Counts over all of them
give the weights. Then each task takes its documents in blocks, inverts a block into postings, and works through each item's terms
from the rarest on, adding to one accumulator a document. Once the terms that are left cannot lift a new document to the k-th
best partial score (that of earlier blocks counted in), no accumulator is made any more, and those that exist are brought to their
exact score. Each task hands on k documents an item; a window takes the best k of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.llm.common import plain_strings, ranges, slices, write

#: Characters of items that go to the tasks at once; more items take more passes over the documents.
ITEM_CHARS = 8_000_000
#: Documents of a block: so many at most, and so many postings (a document at least).
BLOCK_DOCS, BLOCK_POSTINGS = 50_000, 4_000_000
#: Fixed values of the score.
SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 75, 8
#: Bytes of terms: a digit, a letter (A-Z in lower case) or part of a character beyond ASCII stays, all else becomes 0.
_KEPT = np.array([c if c >= 128 or chr(c).isalnum() else 0 for c in range(256)], np.uint8)
_KEPT[65:91] += 32


def terms_of(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """The terms of all texts in a row, and how many each text has: maximal runs of ASCII letters, digits and all characters beyond ASCII, only A-Z lower-cased."""
    texts = plain_strings(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = _KEPT[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    ends = ends - ends[0]
    inside = data != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    bounds = ends[:-1][ends[:-1] < ends[1:]]
    begins[bounds] = inside[bounds]  # a text begins a term of its own
    before = np.concatenate([[0], np.cumsum(inside)])
    at = np.flatnonzero(begins)
    offsets = np.append(before[at], before[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside])))
    return words, np.diff(np.concatenate([[0], np.cumsum(begins)])[ends])


def query_table(rows: list) -> tuple[list[str], list[tuple[list[int], list[int]]]]:
    """The distinct terms of some items, and for each item their numbers and how often it repeats each."""
    words, n = terms_of(pa.array([r.text for r in rows], pa.string()))
    coded = words.dictionary_encode()
    parts = np.split(coded.indices.to_numpy(), np.cumsum(n)[:-1])
    return coded.dictionary.to_pylist(), [tuple(x.tolist() for x in np.unique(p, return_counts=True)) for p in parts]


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """Distinct rows (item_id, text) with a text, in blocks of about ``ITEM_CHARS`` characters."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_CHARS)
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0, r.text))


def held_terms(docs: DataFrame, terms) -> DataFrame:
    """doc_id, n (terms of the text, repeats included), terms, tf: which of the broadcast ``terms`` it holds, by number, and how often. Documents without any term are left out."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = T.StructType().add("doc_id", "long").add("n", "long").add("terms", T.ArrayType(T.IntegerType())).add("tf", T.ArrayType(T.IntegerType()))

    def run(batches):
        known = pa.array(terms.value, pa.string())
        width = max(1, len(known))
        for whole in batches:
            for batch in slices(whole, 1):
                words, n = terms_of(batch.column(1))
                number = pc.index_in(words, known)
                found = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
                row = np.repeat(np.arange(len(n)), n)[found]
                pairs, tf = np.unique(row * width + number.take(pa.array(found)).to_numpy().astype(np.int64), return_counts=True)
                upto = pa.array(np.searchsorted(pairs, np.arange(len(n) + 1) * width).astype(np.int32))
                lists = [pa.ListArray.from_arrays(upto, pa.array(x.astype(np.int32))) for x in (pairs % width, tf)]
                out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=schema.names)
                yield out.filter(pa.array(n > 0))

    return chosen.mapInArrow(run, schema)


class Postings:
    """A block of documents by term: the documents of each term in order, and what one use of the term in an item adds to each."""

    def __init__(self, doc_ids: pa.Array, n: np.ndarray, terms: pa.ListArray, tf: np.ndarray, weights: np.ndarray, docs: int, length: int):
        self.doc_ids = doc_ids
        number, held = terms.flatten().to_numpy(), pc.list_value_length(terms).to_numpy().astype(np.int64)
        row, m = np.repeat(np.arange(len(n), dtype=np.int32), held), 100 - LENGTH_SHARE + LENGTH_SHARE * n * docs // length
        order = np.argsort(number, kind="stable")
        tf, row, number = tf[order].astype(np.int64), row[order], number[order]
        adds = weights[number] * (SCALE * tf // (1000 * tf + SATURATION * m[row]))
        self.rows, self.adds, number = row[adds > 0], adds[adds > 0], number[adds > 0]
        self.at = np.searchsorted(number, np.arange(len(weights) + 1))
        some = np.flatnonzero(np.diff(self.at))
        self.most = np.zeros(len(weights), np.int64)
        if len(some):
            self.most[some] = np.maximum.reduceat(self.adds, self.at[some])
        self.scores = np.zeros(len(n), np.int64)

    def best(self, terms: np.ndarray, uses: np.ndarray, k: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of all documents that may be among the best ``k``. terms: rarest first; found: the scores of the best so far."""
        left = np.append(np.cumsum((self.most[terms] * uses)[::-1])[::-1], 0)  # what the terms from here on can add at most
        scores, rows, kth, making = self.scores, np.zeros(0, np.int32), _kth(found, k), True
        for i, (term, use) in enumerate(zip(terms.tolist(), uses.tolist())):
            a, b = self.at[term], self.at[term + 1]
            if making and left[i] < kth:
                making = False
                rows = np.sort(rows)
            if a == b:
                continue
            if making:
                new = self.rows[a:b][scores[self.rows[a:b]] == 0]
                rows = np.concatenate([rows, new])
                scores[self.rows[a:b]] += use * self.adds[a:b]
            else:  # the survivors are looked up among the postings
                good = scores[rows] + left[i] >= kth
                scores[rows[~good]] = 0
                rows = rows[good]
                place = np.minimum(np.searchsorted(self.rows[a:b], rows), b - a - 1) + a
                hit = self.rows[place] == rows
                scores[rows[hit]] += use * self.adds[place[hit]]
            kth = max(kth, _kth(np.concatenate([found, scores[rows]]), k))
        good = rows[scores[rows] >= kth]
        out = good, scores[good]
        scores[rows] = 0
        return out


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score; 1 if there are fewer, as a document needs a score above 0."""
    return max(1, int(np.partition(scores, len(scores) - k)[-k])) if len(scores) >= k else 1


def _doc_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in blocks."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        held.append(batch)
        docs, postings = docs + batch.num_rows, postings + len(batch.column(2).flatten())
        if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, docs, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def ordered(scores: np.ndarray, doc_ids: pa.Array) -> np.ndarray:
    """Places by falling score, then by doc_id, nulls last."""
    return np.lexsort((pc.fill_null(doc_ids, 0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False), -scores))


def best_of_tasks(held: DataFrame, query, weights, docs: int, length: int, k: int) -> DataFrame:
    """item (its place in the block of items), doc_id, score: the best ``k`` documents of each task."""

    def run(batches):
        weight, items = weights.value, query.value
        rarest = [np.array(terms, np.int64)[np.argsort(-weight[terms], kind="stable")] if terms else np.zeros(0, np.int64) for terms, _ in items]
        uses = [np.array(n, np.int64)[np.argsort(-weight[terms], kind="stable")] if terms else np.zeros(0, np.int64) for terms, n in items]
        found = [(np.zeros(0, np.int64), pa.array([], pa.int64())) for _ in items]
        for block in _doc_blocks(batches):
            doc_ids, n, terms, tf = (block.column(i).combine_chunks() for i in range(4))
            postings = Postings(doc_ids, n.to_numpy(), terms, tf.flatten().to_numpy(), weight, docs, length)
            for i, (scores, ids) in enumerate(found):
                rows, new = postings.best(rarest[i], uses[i], k, scores)
                if len(rows):
                    scores, ids = np.concatenate([scores, new]), pa.concat_arrays([ids, doc_ids.take(pa.array(rows))])
                    top = ordered(scores, ids)[:k]
                    found[i] = scores[top], ids.take(pa.array(top))
        out = [pa.array(np.repeat(np.arange(len(found)), [len(s) for s, _ in found])), pa.concat_arrays([ids for _, ids in found]), pa.array(np.concatenate([s for s, _ in found]))]
        yield pa.RecordBatch.from_arrays(out, names=["item", "doc_id", "score"])

    return held.mapInArrow(run, "item long, doc_id long, score long")


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``k`` highest-scoring rows of ``docs`` for each row of ``items``, score above 0; equal scores by ascending doc_id, nulls last.

    The score is a sum over the item's terms, repeats included, of weight x saturated count, all in whole numbers. Null and blank
    texts have no terms: such documents count nowhere, such items give no rows. Repeated documents are documents of their own;
    repeated items are one, items that share an id but not the text are each ranked. Empty tables give no rows. Items go to the
    tasks in blocks of about 8 million characters; each block reads the documents once.
    """
    spark = docs.sparkSession
    found = []
    for rows in _item_blocks(items):
        vocabulary, query = query_table(rows)
        if not vocabulary:
            continue
        share = spark.sparkContext.broadcast
        held, _ = write(held_terms(docs, share(vocabulary)), "held-terms")
        total, length = held.agg(F.count("*"), F.sum("n")).first()
        if not total:
            continue
        counts = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for each term of the block of items
        weights = np.zeros(len(vocabulary), np.int64)
        for r in counts:
            weights[r.term] = weight(total, r["count"])
        best = best_of_tasks(held, share(query), share(weights), total, length, k)
        ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).filter(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item long, item_id long")
        found.append(ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
