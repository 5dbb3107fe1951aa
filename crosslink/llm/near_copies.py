"""Near copies by SimHash, with a similarity that is held exactly: sets of word shingles of Jaccard similarity ``threshold`` and more.

Candidates are the links of the fingerprints' hierarchical index (``simhash.fingerprint_links``). Texts of similarity 0.8 can
differ in more bits than such an index can search, so what it can't see comes from an exact way for the rest:
shingles stand in one order for all texts, frequent ones last. Two sets over the threshold share a shingle among the first
``n - ceil(threshold n) + 1`` of each, so only texts that meet at such a shingle are compared. The number of differing bits of
two parity sketches is at most the number of shingles only one text has, which rules pairs out. All candidates are counted out.
Which shingles count as frequent is judged on a sample: it changes the work, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.llm.common import partitions, remove, row_keys, slices, write, written
from crosslink.llm.components import components
from crosslink.llm.simhash import SLICE, fingerprint_links, majority, shingle_hashes
from crosslink.llm.substring_dedup import repeated

SKETCH = 512
SMALL = 16
#: Against rounding: pairs this little below the threshold count as reaching it.
EPS = 1e-9


def shingle_sets(texts: pa.Array, size: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, frequent ones last, and how many each text has."""
    return sets_of(*shingle_hashes(texts, size), frequent)


def sets_of(hashes: np.ndarray, per_text: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    of = np.repeat(np.arange(len(per_text)), per_text)
    late = np.isin(hashes, frequent)
    order = np.lexsort((hashes, late, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.bincount(of[new], minlength=len(per_text))


def sketches(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parity of the number of shingles in each cell, a bit a cell, and how many words of 64 cells each text has.

    Cells: the least power of two not below n, ``SKETCH`` at least. The halves of a sketch together (xor) are the sketch of half as many cells.
    """
    cells = np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    base = np.cumsum(cells) - cells
    cell = np.repeat(base, n) + (hashes & np.repeat(cells - 1, n).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(cell, minlength=int(cells.sum())) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8"), cells // 64


def differing(flat: np.ndarray, start: np.ndarray, width: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits that differ between the sketches of rows i and j, at the width of the narrower one."""
    out, kinds = np.zeros(len(i), np.int64), width[i] * (1 << 20) + width[j]
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        wide = [int(kind) >> 20, int(kind) & ((1 << 20) - 1)]
        for part in np.array_split(at, 1 + len(at) * max(wide) // (1 << 20)):
            x, y = (np.bitwise_xor.reduce(flat[start[r[part]][:, None] + np.arange(w)].reshape(len(part), w // min(wide), min(wide)), axis=1) for r, w in zip((i, j), wide))
            out[part] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.view(np.int64)))


def frequent_shingles(docs: DataFrame, size: int, sample: int = 5000, most: int = 100_000) -> np.ndarray:
    """Shingles of at least three of about ``sample`` texts, sorted; the ``most`` frequent ones."""
    every = max(1, docs.count() // sample)

    def compute(batches):
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(batch.column(0), size, np.zeros(0, np.uint64))[0].view(np.int64))], names=["shingle"])

    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select(F.coalesce("text", F.lit("")).alias("text"))
    counts = some.mapInArrow(compute, "shingle long").groupBy("shingle").count().filter("count > 2")
    rows = counts.orderBy(F.desc("count"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(rows["shingle"].to_numpy().view(np.uint64))


def prefixes(docs: DataFrame, size: int, threshold: float, frequent: np.ndarray) -> DataFrame:
    """Row keys and doc_id of ``docs``; node (a digest of the set), fp (the fingerprint), n, sketch, first (the shingles at which near copies meet)."""

    def compute(batches):
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                every = shingle_hashes(batch.column(3), size)
                fp = majority(*every)
                hashes, n = sets_of(*every, frequent)
                start = np.cumsum(n) - n
                node = np.array([xxhash.xxh64_intdigest(hashes[a : a + k].tobytes(), 42) for a, k in zip(start.tolist(), n.tolist())], np.uint64)
                m = np.where(n > 0, n - np.ceil(threshold * n - EPS).astype(np.int64) + 1, 0)
                first = hashes[np.arange(len(hashes)) - np.repeat(start, n) < np.repeat(m, n)]
                sketch = lists(*sketches(hashes, n))
                columns = [node.view(np.int64), fp.view(np.int64), n.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, columns), sketch, lists(first, m)], names=["k1", "k2", "doc_id", "node", "fp", "n", "sketch", "first"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(*row_keys(), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(compute, f"k1 long, k2 long, doc_id {kind}, node long, fp long, n int, sketch array<long>, first array<long>")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, cut between its values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        other = np.flatnonzero(key != key[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut or (held and held[-1].column(0)[-1].as_py() != key[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def candidates(batches: Iterator[pa.RecordBatch], threshold: float, rest: bool) -> Iterator[pa.RecordBatch]:
    """From rows (shingle, node, n, sketch, root) sorted by shingle: pairs u, v that may be near copies.

    Groups of at most ``SMALL`` rows: all such pairs. Larger groups: enough of them to connect what all of them connect, and with
    ``rest`` only these groups' pairs whose roots differ.
    """
    share = (1 - threshold) / (1 + threshold)

    def may(n, sketch, i, j):
        out = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - EPS
        at = np.flatnonzero(out)
        i, j = np.broadcast_to(i, out.shape)[at], j[at]
        out[at] = differing(*sketch, i, j) <= share * (n[i] + n[j]) + EPS
        return out

    def pairs(u, v):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    for t in whole_groups(batches):
        shingle, node, n, root = (t[c].to_numpy() for c in ("shingle", "node", "n", "root"))
        n = n.astype(np.int64)
        sketch = t["sketch"].combine_chunks()
        width = pc.list_value_length(sketch).to_numpy().astype(np.int64)
        x = (sketch.flatten().to_numpy().view(np.uint64), np.cumsum(width) - width, width)
        begin = np.concatenate([[0], np.flatnonzero(shingle[1:] != shingle[:-1]) + 1])
        size = np.diff(np.concatenate([begin, [len(n)]]))
        small = np.repeat(size <= SMALL, size)
        for lag in range(1, 0 if rest else min(SMALL, len(n))):
            i = np.flatnonzero((shingle[lag:] == shingle[:-lag]) & small[lag:])
            i = i[may(n, x, i, i + lag)]
            if len(i):
                yield pairs(node[i], node[i + lag])
        for a, k in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist()):
            if rest:
                for i in range(a, a + k - 1):
                    j = np.arange(i + 1, a + k)
                    j = j[root[j] != root[i]]
                    j = j[may(n, x, i, j)]
                    if len(j):
                        yield pairs(np.full(len(j), node[i]), node[j])
                continue
            left, found = np.arange(a, a + k), []
            while len(left):
                stack, left = [int(left[0])], left[1:]
                while stack and len(left):
                    i = stack.pop()
                    hit = may(n, x, i, left)
                    found.append((np.full(int(hit.sum()), node[i]), node[left[hit]]))
                    stack += left[hit].tolist()
                    left = left[~hit]
            if found:
                yield pairs(*(np.concatenate(c) for c in zip(*found)))


def near_copies(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """k1, k2, doc_id of each row of ``docs`` (see ``row_keys``) and root: equal for rows that chains of near copies connect.

    Shingles: ``size`` words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as sets; fewer words are one shingle; texts without
    words are copies of each other.
    """
    spark, used = docs.sparkSession, []

    def kept(df: DataFrame, name: str) -> DataFrame:
        """``df`` written; it goes when the groups are."""
        out, path = write(df, name)
        used.append(path)
        return out

    parts, frequent = partitions(spark), frequent_shingles(docs, size)
    rows = kept(prefixes(docs, size, threshold, frequent), "shingles")
    nodes = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("first").alias("first"))
    entries = nodes.select(F.explode("first").alias("shingle"), "node").repartition(parts, "shingle").sortWithinPartitions("shingle")
    met, path = write(entries.mapInArrow(lambda b: repeated(b, 1, [0, 1]), "shingle long, node long"), "met")
    known = rows.select("node", "n", "sketch").dropDuplicates(["node"])
    shared = kept(met.join(known, "node").select("shingle", "node", "n", "sketch"), "shared")
    remove(spark, path)

    def compared(entries: DataFrame, rest: bool) -> DataFrame:
        entries = entries.select("shingle", "node", "n", "sketch", "root").repartition(parts, "shingle").sortWithinPartitions("shingle")
        return kept(entries.mapInArrow(lambda b: candidates(b, threshold, rest), "u long, v long").distinct(), "pairs")

    def sets(pairs: DataFrame) -> DataFrame:
        def compute(batches):
            for whole in batches:
                for batch in slices(whole, most=SLICE):
                    yield pa.RecordBatch.from_arrays([batch.column(0), lists(*shingle_sets(batch.column(1), size, frequent))], names=["node", "shingles"])

        asked = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        one = rows.join(asked, "node", "left_semi").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("k")).select("node", "k.*")
        texts = docs.select(*row_keys(), F.coalesce("text", F.lit("")).alias("text")).join(one, ["k1", "k2"]).select("node", "text")
        return kept(texts.mapInArrow(compute, "node long, shingles array<long>").dropDuplicates(["node"]), "sets")

    def verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
        both = pairs.join(found.select(F.col("node").alias("u"), F.col("shingles").alias("x")), "u").join(found.select(F.col("node").alias("v"), F.col("shingles").alias("y")), "v")
        both = both.select("u", "v", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("common"))
        return kept(both.filter(F.col("common") >= threshold * (F.col("n") - F.col("common")) - EPS).select("u", "v"), "links")

    # texts with equal fingerprints, each with one of them, and the index's links
    first = rows.select("node", "fp").distinct().groupBy("fp").agg(F.min("node").alias("least"))
    equal = rows.select("node", "fp").distinct().join(first, "fp").select(F.col("node").alias("u"), F.col("least").alias("v")).filter("u <> v")
    near = fingerprint_links(first.select("fp"))
    near = near.join(first.select(F.col("fp").alias("u"), F.col("least").alias("x")), "u").join(first.select(F.col("fp").alias("v"), F.col("least").alias("y")), "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
    by_fingerprint = equal.unionByName(near).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    pairs = kept(compared(shared.withColumn("root", F.col("node")), False).unionByName(by_fingerprint).distinct(), "pairs")
    found = sets(pairs)  # of all texts that any pair can have: a text that may pair up in a large group is in a pair already
    links = verified(pairs, found)
    roots = components(links)
    large = shared.groupBy("shingle").count().filter(F.col("count") > SMALL).select("shingle")
    entries = shared.join(large, "shingle", "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    more = compared(entries, True)
    if not more.isEmpty():
        roots = components(links.unionByName(verified(more, found)))
    grouped = rows.select("k1", "k2", "doc_id", "node").join(roots, "node", "left").select("k1", "k2", "doc_id", F.coalesce("root", "node").alias("root"))
    out = written(grouped, "groups")
    for path in used:  # shingles and sketches are larger than the texts' own groups
        remove(spark, path)
    return out
