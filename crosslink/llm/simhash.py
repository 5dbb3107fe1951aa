"""SimHash fingerprints and their links, found in a hierarchical index in Gray order.

Dealing: two fingerprints that differ in at most ``DIFFER`` bits agree on one of four masks of 16 bits, so fingerprints that
agree there meet in a group. Groups with many fingerprints get four children each, with masks that fix 12, 9, 7, ... more bits,
until a group can't hold more than it may.

Index of a group: its fingerprints stand in Gray order, ``FAN`` neighbours make a node, ``FAN`` nodes one of the next level, up to
the root. The bits that all fingerprints below a node share are factored into it, those that a node above has excepted. A search
goes down all levels at once and adds up the differences to the patterns on the way; a node with more than ``DIFFER`` is passed
over with all below it, as is a node whose fingerprints are all in the searching one's component already.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslink.llm.common import one_row_of_each, partitions, row_keys, slices, words_of, written
from crosslink.llm.components import components

DIFFER = 3
FAN = 8
STEP = 512
SMALL = 16
SLICE = 2 << 20


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each shingle, and how many each text has; words lower-cased in A-Z."""
    words, starts = words_of(pc.ascii_lower(texts))
    n = np.diff(starts)
    ends = np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 1)
    begins = np.concatenate([[0], ends[:-1]])
    per_text = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    first = np.repeat(starts[:-1] - (np.cumsum(per_text) - per_text), per_text) + np.arange(per_text.sum())
    last = np.minimum(first + size, np.repeat(starts[1:], per_text)) - 1
    data = " ".join(words.to_pylist()).encode()
    digest = functools.partial(xxhash.xxh64_intdigest, seed=42)
    cut = zip(begins[first].tolist(), (ends[last] - 1).tolist())
    return np.fromiter((digest(data[a:b]) for a, b in cut), np.uint64, len(first)), per_text


def majority(hashes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """A bit is 1 if it is set in over half the hashes of its text; no hashes: zero."""
    out = np.zeros((len(per_text), 64), np.uint8)
    some = np.flatnonzero(per_text)
    if len(some):
        bits = np.unpackbits(np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, (np.cumsum(per_text) - per_text)[some], axis=0, dtype=np.int32)
        out[some] = 2 * counts > per_text[some, None]
    return np.packbits(out, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """k1, k2 (see ``row_keys``), doc_id, fp (64 bits as a long) of every whole text; null and blank texts have fingerprint zero."""

    def compute(batches):
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                fp = majority(*shingle_hashes(batch.column(3), size))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp.view(np.int64))], names=["k1", "k2", "doc_id", "fp"])

    texts = docs.select(*row_keys(), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(compute, "k1 long, k2 long, doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Where a fingerprint stands when all are put in Gray order."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


#: Groups of more fingerprints than this go to their children; the last masks leave 14 bits free at most, so no group there has more.
MOST = 20_000


@functools.cache
def masks() -> tuple[tuple[int, ...], ...]:
    """By level: the masks of the groups; the children of mask i are 4 i to 4 i + 3 of the next level."""

    def cut(free: list[int]) -> list[list[int]]:
        return [[int(b) for b in x] for x in np.array_split(free, DIFFER + 1)]

    levels: list[list[list[int]]] = [cut(list(range(64)))]
    while min(map(len, levels[-1])) < 64 - 14:
        levels.append([bits + more for bits in levels[-1] for more in cut([b for b in range(64) if b not in bits])])
    signed = lambda bits: (m := sum(1 << b for b in bits)) - (1 << 64 if m >> 63 else 0)
    return tuple(tuple(signed(bits) for bits in level) for level in levels)


class GrayIndex:
    """x: fingerprints in Gray order. ``levels``, from the root down to the fingerprints: of each node the bits factored into it and their values."""

    def __init__(self, x: np.ndarray):
        self.x, ones, zeros, up = x, x, ~x, []
        while True:
            up.append((ones, zeros))
            if len(ones) == 1:
                break
            at = np.arange(0, len(ones), FAN)
            ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
        self.levels, above = [], np.zeros(1, np.uint64)
        for ones, zeros in reversed(up):
            shared = ones | zeros
            if self.levels:
                above = np.repeat(above, FAN)[: len(ones)]
            self.levels.append((shared & ~above, ones))
            above = shared
        self.pruned = self.met = 0

    def search(self, queries: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, fingerprint; numbers in x) that differ in at most ``DIFFER`` bits and have other labels."""
        least, largest = [label], [label]
        while len(least[-1]) > 1:
            at = np.arange(0, len(least[-1]), FAN)
            least.append(np.minimum.reduceat(least[-1], at))
            largest.append(np.maximum.reduceat(largest[-1], at))
        q, node, differ = queries, np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for depth, (mask, value) in enumerate(self.levels):
            if depth:
                q, differ = np.repeat(q, FAN), np.repeat(differ, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = node < len(mask)
                q, node, differ = q[inside], node[inside], differ[inside]
            differ = differ + np.bitwise_count((self.x[q] ^ value[node]) & mask[node])
            low, high = least[-1 - depth][node], largest[-1 - depth][node]
            go = (differ <= DIFFER) & ~((low == high) & (low == label[q]))
            self.met += len(go)
            self.pruned += int(len(go) - go.sum())
            q, node, differ = q[go], node[go], differ[go]
        return q, node


def links_in_node(x: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked within a group: x, fingerprints in Gray order; fewer links than fingerprints."""
    index, label, out = GrayIndex(x), np.arange(len(x)), []
    root = label.tolist()

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def join(u: np.ndarray, v: np.ndarray) -> None:
        for a, b in zip(u.tolist(), v.tolist()):
            i, j = find(a), find(b)
            if i != j:
                root[max(i, j)] = min(i, j)
                out.append((a, b))

    for lag in (1, 2, 4):  # what stands close together in Gray order
        i = np.flatnonzero(np.bitwise_count(x[lag:] ^ x[:-lag]) <= DIFFER)
        join(i, i + lag)
    changed = True
    for a in range(0, len(x), STEP):
        label = np.array([find(i) for i in range(len(x))]) if changed else label
        u, v = index.search(np.arange(a, min(len(x), a + STEP)), label)
        _, one = np.unique(label[u] * len(x) + label[v], return_index=True)  # one pair for each two components
        changed = len(one) > 0
        join(u[one], v[one])
    return out


def links_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (mask, pattern, fp) sorted by node and Gray rank: links u, v."""

    def links(mask, pattern, fp):
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]])
        size, node = end - begin, np.repeat(np.arange(len(begin)), end - begin)
        linked = np.zeros(len(begin), bool)
        for lag in range(1, min(SMALL, len(fp))):
            hit = (node[lag:] == node[:-lag]) & (np.bitwise_count(fp[lag:] ^ fp[:-lag]) <= DIFFER)
            linked[node[lag:][hit]] = True
        found = []
        for i in np.flatnonzero(linked | (size > SMALL)):
            x = fp[begin[i] : end[i]]
            found += [(x[u], x[v]) for u, v in links_in_node(x)]
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    held: list[list[np.ndarray]] = []  # rows of a node that may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
        last = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held and (held[-1][0][-1], held[-1][1][-1]) != (columns[0][0], columns[1][0]):
            yield links(*(np.concatenate(c) for c in zip(*held)))
            held = []
        if cut:
            yield links(*(np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns])))
            held = []
        held.append([c[cut:] for c in columns])
    if held:
        yield links(*(np.concatenate(c) for c in zip(*held)))


def fingerprint_links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """distinct (fp) -> u, v: enough links of at most ``DIFFER`` bits to connect all fingerprints that links connect.

    Groups of more than ``most`` fingerprints go to their children, down to the last masks, which fix 50 bits at least.
    """
    found, entries = None, distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("mask"))
    for level, values in enumerate(masks()):
        of = F.element_at(F.array(*[F.lit(m) for m in values]), F.col("mask") + 1)
        nodes = entries.select("mask", F.col("fp").bitwiseAND(of).alias("pattern"), "fp")
        large = None
        if level + 1 < len(masks()):
            sizes = nodes.groupBy("mask", "pattern").count().filter(F.col("count") > most)
            large = written(sizes.select("mask", "pattern"), "large-nodes")
            large = None if large.isEmpty() else large
        these = nodes if large is None else nodes.join(large, ["mask", "pattern"], "left_anti")
        these = these.repartition(partitions(distinct.sparkSession), "mask", "pattern").sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")))
        links = these.mapInArrow(links_of_sorted, "u long, v long")
        found = links if found is None else found.unionByName(links)
        if large is None:
            break
        entries = nodes.join(large, ["mask", "pattern"], "left_semi").select("fp", F.explode(F.sequence(F.col("mask") * 4, F.col("mask") * 4 + 3)).alias("mask"))
    return found


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links of at most three bits reach.

    Fingerprints: shingles of ``size`` words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, repeats included; fewer words are
    one shingle; null and blank texts have fingerprint zero, which is linked like any other. Rows with the same doc_id or
    text stay separate rows; null ids are never a component's id unless it has no other. Other columns are left out.
    """
    classes = classified(docs, size)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def classified(docs: DataFrame, size: int) -> DataFrame:
    """k1, k2, doc_id, fp, root (a fingerprint of the component) and component_id of each row of ``docs``."""
    prints = written(fingerprints(docs, size), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(distinct.select("fp")))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(grouped.join(ids, "root").select("fp", "root", "component_id"), "fp")


def one_of_each(docs: DataFrame, size: int = 3, similarity: float | None = None) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id, unchanged; rows without id stay only where no other row of the group has one.

    Without ``similarity`` groups are the components of ``near_duplicates``. With it they are what chains of texts connect whose sets
    of shingles have that Jaccard similarity or more: the index's links are then counted out, and near copies whose fingerprints
    differ in more bits are found by their shingles, exactly (see ``near_copies``). Texts without words are one group. Columns of
    any name are kept; an empty table gives no rows.
    """
    if similarity is None:
        return one_row_of_each(docs, classified(docs, size))
    from crosslink.llm.near_copies import near_copies

    return one_row_of_each(docs, near_copies(docs, size, similarity))
