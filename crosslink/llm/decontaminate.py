"""Benchmark passages in documents, found up to an edit distance.

An item of n characters may differ by k = floor(error x n) edits. It is cut into k + 1 pieces, of which one at least must
stand unchanged in any passage within that distance. An automaton finds the pieces of all items in one pass over a text;
around each hit Myers' bit-parallel distance decides. Items and texts are compared with A-Z in lower case and each run of
white space as one blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.llm.common import mapped, slices

#: Characters of items that go to the tasks at once; more items take more passes. An automaton takes some 52 bytes a character (103 MB for 2 million, measured), so a worker holds 0.4 GB at most.
ITEM_CHARS = 8_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").encode().lower().decode().split())  # bytes have lower case for A-Z alone


def distances(pattern: str, text: str) -> Iterator[int]:
    """For each prefix of ``text``: the least edit distance of ``pattern`` to a substring that ends there (Myers, bit-parallel)."""
    n = len(pattern)
    full, high = (1 << n) - 1, 1 << (n - 1)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    up, down, score = full, 0, n
    for c in text:
        eq = equal.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(across | up)), up & across
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(vertical | plus)), plus & vertical
        yield score


def best_place(pattern: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the substring nearest to ``pattern``; of equals the first end, then the latest start."""
    at = text.find(pattern)
    if at >= 0:
        return 0, at, at + len(pattern)
    best, end = min(((d, i) for i, d in enumerate(distances(pattern, text), 1)), default=(most + 1, 0))
    if best > most:
        return None
    # the end is fixed, so that the distance is to a prefix of what stands before it, read backwards
    back = text[max(0, end - len(pattern) - most) : end][::-1]
    row = list(range(len(back) + 1))
    for i, p in enumerate(reversed(pattern), 1):
        last, row[0] = row[0], i
        for j, c in enumerate(back, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    return best, end - row.index(best), end


@dataclass
class Matcher:
    """items: (number, normal text), texts not empty. Finds which of them stand in a text."""

    items: list[tuple[int, str]]
    error: float
    automaton: object = field(default=None, repr=False)

    def build(self) -> Matcher:
        import ahocorasick

        self.automaton, pieces = ahocorasick.Automaton(), {}
        for n, (_, text) in enumerate(self.items):
            k = self.budget(text)
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((n, a))
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()
        return self

    def budget(self, text: str) -> int:
        return min(int(self.error * len(text)), len(text) - 1)

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """item number, distance, start, end (in the normal text) of the best place of each item within its budget."""
        if not self.items:
            return []
        text, windows = normal(text), {}
        for end, (length, where) in self.automaton.iter(text):
            for n, offset in where:
                item = self.items[n][1]
                k, start = self.budget(item), end + 1 - length - offset
                spans, new = windows.setdefault(n, []), (max(0, start - k), start + len(item) + k)
                if spans and spans[-1][0] <= new[0] <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], new[1]))
                elif not spans or spans[-1] != new:
                    spans.append(new)
        out = []
        for n, spans in sorted(windows.items()):
            number, item = self.items[n]
            found = [(d, a + s, a + e) for a, b in merged(spans) if (hit := best_place(item, text[a:b], self.budget(item))) for d, s, e in [hit]]
            if found:
                out.append((number, *min(found)))
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_matchers: dict[int, Matcher] = {}


def _blocks(items: DataFrame, error: float) -> list[tuple[int, object]]:
    """Broadcasts of items, each of about ``ITEM_CHARS`` characters, with their numbers."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_CHARS)
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        kept = sorted({(r.item_id is None, r.item_id or 0, normal(r.text)) for r in part})
        shared = items.sparkSession.sparkContext.broadcast(([(None if none else i, t) for none, i, t in kept if t], error))
        yield shared._jbroadcast.id(), shared


def _matcher(key: int, shared) -> Matcher:
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(*shared.value).build()
    return _matchers[key]


def matches(docs: DataFrame, items: DataFrame, error: float = 0.05) -> DataFrame:
    """doc_id, item_id, distance, start, end: each item that stands in a document within its error budget, at its best place.

    start and end count characters of the document's normal text. Null and blank texts and items match nothing; items with
    the same id are items of their own; repeated documents give repeated rows. Items of fewer than 1 / ``error`` characters
    match only unchanged. Empty tables give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "item_id", "distance", "start", "end")])

    def find(key, shared):
        def run(batches):
            matcher = _matcher(key, shared)
            for whole in batches:
                rows = [(d, *m) for d, t in zip(whole.column(0).to_pylist(), whole.column(1).to_pylist()) for m in matcher.matches(t)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=schema.names)

        return texts.mapInArrow(run, schema)

    found = [find(*b) for b in _blocks(items, error)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def clean_documents(docs: DataFrame, items: DataFrame, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` in which no item stands, unchanged; nulls and empty tables as in ``matches``."""
    at = docs.columns.index("text")

    def without(docs, key, shared):
        def run(batches):
            matcher = _matcher(key, shared)
            for whole in batches:
                for batch in slices(whole, at):
                    yield batch.filter(pa.array([not matcher.matches(t) for t in batch.column(at).to_pylist()], pa.bool_())).columns

        return mapped(docs, run)

    for block in _blocks(items, error):
        docs = without(docs, *block)
    return docs
