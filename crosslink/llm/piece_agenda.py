"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of adjacent pairs in order of score.

A text is a row of symbols, at first its characters. The agenda holds all adjacent pairs whose joined text is a piece; the pair of
the highest score, the leftmost of equals, is joined, and the pairs with its new neighbours enter the agenda, until it is empty.
No pair is ever joined over two characters that stand side by side in no piece, so texts are cut there first, the distinct cuts of
an Arrow batch go through the agenda once, and their ids are put together by position.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.llm.common import mapped, plain_strings, ranges, slices

SPACE = 0x2581
#: Cuts of up to so many characters go through the agenda side by side, longer ones one by one.
SHORT = 40
#: Pairs of characters below this number are looked up in a square table.
DENSE = 0x250
#: Texts are encoded in slices of about this many bytes.
SLICE = 8 << 20
#: Fixed values of the model file: field numbers of pieces, their text, score and kind, and of the trainer's and normalizer's settings.
NORMAL, UNKNOWN, CONTROL, BYTE, MERGE_TYPE = 1, 2, 3, 6, 2
NONE = np.iinfo(np.int32).max


def message(data: bytes) -> dict[int, list]:
    """Field number -> values of a protocol buffer message."""
    found: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else 4 if kind == 5 else 8
            value = data[at : at + size]
            at += size
        found.setdefault(key >> 3, []).append(value)
    return found


class Agenda:
    """A merge-type vocabulary: pieces, and the pairs of symbols that join to a piece.

    Symbols are piece ids; characters that stand in pieces but are none themselves follow them. A vocabulary of another type,
    with user-defined or unused pieces, with a normalizer other than identity or without byte fallback raises ValueError.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = message(file.read())
        trainer, rules = message(model[2][0]), message(model[3][0])
        parts = [message(p) for p in model[1]]
        self.kinds = np.array([p.get(3, [NORMAL])[0] for p in parts])
        fits = trainer.get(3, [1])[0] == MERGE_TYPE and trainer.get(35, [0])[0] and rules.get(1, [b""])[0] == b"identity" and not rules.get(2, [b""])[0]
        fits = fits and rules.get(3, [1])[0] and not rules.get(4, [1])[0] and rules.get(5, [1])[0] and not trainer.get(24, [0])[0]
        if not fits or not set(self.kinds.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path} is no merge-type vocabulary with byte fallback and identity normalizer")
        self.pieces = [p[1][0].decode() for p in parts]
        self.unknown = trainer.get(44, [b" \xe2\x81\x87 "])[0]
        self.size = len(parts)
        self.symbols = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        for char in sorted({c for p in self.symbols for c in p}):
            self.symbols.setdefault(char, len(self.symbols) + self.size)
        order = np.unique([-np.frombuffer(p[2][0], "<f4")[0] if 2 in p else 0.0 for p in parts], return_inverse=True)[1]
        pairs = {}
        for piece, i in self.symbols.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = int(order[i]), i
        self.pairs = pairs
        self._hash(pairs)
        self._characters()
        self.bytes = np.zeros(256, np.int32)
        for i in np.flatnonzero(self.kinds == BYTE).tolist():
            self.bytes[int(self.pieces[i][1:-1], 16)] = i

    def _hash(self, pairs: dict) -> None:
        """The pairs by the top bits of a product, each in the first free of the places from there on."""
        self.bits = max(4, len(pairs).bit_length() + 2)
        size = 1 << self.bits
        self.keys, self.found = np.full(size, -1, np.int64), np.full((size, 2), NONE, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, place in zip(keys.tolist(), self._place(keys).tolist()):
            while self.keys[place] != -1:
                place = (place + 1) % size
            self.keys[place], self.found[place] = key, pairs[key]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def joins(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order (NONE if they don't join) and piece of each pair of symbols."""
        keys = left.astype(np.int64) << 32 | right
        place = self._place(keys)
        open_ = np.flatnonzero((self.keys[place] != keys) & (self.keys[place] != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) % len(self.keys)
            now = self.keys[place[open_]]
            open_ = open_[(now != keys[open_]) & (now != -1)]
        found = self.found[place]
        return found[:, 0], found[:, 1]

    def _characters(self) -> None:
        """Symbols of characters, and the pairs of characters that stand side by side in a piece."""
        singles = sorted((ord(c), i) for c, i in self.symbols.items() if len(c) == 1)
        self.chars, self.of_chars = np.array([c for c, _ in singles], np.uint32), np.array([i for _, i in singles], np.int32)
        beside = {(ord(a), ord(b)) for p in self.symbols for a, b in zip(p, p[1:])}
        low = lambda c: 0 if c == SPACE else c  # noqa: E731  the space takes NUL's place; NUL stands in no pair
        if any(0 in pair for pair in beside):
            raise ValueError("a piece with a NUL")
        self.square = np.zeros((DENSE, DENSE), bool)
        far = []
        for a, b in beside:
            if low(a) < DENSE and low(b) < DENSE:
                self.square[low(a), low(b)] = True
            else:
                far.append(a << 32 | b)
        self.square, self.far = self.square.ravel(), np.array(sorted(far), np.int64)

    def cuts(self, chars: np.ndarray) -> np.ndarray:
        """For each character whether no piece holds it together with the one before."""
        out = np.ones(len(chars), bool)
        if len(chars) < 2:
            return out
        low = np.where(chars == SPACE, 0, np.where(chars == 0, DENSE, chars)).astype(np.int32)
        near = low < DENSE
        both = near[1:] & near[:-1]
        low[~near] = 0
        out[1:] = ~(self.square[low[:-1] * DENSE + low[1:]] & both)
        rest = np.flatnonzero(~both)
        if len(rest) and len(self.far):
            keys = chars[rest].astype(np.int64) << 32 | chars[rest + 1]
            at = np.minimum(np.searchsorted(self.far, keys), len(self.far) - 1)
            out[rest + 1] = self.far[at] != keys
        return out

    def one(self, symbols: list[int]) -> list[int]:
        """A row of symbols through a heap of pairs: by order, then by place of the left one."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def enter(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (found := self.pairs.get(symbols[left] << 32 | symbols[right])):
                heapq.heappush(heap, (found[0], left, right, symbols[left] << 32 | symbols[right], found[1]))

        for i in range(n - 1):
            enter(i, i + 1)
        while heap:
            _, left, right, key, piece = heapq.heappop(heap)
            if symbols[left] < 0 or symbols[right] < 0 or symbols[left] << 32 | symbols[right] != key:
                continue
            symbols[left], symbols[right] = piece, -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            enter(before[left], left)
            enter(left, after[left])
        return [s for s in symbols if s >= 0]

    def many(self, symbols: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``n`` symbols each, side by side: in a round each row joins its best pair -> symbols, and how many each row has."""
        done_rows, done = [], []
        own = np.repeat(np.arange(len(n), dtype=np.int32), n)
        order, piece = self._adjacent(symbols, own)
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            sizes = np.diff(np.append(first, len(own)))
            best = np.minimum.reduceat(order, first)
            ended = np.repeat(best == NONE, sizes)
            if ended.any():
                done_rows.append(own[ended])
                done.append(symbols[ended])
                stay = ~ended
                symbols, own, order, piece = symbols[stay], own[stay], order[stay], piece[stay]
                sizes, best = sizes[best != NONE], best[best != NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(order == np.repeat(best, sizes))
            at = at[np.concatenate([[True], own[at[1:]] != own[at[:-1]]])]
            symbols[at] = piece[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))  # a place for each row before goes
            symbols, own, order, piece = symbols[stay], own[stay], order[stay], piece[stay]
            changed = np.concatenate([at[at > 0] - 1, at])
            changed = changed[changed < len(symbols) - 1]
            order[at], piece[at] = NONE, NONE
            new = self.joins(symbols[changed], symbols[changed + 1])
            same = own[changed] == own[changed + 1]
            order[changed], piece[changed] = np.where(same, new[0], NONE), new[1]
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(n), np.int64)
        rows = np.concatenate(done_rows)
        return np.concatenate(done)[np.argsort(rows, kind="stable")], np.bincount(rows, minlength=len(n))

    def _adjacent(self, symbols: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order and piece of each symbol with the one behind it in its row."""
        order, piece = np.full(len(symbols), NONE, np.int32), np.full(len(symbols), NONE, np.int32)
        if len(symbols) > 1:
            same = own[1:] == own[:-1]
            found = self.joins(symbols[:-1], symbols[1:])
            order[:-1], piece[:-1] = np.where(same, found[0], NONE), found[1]
        return order, piece

    def ids_of(self, chars: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``n`` characters each -> how many ids each row has, and all ids."""
        at = np.minimum(np.searchsorted(self.chars, chars), len(self.chars) - 1)
        known = self.chars[at] == chars
        symbols = np.where(known, self.of_chars[at], -1 - chars.astype(np.int64)).astype(np.int32)
        out = [np.zeros(0, np.int32)] * 2
        counts = np.zeros(len(n), np.int64)
        first, long_ = np.cumsum(n) - n, np.flatnonzero(n > SHORT)
        short = np.flatnonzero(n <= SHORT)
        out[0], counts[short] = self.many(symbols[ranges(first[short], n[short])], n[short])
        rows = [self.one(symbols[first[i] : first[i] + n[i]].tolist()) for i in long_.tolist()]
        counts[long_] = [len(r) for r in rows]
        out[1] = np.array([s for r in rows for s in r], np.int32)
        symbols = np.empty(int(counts.sum()), np.int32)
        starts = np.cumsum(counts) - counts
        symbols[ranges(starts[short], counts[short])], symbols[ranges(starts[long_], counts[long_])] = out
        return self._bytes(symbols, counts)

    def _bytes(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the ids of their UTF-8 bytes."""
        bare = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        if not len(bare):
            return counts, symbols
        names = {i: c for c, i in self.symbols.items() if i >= self.size}
        code = [(names[s] if s >= 0 else chr(-1 - s)).encode() for s in symbols[bare].tolist()]
        width = np.ones(len(symbols), np.int64)
        width[bare] = [len(c) for c in code]
        out = np.repeat(symbols, width)
        out[ranges((np.cumsum(width) - width)[bare], width[bare])] = self.bytes[np.frombuffer(b"".join(code), np.uint8)]
        upto = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(counts)])]
        return np.diff(upto), out

    def encode(self, texts: pa.Array, library=None) -> tuple[pa.ListArray, np.ndarray]:
        """The ids of each text, none for null and empty ones; and whether ``library``, if there is one, gives all its cuts the same ids."""
        texts = plain_strings(texts)
        n = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        led = pc.if_else(pa.array(n > 0), pc.binary_join_element_wise(" ", texts, ""), "")  # each text begins with a space of its own
        n += n > 0
        chars = np.frombuffer("".join(led.to_pylist()).encode("utf-32-le"), "<u4").copy()
        chars[chars == 32] = SPACE
        starts = np.cumsum(n) - n
        cut = self.cuts(chars)
        cut[starts[n > 0]] = True
        begins = np.flatnonzero(cut)
        ends = np.append(begins, len(chars)).astype(np.int32) * 4
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(chars)]).dictionary_encode()
        distinct = rows.dictionary.to_pylist()
        each, ids = self.ids_of(np.frombuffer(b"".join(distinct), "<u4"), pc.binary_length(rows.dictionary).to_numpy().astype(np.int64) // 4)
        code, first = rows.indices.to_numpy(), np.cumsum(each) - each
        count, row = each[code], np.searchsorted(begins, np.append(starts, len(chars)))
        upto = np.concatenate([[0], np.cumsum(count)])[row]
        same = np.ones(len(texts), bool)
        if library:
            other = np.concatenate([[0], np.cumsum(self.others(library, distinct, each, ids)[code])])[row]
            same = other[1:] == other[:-1]
        return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids[ranges(first[code], count)].astype(np.int32))), same

    def others(self, library, cuts: list[bytes], each: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether the library gives a cut other ids. Each goes to it behind a line break, which no piece of this vocabulary holds, so that its own leading space stays apart."""
        if any("\n" in p for p in self.symbols):
            raise ValueError("a piece with a line break: compare whole texts")
        want = library.encode(["\n" + c.decode("utf-32-le") for c in cuts], num_threads=1)
        n = np.fromiter(map(len, want), np.int64, len(want)) - 2
        flat = np.fromiter((i for w in want for i in w[2:]), np.int32, int(n.sum()))
        if np.array_equal(n, each) and np.array_equal(flat, ids):
            return np.zeros(len(cuts), bool)
        upto = np.cumsum(each)
        return np.array([w[2:] != ids[b - k : b].tolist() for w, b, k in zip(want, upto.tolist(), each.tolist())])

    @functools.cached_property
    def surfaces(self) -> pa.Array:
        """What each id adds to a decoded text, as bytes; then the same for ids that begin a text."""
        of = {BYTE: lambda p: bytes([int(p[1:-1], 16)]), CONTROL: lambda p: b"", UNKNOWN: lambda p: self.unknown, NORMAL: lambda p: p.replace(chr(SPACE), " ").encode()}
        found = [of[k](p) for k, p in zip(self.kinds.tolist(), self.pieces)]
        return pa.array(found + [x.removeprefix(b" ") for x in found], pa.binary())

    @functools.cached_property
    def spaced(self) -> np.ndarray:
        return np.array([k == NORMAL and p[0] == chr(SPACE) for k, p in zip(self.kinds.tolist(), self.pieces)])

    def decode(self, lists: pa.Array) -> pa.StringArray:
        """The text of each list of ids: spaces for their marks, but not the first one; bytes that are no UTF-8 become U+FFFD, one for each."""
        lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
        ids, n = pc.fill_null(lists.flatten(), -1).to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)
        good = (ids >= 0) & (ids < self.size)
        if not good.all():  # ids outside the vocabulary and null ids are left out
            n = np.diff(np.concatenate([[0], np.cumsum(good)])[np.concatenate([[0], np.cumsum(n)])])
            ids = ids[good]
        upto = np.concatenate([[0], np.cumsum(n)])
        said = np.append(np.flatnonzero(self.kinds[ids] != CONTROL), len(ids))
        first = said[np.searchsorted(said, upto[:-1])]
        led = first < upto[1:]
        led[led] = self.spaced[ids[first[led]]]
        place = ids.copy()
        place[first[led]] += self.size
        try:
            if len(said) <= len(ids):
                raise ValueError("a control id ends a run of bytes")
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), self.surfaces.take(pa.array(place))), b"").cast(pa.string())
        except ValueError:  # ids that no text has
            bounds, data = np.union1d(upto, np.flatnonzero(self.kinds[ids] == CONTROL)), self.surfaces.take(pa.array(place)).to_pylist()
            runs = [self._readable(b"".join(data[a:b])) for a, b in zip(bounds, bounds[1:])]
            row = np.searchsorted(bounds, upto)
            return pa.array(["".join(runs[a:b]) for a, b in zip(row, row[1:])], pa.string())

    @staticmethod
    def _readable(data: bytes) -> str:
        out, at = [], 0
        while at < len(data):
            try:
                out.append(data[at:].decode())
                break
            except UnicodeDecodeError as e:
                out.append(data[at : at + e.start].decode() + "�")
                at += e.start + 1
        return "".join(out)


@functools.lru_cache(1)
def worker_agenda(path: str) -> Agenda:
    return Agenda(path)


@functools.lru_cache(1)
def library(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, at, SLICE)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with tokens, array<int>: the ids of the whole text, as the sentencepiece library gives them without begin and end ids.

    Null and empty texts have no ids; a text of blanks has. Rows are independent of each other, repeated or not; nothing is
    shuffled. A column called tokens is replaced, any other name is kept. An empty table gives no rows.
    """
    docs = docs.drop("tokens")
    at = docs.columns.index("text")

    def run(batches):
        for batch in _slices(batches, at):
            yield [*batch.columns, worker_agenda(model).encode(batch.column(at))[0]]

    return mapped(docs, run, {"tokens": T.ArrayType(T.IntegerType())})


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with decoded, string: the text of tokens as the library's decode gives it. Null and empty lists give an empty text; null ids and ids outside the vocabulary are left out. A column called decoded is replaced."""
    encoded = encoded.drop("decoded")
    at = encoded.columns.index("tokens")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                yield [*part.columns, worker_agenda(model).decode(part.column(at))]

    return mapped(encoded, run, {"decoded": T.StringType()})


def same_as_library(texts: pa.Array, lists: pa.ListArray, model: str) -> pa.Array:
    """Whether the library gives a batch's texts the same ids."""
    texts, values, ends = plain_strings(texts), lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    want = library(model).encode(texts.to_pylist(), num_threads=1)
    return pa.array([len(w) == b - a and np.array_equal(np.array(w, np.int32), values[a:b]) for w, a, b in zip(want, ends, ends[1:])], pa.bool_())


def checked(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (text and tokens among its columns) with agrees, boolean: the sentencepiece library gives the whole text the same ids. Null texts count as empty."""
    encoded = encoded.drop("agrees")
    text, at = encoded.columns.index("text"), encoded.columns.index("tokens")

    def run(batches):
        for batch in _slices(batches, text):
            tokens = pc.fill_null(batch.column(at), pa.scalar([], batch.column(at).type)) if batch.column(at).null_count else batch.column(at)
            yield [*batch.columns, same_as_library(batch.column(text), tokens, model)]

    return mapped(encoded, run, {"agrees": T.BooleanType()})


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 and agrees of every document.

    ``encode`` and ``decode`` follow each other within an Arrow batch, so that no ids leave it. agrees: the sentencepiece library
    gives each cut of the text the same ids; each distinct cut of a batch goes to it once, as whole texts (``checked``) take it
    four times as long as their encoding here.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        coder = worker_agenda(model)
        digits = pa.array([str(i) for i in range(coder.size)])
        hexes = lambda texts: pa.array([hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in texts], pa.string())
        for batch in _slices(batches, 1):
            tokens, same = coder.encode(batch.column(1), library(model))
            named = pa.ListArray.from_arrays(tokens.offsets, digits.take(tokens.values))
            n = pc.list_value_length(tokens).cast(pa.int64())
            yield [batch.column(0), n, hexes(pc.binary_join(named, ",")), hexes(coder.decode(tokens)), pa.array(same)]

    schema = T.StructType().add("doc_id", "long").add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("agrees", "boolean")
    names = schema.names
    return chosen.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays(columns, names=names) for columns in run(batches)), schema)
