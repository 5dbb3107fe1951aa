"""Encoding of texts by way of their distinct white-space words.

The tokenizer of ``word_bpe_49k.json`` drops white space before it splits a text, so the ids of a text are the ids of its
words one after another. Words go to the tokenizers library as Arrow arrays of distinct words; ids come back as two numpy
arrays: how many ids each word has, and all ids one after another.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from crosslink.llm.common import ranges, words_of

#: ASCII marks that can follow a word of letters and are then pieces of their own.
MARKS = ".,;:!?|"
#: Letters that stay letters, one for one, when the tokenizer composes and lower-cases: Latin without the dotted capital I, Greek, Cyrillic. A word with any other letter goes to the library whole, its marks with it.
LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{388}-\x{38A}\x{38E}-\x{3A1}\x{3A3}-\x{3CE}\x{400}-\x{481}\x{48A}-\x{52F}]+$"
AT_ONCE = 256
GROUP = 64


class Words:
    """Distinct words and their ids: ``n`` ids each, ``ids`` one after another."""

    def __init__(self, words: pa.Array, n: np.ndarray, ids: np.ndarray):
        self.words, self.n, self.ids = words, n, ids

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids the words at these places have, and these ids."""
        first, n = np.cumsum(self.n, dtype=np.int64) - self.n, self.n[at]
        return n, self.ids[ranges(first[at], n)]


def tails(words: pa.Array, lengths: np.ndarray) -> pa.Array:
    """The last ``lengths`` bytes of each word."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    cut = data[ranges(offsets[1:].astype(np.int64) - lengths, lengths)]
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(cut)))


class WordEncoder:
    """``cache_words``: so many words are kept; when they are more, only those of the present slice stay."""

    def __init__(self, path: str, cache_words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.most, self.known = cache_words, Words(pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts, ids = [], []
        for i in range(0, len(texts), AT_ONCE):  # the library's own results are large
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)]
            counts += map(len, found)
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int32, sum(map(len, found))))
        return np.array(counts, np.int64), np.concatenate(ids) if ids else np.zeros(0, np.int32)

    def _letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of ``LETTERS`` only: each is one piece of the tokenizer's pattern, so it ends at its only id with the mark of a word's end."""
        cuts = np.minimum(np.arange(0, len(words) + GROUP, GROUP), len(words)).astype(np.int32)
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " ").to_pylist() if len(words) else []
        n, ids = self._plain(groups)
        ends = np.flatnonzero(self.ends[ids]) + 1
        of = np.searchsorted(np.cumsum(n), ends, side="left")
        if np.array_equal(np.bincount(of, minlength=len(groups)), np.diff(cuts)[: len(groups)]):
            return np.diff(ends, prepend=0), ids
        return self._plain(words.to_pylist())

    def encode_words(self, words: pa.Array) -> Words:
        """Each of the words (distinct, not null) by the library, none from the cache."""
        letters = pc.match_substring_regex(words, LETTERS)
        parts, order = [], []
        for mask, encode in ((letters, self._letters), (pc.invert(letters), lambda w: self._plain(w.to_pylist()))):
            parts.append(encode(words.filter(mask)))
            order.append(np.flatnonzero(mask.to_numpy(zero_copy_only=False)))
        place = np.empty(len(words), np.int64)
        place[np.concatenate(order)] = np.arange(len(words))
        n, ids = Words(words, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])).take(place)
        return Words(words, n, ids)

    def units(self, words: pa.Array) -> Words:
        """As ``encode_words``, with words from the cache, which the others join."""
        at = pc.index_in(words, value_set=self.known.words)
        new = words.filter(at.is_null())
        if not len(new):
            return Words(words, *self.known.take(at.to_numpy()))
        fresh = self.encode_words(new)
        both = Words(pa.concat_arrays([self.known.words, new]), np.concatenate([self.known.n, fresh.n]), np.concatenate([self.known.ids, fresh.ids]))
        place = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        place[at.is_null().to_numpy(zero_copy_only=False)] = np.arange(len(self.known.words), len(both.words))
        found = Words(words, *both.take(place))
        self.known = both if len(both.words) <= self.most else found
        return found

    def of_words(self, words: pa.Array, lookup=None) -> Words:
        """Ids of distinct words; marks after a word of letters are looked up apart, so that a word is one with and without them."""
        core = pc.utf8_rtrim(words, MARKS)
        lengths = pc.binary_length(words).to_numpy().astype(np.int64) - pc.binary_length(core).to_numpy()
        apart = pc.and_(pc.match_substring_regex(core, LETTERS), pa.array(lengths > 0))
        split = apart.to_numpy(zero_copy_only=False)
        first = pc.if_else(apart, core, words)
        last = tails(words, np.where(split, lengths, 0))
        coded = pa.concat_arrays([first, last]).dictionary_encode()
        found = (lookup or self.units)(coded.dictionary)
        both = coded.indices.to_numpy().reshape(2, -1).T.ravel()
        n, ids = found.take(both)
        return Words(words, n.reshape(-1, 2).sum(axis=1), ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids of all texts one after another."""
        words, starts = words_of(texts)
        coded = words.dictionary_encode()
        each, ids = self.of_words(coded.dictionary).take(coded.indices.to_numpy())
        upto = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        return np.diff(upto[starts]), ids


@functools.lru_cache(1)
def worker_encoder(path: str) -> WordEncoder:
    """The one encoder of a Python worker, so that its tokenizer and cache serve all its tasks."""
    return WordEncoder(path)
