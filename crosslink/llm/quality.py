"""Quality: a byte-level convolutional network in numpy over overlapping chunks of the whole text.

Each byte is embedded; learned filters run over every chunk and keep their largest response there; a small dense layer gives
each chunk a value, and the largest, the mean and the least value of a text's chunks make one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.llm.common import held_out, mapped, slices
from crosslink.llm.labelled import labelled_sample

CHUNK = 512
OVERLAP = 64
WIDTH = 6
STRIDE = 2
EMBED = 6
FILTERS = 32
HIDDEN = 16
PAD = 256
SLICE = 1 << 20


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of ``CHUNK`` bytes that overlap by ``OVERLAP`` and cover every byte, padded at the end; and each chunk's text."""
    step = CHUNK - OVERLAP
    count = np.array([1 + max(0, -(-(len(t) - CHUNK) // step)) for t in texts], np.int64)
    room = (count - 1) * step + CHUNK
    begin = np.cumsum(room) - room
    data = np.full(int(room.sum()), PAD, np.int16)
    for t, b in zip(texts, begin):
        data[b : b + len(t)] = np.frombuffer(t, np.uint8)
    of = np.repeat(np.arange(len(texts)), count)
    start = begin[of] + step * (np.arange(len(of)) - (np.cumsum(count) - count)[of])
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[start], of


@dataclass
class Net:
    embed: np.ndarray  # 257 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    offset: np.ndarray  # FILTERS
    dense: np.ndarray  # FILTERS x HIDDEN
    dense_offset: np.ndarray
    out: np.ndarray  # HIDDEN
    mix: np.ndarray  # weights of the largest, mean and least chunk value, and a constant
    prior: float = 0.0

    @staticmethod
    def new(seed: int = 7) -> Net:
        r = np.random.default_rng(seed)
        f = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        return Net(f(257, EMBED, scale=1), f(WIDTH * EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5), np.zeros(FILTERS, np.float32), f(FILTERS, HIDDEN, scale=FILTERS**-0.5), np.zeros(HIDDEN, np.float32), f(HIDDEN, scale=HIDDEN**-0.5), np.array([0.3, 0.4, 0.3, 0], np.float32))

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, and where it is; a chunk's padding takes part."""
        most, where = np.empty((len(chunks), FILTERS), np.float32), np.empty((len(chunks), FILTERS), np.int64)
        for a in range(0, len(chunks), 64):
            seen = self.embed[chunks[a : a + 64]].reshape(-1, CHUNK * EMBED)
            windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]
            response = (windows.reshape(-1, WIDTH * EMBED) @ self.filters).reshape(*windows.shape[:2], FILTERS)
            where[a : a + 64] = response.argmax(axis=1)
            most[a : a + 64] = np.take_along_axis(response, where[a : a + 64, None], 1)[:, 0]
        return np.maximum(most + self.offset, 0), where

    def values(self, chunks: np.ndarray) -> np.ndarray:
        most = np.empty((len(chunks), FILTERS), np.float32)
        for a in range(0, len(chunks), 64):
            seen = self.embed[chunks[a : a + 64]].reshape(-1, CHUNK * EMBED)
            windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]
            most[a : a + 64] = (windows.reshape(-1, WIDTH * EMBED) @ self.filters).reshape(*windows.shape[:2], FILTERS).max(axis=1)
        return np.tanh(np.maximum(most + self.offset, 0) @ self.dense + self.dense_offset) @ self.out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        chunks, of = chunks_of(texts)
        value, begin = self.values(chunks).astype(np.float64), np.flatnonzero(np.diff(of, prepend=-1))
        three = np.stack([np.maximum.reduceat(value, begin), np.add.reduceat(value, begin) / np.bincount(of), np.minimum.reduceat(value, begin)])
        return 1 / (1 + np.exp(-np.clip(self.mix[:3] @ three + self.mix[3] + self.prior, -500, 500)))

    def learn(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss over some texts."""
        chunks, of = chunks_of(texts)
        most, where = self.pooled(chunks)
        hidden = np.tanh(most @ self.dense + self.dense_offset)
        value, begin = hidden @ self.out, np.flatnonzero(np.diff(of, prepend=-1))
        n = np.bincount(of)
        top, low = np.maximum.reduceat(value, begin), np.minimum.reduceat(value, begin)
        three = np.stack([top, np.add.reduceat(value, begin) / n, low])
        p = 1 / (1 + np.exp(-np.clip(self.mix[:3] @ three + self.mix[3], -50, 50)))
        off = ((p - labels) * weight).astype(np.float32)
        to_value = off[of] * (self.mix[0] * (value == top[of]) + self.mix[1] / n[of] + self.mix[2] * (value == low[of]))
        to_hidden = (to_value[:, None] * self.out) * (1 - hidden**2)
        to_most = (to_hidden @ self.dense.T) * (most > 0)
        c, f = np.nonzero(to_most)
        amount = to_most[c, f]
        bytes_at = chunks[c[:, None], where[c, f][:, None] * STRIDE + np.arange(WIDTH)]
        seen = self.embed[bytes_at].reshape(len(c), -1)
        filters = np.zeros_like(self.filters)
        for k in range(FILTERS):
            filters[:, k] = amount[f == k] @ seen[f == k]
        to_embed = (amount[:, None] * self.filters.T[f]).reshape(-1, EMBED)
        embed = np.stack([np.bincount(bytes_at.ravel(), to_embed[:, j], 257) for j in range(EMBED)], axis=1)
        return {"embed": embed, "filters": filters, "offset": to_most.sum(axis=0), "dense": most.T @ to_hidden, "dense_offset": to_hidden.sum(axis=0), "out": hidden.T @ to_value, "mix": np.append(three @ off, off.sum())}


def fit(texts: list[bytes], labels: list[int], prior: float, epochs: int = 8, batch: int = 32, rate: float = 0.006) -> Net:
    """Adam on batches of whole texts, each class of the same weight; ``prior`` (log odds of label 1) goes into the scores."""
    net, y = Net.new(), np.array(labels, np.float32)
    net.prior = prior
    if len(set(labels)) < 2:
        net.mix[:] = 0
        return net
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean()).astype(np.float32)
    r, step, total = np.random.default_rng(11), 0, epochs * -(-len(y) // batch)
    first = {k: np.zeros_like(v) for k, v in vars(net).items() if k != "prior"}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    for _ in range(epochs):
        order = r.permutation(len(y))
        for a in range(0, len(y), batch):
            some, step = order[a : a + batch], step + 1
            now = rate * min(1, step / 20) * (1 - (step - 1) / total)
            for k, g in net.learn([texts[i] for i in some], y[some], weight[some] / len(some)).items():
                first[k] = 0.9 * first[k] + 0.1 * g.astype(np.float32)
                second[k] = 0.99 * second[k] + 0.01 * g.astype(np.float32) ** 2
                getattr(net, k)[...] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1500) -> Net:
    """Learns from at most ``per_class`` labelled whole texts of each class."""
    return fit(*labelled_sample(docs, labels, label, per_class))


def score(docs: DataFrame, net: Net, threshold: float = 0.3) -> DataFrame:
    """``docs`` with held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 from ``threshold`` on).

    They replace columns of these names. Whole texts are scored; null and empty texts get the score of one chunk of padding.
    Rows are independent: equal texts have equal scores. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some 20 KB
    own = docs.select(*[f"`{c}`" for c in docs.columns if c not in ("held_out", "score", "predicted")])
    at = own.columns.index("text")

    def compute(batches):
        for whole in batches:
            for batch in slices(whole, at, SLICE):
                texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
                yield [*batch.columns, pa.array(shared.value.scores(texts))]

    scored = mapped(own, compute, {"score": T.DoubleType()})
    return scored.select(*[f"`{c}`" for c in own.columns], held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
