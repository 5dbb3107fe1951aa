"""Toxicity: a linear classifier on character n-grams that are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crosslink.llm.common import held_out, mapped, slices
from crosslink.llm.labelled import labelled_sample

#: n-grams share 2^21 places, of which texts of the supplied kind fill some 300,000. Held out, 2^20 and 2^22 places give the same recall within 0.01.
BITS = 21
SIZES = (3, 4, 5)
GAP = "\0" * max(SIZES)
SLICE = 1 << 20
BLOCK = 256
#: A text of so many distinct n-grams takes its weights as they are.
TYPICAL = 2000.0


def ngram_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased texts, those that begin in a text: feature number and text number of each place."""
    lower = [f" {t.lower()} " for t in texts]
    points = np.frombuffer((GAP.join(lower) + GAP).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(lower), dtype=np.int32), [len(t) + len(GAP) for t in lower])
    n, hashes = len(points) - max(SIZES) + 1, []
    own = np.flatnonzero(np.tile([True, False], len(lower)).repeat([k for t in lower for k in (len(t), len(GAP))])[:n])
    run = points[:n]
    for k in range(1, max(SIZES)):
        run = run * np.uint64(0x9E3779B97F4A7C15) + points[k : k + n]
        if k + 1 in SIZES:
            mix = (run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
            hashes.append((mix >> np.uint64(64 - BITS)).astype(np.uint32)[own])
    return np.concatenate(hashes), np.tile(of[own], len(hashes))


def distinct(feature: np.ndarray) -> np.ndarray:
    """Each feature once: the last place that writes its own number into a table stands for it, so nothing is sorted."""
    stamp, places = _stamps(BITS), np.arange(len(feature), dtype=np.int32)
    stamp[feature] = places
    return feature[stamp[feature] == places]


@functools.lru_cache(1)
def _stamps(bits: int) -> np.ndarray:
    return np.zeros(1 << bits, np.int32)


def evened(n):
    """What each of a text's ``n`` distinct n-grams weighs: with more of them each says less, so that long texts are judged on the scale of short ones."""
    return np.sqrt(TYPICAL / np.maximum(n, 1))


@dataclass
class Model:
    """weights: of each hashed n-gram that a text holds, the naive Bayes ratio included; bias: log odds without any."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        found = [distinct(ngram_features([t])[0]) for t in texts]
        sums = np.array([self.weights[f].sum(dtype=np.float64) * evened(len(f)) for f in found])
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -500, 500)))


def fit(texts: list[bytes], labels: list[int], prior: float, rounds: int = 80, penalty: float = 100.0) -> Model:
    """Naive Bayes ratios from the counts of texts, then logistic regression on all n-grams seen, each scaled by its ratio.

    ``prior``: log odds of label 1 in all rows; it replaces the sample's. With one class only, every score is the prior's. No n-gram is
    left out; n-grams share 2^``BITS`` places.
    """
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), prior)
    counts, blocks = np.zeros((2, 1 << BITS), np.int32), []
    for a in range(0, len(texts), BLOCK):  # places and their numbers in each block of texts
        some = [distinct(ngram_features([t.decode()])[0]) for t in texts[a : a + BLOCK]]
        for found, label in zip(some, labels[a:]):
            counts[label, found] += 1
        blocks.append((np.concatenate(some), np.array([len(s) for s in some])))
    n = np.array([(y == 0).sum(), (y == 1).sum()])
    seen = np.flatnonzero(counts.any(axis=0))
    share = (counts[:, seen] + 0.5) / (n[:, None] + 1)
    scale = np.log(share[1] / share[0]).astype(np.float32)
    place = np.zeros(1 << BITS, np.int32)
    place[seen] = np.arange(len(seen), dtype=np.int32)
    blocks = [(place[column], sizes) for column, sizes in blocks]
    del counts, share, place
    # each class weighs the same here; penalised logistic regression by Nesterov's method
    weight = np.where(y == 1, 0.5 / n[1], 0.5 / n[0])
    rows = lambda k, sizes: np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # the largest curvature by the power method, for the step
    along, most = np.ones(len(seen) + 1), 1.0
    for _ in range(8):
        along /= np.sqrt((along**2).sum())
        image, scaled = np.zeros(len(seen) + 1), along[:-1] * scale
        for i, (c, z) in enumerate(blocks):
            r = rows(i, z)
            met = (np.bincount(r, scaled[c], len(z)) * evened(z) + along[-1]) * weight[i * BLOCK : i * BLOCK + len(z)]
            image[:-1] += np.bincount(c, (met * evened(z))[r], len(seen))
            image[-1] += met.sum()
        image[:-1] *= scale
        most, along = float((along * image).sum()), image
    step = 4 / (1.2 * most + penalty * 4e-4)
    w, ahead, bias, bias_ahead = np.zeros(len(seen)), np.zeros(len(seen)), 0.0, 0.0
    for k in range(rounds):
        gradient, bias_gradient, scaled = np.zeros(len(seen)), 0.0, ahead * scale
        for i, (c, z) in enumerate(blocks):
            r, at = rows(i, z), slice(i * BLOCK, i * BLOCK + len(z))
            p = 1 / (1 + np.exp(-np.clip(np.bincount(r, scaled[c], len(z)) * evened(z) + bias_ahead, -500, 500)))
            off = (p - y[at]) * weight[at]
            gradient += np.bincount(c, (off * evened(z))[r], len(seen))
            bias_gradient += off.sum()
        new, new_bias, speed = ahead - step * (gradient * scale + penalty * 1e-4 * ahead), bias_ahead - step * bias_gradient, k / (k + 3)
        ahead, bias_ahead = new + speed * (new - w), new_bias + speed * (new_bias - bias)
        w, bias = new, new_bias
    weights = np.zeros(1 << BITS, np.float32)
    weights[seen] = w * scale
    return Model(weights, bias + prior)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 3000, megabytes: int = 32) -> Model:
    """Learns from at most ``per_class`` labelled texts of each class, ``megabytes`` of text a class at most."""
    return fit(*labelled_sample(docs, labels, label, per_class, megabytes))


def score(docs: DataFrame, model: Model, threshold: float = 0.5, prefix: str = "") -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 from ``threshold`` on), which replace columns of these names; ``prefix`` goes before them.

    Whole texts are scored; a null or empty text gets the score of a text without n-grams but its ends. Rows are independent:
    equal texts have equal scores. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 8 MB, whatever the corpus
    value, new = f"{prefix}score", [f"{prefix}{c}" for c in ("held_out", "score", "predicted")]
    own = docs.select(*[f"`{c}`" for c in docs.columns if c not in new])
    at = own.columns.index("text")

    def compute(batches):
        for whole in batches:
            for batch in slices(whole, at, SLICE):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                yield [*batch.columns, pa.array(shared.value.scores(texts))]

    scored = mapped(own, compute, {value: T.DoubleType()})
    return scored.select(*[f"`{c}`" for c in own.columns], held_out().alias(new[0]), value, (F.col(value) >= threshold).cast("int").alias(new[2]))
