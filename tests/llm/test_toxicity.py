import zlib

import numpy as np
from pyspark.sql import functions as F

from crosslink.llm import toxicity as T
from crosslink.llm.queries import op10_toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and sum(r.predicted == r.toxic for r in held) / len(held) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxic_rows_are_caught(spark):
    """Held out, at the threshold: the labels of this table are partly random, so a share of the toxic rows can't be told; none else may be taken for toxic."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = T.score(docs, T.train(docs, labels)).join(labels, "doc_id").filter("held_out").select("predicted", "toxic", "score", F.length("text").alias("size")).collect()
    toxic = [r.predicted for r in rows if r.toxic]
    found = sum(toxic) / len(toxic)
    print("recall", found, "of", len(toxic), "precision", sum(toxic) / sum(r.predicted for r in rows))
    assert found >= 0.5 and sum(toxic) >= 0.98 * sum(r.predicted for r in rows)
    assert area(rows) >= 0.94
    sizes = [(0, 1000), (1000, 5000), (5000, 10000), (10000, 1 << 40)]
    assert all(area([r for r in rows if low <= r.size < high]) >= 0.88 for low, high in sizes)  # and by length: long texts too


def area(rows):
    """The share of pairs of a toxic and another row in which the toxic one has the higher score."""
    other = np.sort([r.score for r in rows if not r.toxic])
    toxic = np.array([r.score for r in rows if r.toxic])
    return float((np.searchsorted(other, toxic) + np.searchsorted(other, toxic, "right")).mean() / (2 * len(other)))


def places(text):
    """The places of a text's n-grams, one n-gram after another."""
    points, out = [ord(c) for c in f" {text.lower()} "] + [0] * 5, set()
    for i in range(len(points) - 5):
        run = points[i]
        for k in range(1, 5):
            run = (run * 0x9E3779B97F4A7C15 + points[i + k]) % (1 << 64)
            if k >= 2:
                mix = ((run ^ (run >> 29)) * (0xBF58476D1CE4E5B9 + 2 * k)) % (1 << 64)
                out.add(mix >> (64 - T.BITS))
    return out


def test_model_equals_plain_sum():
    r = np.random.default_rng(0)
    weights = (r.random(1 << T.BITS) * (r.random(1 << T.BITS) < 0.3)).astype(np.float32)
    model, texts = T.Model(weights, -1.0), ["", "aaa aaa", "Ünïcode İ \0 x", "word " * 50]
    together = model.scores(texts)
    for text, got in zip(texts, together):
        assert np.isclose(got, 1 / (1 + np.exp(1 - sum(float(weights[f]) for f in places(text)) * np.sqrt(T.TYPICAL / len(places(text))))), rtol=1e-4)


def test_all_ngrams_are_kept():
    """Each n-gram that tells the classes apart gets a weight, those of a single text too; the ratio scales it."""
    texts = [b"alpha beta", b"alpha gamma", b"alpha delta", b"alpha omega"]
    model = T.fit(texts, [0, 0, 1, 1], 0.0)
    single = places("delta") & places("alpha delta") - places("alpha beta") - places("alpha gamma") - places("alpha omega")
    assert single and all(model.weights[f] > 0 for f in single)
    assert [s > 0.5 for s in model.scores([t.decode() for t in texts])] == [False, False, True, True]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "s"), (None, "", "t"), (2, "x" * 30000, "u"), (2, "x" * 30000, "u")], "doc_id long, text string, score string")
    none = docs.filter("false")
    labels = spark.createDataFrame([(1, 1), (7, None), (None, 0)], "doc_id long, toxic int")
    model = T.train(docs, labels, per_class=5)
    got = T.score(docs, model)
    assert got.columns == ["doc_id", "text", "held_out", "score", "predicted"] and got.count() == 4
    assert T.score(none, T.train(none, labels.filter("false"))).count() == 0
    assert got.filter("doc_id is null").select("held_out").first()[0] is False
    assert got.filter("doc_id = 2").select(F.countDistinct("score")).first()[0] == 1
