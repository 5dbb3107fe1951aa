import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa

from crosslink.llm import near_copies as N
from crosslink.llm import simhash as S


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def groups(texts, threshold=0.8):
    """By index: the least index that chains of near copies reach."""
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a & b and len(a & b) >= threshold * len(a | b) - 1e-9):
                x, y = sorted((label[i], label[j]))
                label = [x if z == y else z for z in label]
    return label


def made():
    """Copies with one to four words changed of texts of many lengths, and a passage that many texts hold."""
    r = random.Random(3)
    word = lambda: f"w{r.randrange(3000)}"
    passage, texts = [word() for _ in range(30)], [None, "", " \n", "One", "one", "a b c d", "A b\tc d"]
    for n in (6, 12, 30, 46, 60, 100, 300):
        base = [word() for _ in range(n)]
        for _ in range(40):
            copy = list(base)
            for _ in range(r.randrange(5)):
                copy[r.randrange(n)] = word()
            texts.append(" ".join(copy))
        texts += [" ".join([word() for _ in range(n)] + passage) for _ in range(15)]
    return texts


def test_equals_brute_force(spark):
    texts = made()
    want = groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in S.one_of_each(docs, 5, 0.8).collect())
    assert got == [(i, t) for i, t in enumerate(texts) if want[i] == i] and 100 < len(got) < len(texts) - 100


def test_stage_drops_edited_copies(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    want = groups([r.text for r in rows])
    got = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, sf).collect()}
    assert got == {r.doc_id for i, r in enumerate(rows) if want[i] == i} and not {56, 255, 944} & got


def test_sketches_never_rule_out_too_much():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 3000).astype(np.uint64)
    for n in (5, 80, 3000):
        other = np.concatenate([base[: n - n // 9], r.integers(0, 2**63, n // 9).astype(np.uint64)])
        more = r.integers(0, 2**63, n).astype(np.uint64)
        flat, width = N.sketches(np.concatenate([base[:n], other, other, more]), np.array([n, len(other), len(other) + n]))
        got = N.differing(flat, np.cumsum(width) - width, width, np.array([0, 0, 1]), np.array([1, 2, 2]))
        assert (got <= [2 * (n // 9), 2 * (n // 9) + n, n]).all() and (n < 80 or got[2] > n // 4)


def test_groups_over_batches():
    t = pa.record_batch([pa.array(np.sort(np.random.default_rng(0).integers(0, 9, 200))), pa.array(range(200))], names=["k", "v"])
    for size in (1, 7, 200):
        out = list(N.whole_groups(t.slice(i, size) for i in range(0, 200, size)))
        keys = [set(x["k"].to_pylist()) for x in out]
        assert [v for x in out for v in x["v"].to_pylist()] == list(range(200)) and sum(map(len, keys)) == len(set.union(*keys))


def test_empty(spark):
    assert S.one_of_each(spark.createDataFrame([], "doc_id long, text string"), 5, 0.8).count() == 0
