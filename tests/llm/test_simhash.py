import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from crosslink.llm import simhash as S
from crosslink.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(fps):
    """By index: the least index that links reach."""
    x, label = np.array(fps, np.uint64), list(range(len(fps)))
    while True:
        new = [min(label[j] for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3)) for i in range(len(x))]
        new = [label[i] if label[i] < n else n for i, n in enumerate(new)]
        if new == label:
            return label
        label = new


def test_fingerprints_and_components(spark, sf_dir):
    texts = [None, "", " \t", "One", "one two", "ÄA b C d", "x " * 700, "\x1c a \x85 b", "ONE"]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(200).collect()]
    docs = spark.createDataFrame([(i + 5, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id int")
    got = {r.doc_id: r for r in S.near_duplicates(docs).collect()}
    want = [fingerprint(t) for t in texts]
    assert [got[i + 5].fingerprint for i in range(len(texts))] == [f"{x:016x}" for x in want]
    assert [got[i + 5].component_id - 5 for i in range(len(texts))] == groups(want)


def test_links_with_large_nodes(spark):
    r = random.Random(2)
    fps = {r.getrandbits(64) for _ in range(300)}
    for base in list(fps)[:12]:
        for _ in range(25):
            x = base
            for _ in range(r.randrange(1, 5)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = groups(fps)
    for most in (20_000, 5):
        links = S.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), most)
        root = {x.node: x.root for x in components(links).collect()}
        ours = [root.get(x, x) for x in signed]
        same = {}
        assert all(same.setdefault(a, b) == b for a, b in zip(want, ours)) and len(set(ours)) == len(set(want))


def test_gray_rank(spark):
    x = [0, 1, 3, 2, 6, 7, 5, 4, -1]
    rows = spark.createDataFrame([(v,) for v in x], "fp long").select(S.gray_rank(F.col("fp")).alias("g")).collect()
    assert [r.g for r in rows[:8]] == list(range(8))


def test_streamed_nodes_equal_whole():
    r = np.random.default_rng(0)
    fp = r.integers(0, 2**8, 400).astype(np.uint64)
    pattern = np.sort(r.integers(0, 5, 400))
    whole = pa.record_batch([pa.array(np.zeros(400, np.int32)), pa.array(pattern), pa.array(fp.view(np.int64))], names=["mask", "pattern", "fp"])
    pairs = lambda cut: {tuple(p.values()) for b in S.links_of_sorted(whole.slice(i, cut) for i in range(0, 400, cut)) for p in b.to_pylist()}
    assert pairs(400) == pairs(7) == pairs(1)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in [*range(41), 100]} | {200: 200, 201: 200, 202: 200}


def test_empty(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each(spark):
    docs = spark.createDataFrame([(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "z"), (None, "a b c d", "n"), (None, "q r s", "m"), (None, "q r s", "m"), (7, "t u v w x", "k")], "doc_id int, text string, component_id string")
    got = S.one_of_each(docs)
    assert got.columns == docs.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 1), (False, 7), (True, 0)]
    assert {r.text for r in got.filter("doc_id is null").collect()} <= {"q r s", "a b c d"}


def test_one_of_each_null_and_repeated_ids(spark):
    r = random.Random(4)
    texts = [" ".join(f"w{r.randrange(9999)}" for _ in range(30)) for _ in range(12)]
    rows = [(None, t) for t in texts[:6] for _ in range(2)] + [(1, t) for t in texts[6:10]] + [(2, texts[10]), (None, texts[10]), (None, None), (3, "")]
    got = S.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, t) for t in texts[:6]] + [(1, t) for t in texts[6:10]] + [(2, texts[10]), (3, "")]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_index_prunes_and_adds_up():
    """Patterns are factored: no bit stands twice on a way down, all 64 do; the search equals brute force and passes most groups over."""
    r = np.random.default_rng(3)
    centres = r.integers(0, 1 << 63, 60, dtype=np.uint64)
    x = np.unique(np.concatenate([centres, *[centres ^ (np.uint64(1) << r.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 60).astype(np.uint64)) for _ in range(40)]]))
    rank = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    x = x[np.argsort(rank)]
    index = S.GrayIndex(x)
    assert len(index.levels) == 5  # 8, 64, 512, 4096 and the root
    for i in range(len(x)):
        way = [int(mask[i // S.FAN ** (len(index.levels) - 1 - depth)]) for depth, (mask, _) in enumerate(index.levels)]
        assert sum(way) == (1 << 64) - 1 and sum(m.bit_count() for m in way) == 64
    u, v = index.search(np.arange(len(x)), np.arange(len(x)))
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    assert {(i, j) for i, j in zip(u.tolist(), v.tolist())} == {(i, j) for i, j in zip(a.tolist(), b.tolist()) if i != j}
    assert index.met < 0.25 * len(x) ** 2 and index.pruned > 0.7 * index.met
    before = index.met
    assert not len(index.search(np.arange(len(x)), np.zeros(len(x), np.int64))[0]) and index.met - before == len(x)  # one component: passed over at the root
    links = S.links_in_node(x)
    assert len(links) < len(x)
    label = groups(x.tolist())
    root = list(range(len(x)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in links:
        root[max(find(i), find(j))] = min(find(i), find(j))
    assert [find(i) for i in range(len(x))] == label


def test_last_masks_bound_a_group():
    assert all(64 - (m & (1 << 64) - 1).bit_count() <= 14 for m in S.masks()[-1]) and 1 << 14 <= S.MOST
