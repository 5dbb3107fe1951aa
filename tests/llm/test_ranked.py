import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from crosslink.llm import ranked as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return ["".join(c.lower() if c < "\x80" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    """Every document's score for every item, by definition."""
    counted = [(i, Counter(split(t)), len(split(t))) for i, t in docs if split(t)]
    length, n_docs = sum(n for *_, n in counted), len(counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in dict.fromkeys(items):
        rows = []
        for doc_id, c, n in counted:
            m = 25 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in split(text) if t in c)
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=repr)


def ours(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def text(rnd, n, words=60):
    return " ".join(f"w{min(int(rnd.expovariate(0.12)), words)}" for _ in range(n))


def test_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    docs = [(i, text(rnd, rnd.choice([0, 1, 3, 20, 80, 400]))) for i in range(400)] + [(7, "w1 w50 W50,w50"), (None, "w55 w56"), (None, "w55 w56"), (900, None), (901, "Über ÜBER ß²x_y a.b"), (902, " .,! ")]
    docs += [(1000 + i, "w50 w51 w52 copy") for i in range(40)]  # ties
    items = [(i, text(rnd, rnd.choice([1, 5, 30]))) for i in range(25)] + [(3, "w55 w55 w1"), (3, "w55 w55 w1"), (3, "über ß²x"), (60, None), (61, ""), (62, "absent"), (None, "W51 copy"), (63, "a B y")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, score string").repartition(5)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    monkeypatch.setattr(R, "BLOCK_DOCS", 1)  # a block for each batch
    for k in (1, 3, 10, 1000):
        assert ours(R.search(frame, asked, k)) == plain(docs, items, k)
    monkeypatch.setattr(R, "ITEM_CHARS", 300)
    assert ours(R.search(frame, asked, 10)) == plain(docs, items, 10)


def test_tables(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    assert ours(R.search(docs, items, 10)) == want


def postings(rows, terms, weights):
    """rows: of each document its terms, once each."""
    lists = pa.array(rows, pa.list_(pa.int32()))
    n = np.full(len(rows), 10, np.int64)
    return R.Postings(pa.array(range(len(rows))), n, lists, np.ones(len(lists.flatten()), np.int32), np.array(weights), len(rows), int(n.sum()))


def test_no_new_accumulators_for_frequent_terms():
    """Term 0 stands everywhere and can't lift a document over those that hold the rare one."""
    rows = [[0, 1] if i % 50 == 0 else [0] for i in range(1000)]
    block = postings(rows, 2, [10, 5000])
    asked = []

    class Watched(np.ndarray):
        def __setitem__(self, at, value):
            asked.append(np.size(at))
            super().__setitem__(at, value)

    block.scores = block.scores.view(Watched)
    got, scores = block.best(np.array([1, 0]), np.array([1, 1]), 10, np.zeros(0, np.int64))
    assert sorted(got.tolist()) == list(range(0, 1000, 50)) and max(asked) == 20
    assert set(np.asarray(scores).tolist()) == {int(block.adds[0] + block.adds[-1])}  # exact, the frequent term counted in
    assert not block.scores.any()
    got, _ = block.best(np.array([1, 0]), np.array([1, 1]), 30, np.zeros(0, np.int64))
    assert len(got) == 1000  # the 30th best holds the frequent term alone, so all of these are candidates


def test_scores_of_earlier_blocks_count():
    block = postings([[0], [0, 1]], 2, [10, 5000])
    high = np.full(10, 10**12)
    assert len(block.best(np.array([1, 0]), np.array([1, 1]), 10, high)[0]) == 0


def test_terms():
    texts = ["", None, "a", "ab", "A_b c", "é", "x", "9-9", "日本 語\x00z"]
    for cut in (texts, texts[3:], texts[:1], []):
        array = pa.array([None, "zz", *cut], pa.string()).slice(2)
        words, n = R.terms_of(array)
        assert words.to_pylist() == [w for t in cut for w in split(t)] and n.tolist() == [len(split(t)) for t in cut]


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert R.search(docs, some.toDF("item_id", "text")).count() == R.search(some, items).count() == R.search(docs, items).count() == 0
    assert ours(R.search(some, some.toDF("item_id", "text"))) == plain([(1, "a")], [(1, "a")], 10)
