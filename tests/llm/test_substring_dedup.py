import hashlib
import random
import re
from collections import Counter

import numpy as np

from crosslink.llm import substring_dedup as S


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_covers():
    for period, cover in S.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_brute_force(spark):
    r = random.Random(1)
    make = lambda n: [f"w{r.randrange(400)}" for _ in range(n)]
    passage, texts = [make(k) for k in (34, 35, 36, 60, 90)], []
    for _ in range(60):
        t = make(r.randrange(80))
        for _ in range(r.randrange(3)):
            t += r.choice(passage) + make(r.randrange(40))
        texts.append(r.choice([" ", "\n", "\t \x0b"]).join(t))
    texts += [texts[0], texts[1], texts[1], "a b " * 40, None, "", "  ", "x y\x1cz " * 36, " ".join(passage[4][:50]) + " lead"]
    docs = spark.createDataFrame([(i, t, i, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, t1 string")
    for window in (35, 8, 3):
        rows = S.remove_repeats(docs, window).collect()
        words = lambda t: " ".join(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
        assert {x.doc_id: (x.n_words, x.n_removed, words(x.text), x.t1) for x in rows} == {i: (*x, "q") for i, x in enumerate(brute(texts, window))}
        assert all(x.text == texts[x.doc_id] for x in rows if not x.n_removed)


def test_real_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([x.doc_id for x in rows], brute([x.text for x in rows], 35)))
    from crosslink.llm.queries import op7_substring_dedup

    got = op7_substring_dedup(spark, sf_dir).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in got} == {k: (a, b, hashlib.sha256(c.encode()).hexdigest()) for k, (a, b, c) in want.items()}
    assert sum(b > 0 for _, b, _ in want.values()) > 5


def test_empty(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cut_out():
    cut = lambda t, gone: S.cut_out(t.encode(), np.array(gone, bool)).decode()
    assert cut("  é b\n\tc  d ", [0, 1, 1, 0]) == "  é d " and cut("a b", [1, 1]) == "" and cut("a\n\nb\n", [0, 1]) == "a\n\n" and cut("a b\nc", [1, 0, 0]) == "b\nc"


def test_hot_passage_is_spread(spark):
    """One passage in all texts: no group of rows with one key grows with the number of texts."""
    r = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{' '.join(f'w{r.randrange(10**6)}' for _ in range(20))} {passage} e{i}" for i in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = S.remove_repeats(docs, 35).select("doc_id", "n_removed").collect()
    assert len(got) == 3000 and {x.n_removed for x in got} == {60}
    hashes = np.repeat(np.arange(5, dtype=np.uint64), 1000)
    text = [np.arange(1, 5001, dtype=np.uint64), np.arange(0, 10000, 2, dtype=np.uint64)]
    keys, ids, marks = S.pre_counted([hashes], text)
    assert len(np.unique(keys[0])) == 5000 and (ids[1] == text[1] + S.SURE).all() and len(marks[0]) == 5
    keys, ids, marks = S.pre_counted([np.array([7, 8, 9], np.uint64)], [t[:3] for t in text])
    assert (ids[1] == text[1][:3]).all() and keys[0].tolist() == [7, 8, 9] and not len(marks[0])


def test_dotted_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a  b\n", "x", 1, "k"), (1, None, None, 2, "l"), (None, "", "y", None, "m")], "doc_id long, text string, `a.b` string, t2 int, kept string")
    out = S.remove_repeats(docs, 35)
    assert out.columns == ["doc_id", "text", "a.b", "t2", "kept", "n_words", "n_removed"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([(1, "a  b\n", "x", 1, "k", 2, 0), (1, None, None, 2, "l", 0, 0), (None, "", "y", None, "m", 0, 0)], key=repr)
