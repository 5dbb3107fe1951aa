import random
import zlib

import pytest

from crosslink.llm import spellings as S


def near(a, b):
    """One code point inserted, deleted or replaced, by plain comparison."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words, factor=2):
    out = {}
    for w, n in words.items():
        others = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(others, default=None)
        out[w] = (best[1] if best and -best[0] >= factor * n else None, len(others), -best[0] if best and -best[0] >= factor * n else None)
    rows = {}
    for w, (form, count, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows[w] = (form, root, words[w], count, form_n)
    return rows


def rows_of(df):
    got = df.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_brute_force(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6))): rnd.choice([1, 2, 4, 4, 9, 20, 41, 100]) for _ in range(500)}
    assert rows_of(S.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == plain(words)
    assert any(r[1] != r[0] for r in plain(words).values() if r[0])  # chains are in it


def test_runs_ties_and_long_chains(spark):
    words = {"aaaaa": 3, "aaaa": 6, "aaa": 12, "bbbbb": 4, "bbbba": 8, "bbbbc": 8, "x": 1, "y": 2, "": 7, "zzzzzz": 5, "zzzzz": 9, "日本語": 2, "日木語": 5}
    words |= {"q" * i: 2 ** (20 - i) for i in range(6, 16)}
    got = rows_of(S.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain(words)
    assert got["bbbbb"][0] == "bbbba" and got["q" * 15][1] == "q" * 6 and got["zzzzzz"][0] is None


def test_groups_are_bounded(spark):
    words = [(f"common{chr(97 + i)}word", 5) for i in range(26)] + [("commonword", 50)]
    rotated = S.rotations(spark.createDataFrame(words, "word string, n long"))
    assert rotated.groupBy("prefix").count().agg({"count": "max"}).first()[0] == 27
    assert rotated.filter("prefix = 'word$common'").count() == 27


def test_counted_words(spark):
    docs = [(None, "Straße Straße straße"), (1, None), (2, ""), (3, "Hello, HELLO hello 9hello_ ÀÉÿß× àÉÿß× x"), (3, "Hello")] + [(i, "spelling Spelling abcde") for i in range(4, 400)]
    frame = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    want = {}
    import re

    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            want[w] = want.get(w, 0) + 1
    got = {r.word: r.n for r in S.counted_words(frame, 97).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3} and any("spelling" != w and "peling"[:4] in w for w in want)
    assert {r.word: r.n for r in S.counted_words(frame).filter("word = 'spelling'").collect()} == {"spelling": 792}


def test_odd_words(spark):
    schema = "word string, n long"
    assert S.variants(spark.createDataFrame([], schema)).count() == 0
    assert rows_of(S.variants(spark.createDataFrame([(None, 3), ("solo", 3)], schema))) == {"solo": (None, "solo", 3, 0, None)}
    with pytest.raises(Exception, match="holds the mark"):
        S.variants(spark.createDataFrame([("a$b", 3)], schema)).collect()
    with pytest.raises(ValueError):
        S.variants(spark.createDataFrame([("a", 3)], schema), 1)
