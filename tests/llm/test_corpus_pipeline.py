import hashlib
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm.test_near_copies import groups
from tests.llm.test_substring_dedup import brute
from tests.llm.test_token_orc import plain

from crosslink.llm import decontaminate, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return [[r.asDict() for r in df.orderBy("doc_id").collect()] for df in out], [df.columns for df in out]


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5 and all(c == stages[1][0] for c in stages[1][:-1])


def test_toxicity(spark, stages):
    before, after = stages[0][:2]
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert after == [r for r in before if model.scores([r["text"] or ""])[0] < 0.5] and len(after) < len(before)


def test_near_duplicates(stages):
    before, after = stages[0][1:3]
    root = groups([r["text"] for r in before])
    assert after == [r for i, r in enumerate(before) if root[i] == i] and len(after) < len(before)


def test_substrings(stages):
    before, after = stages[0][2:4]
    words = lambda t: " ".join(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    assert len(after) == len(before)
    for r, x, (_, removed, kept) in zip(before, after, brute([r["text"] for r in before], 35)):
        assert x == r if not removed else (words(x["text"]), x["n_chars"]) == (kept, len(x["text"])) and {**x, "text": 0, "n_chars": 0} == {**r, "text": 0, "n_chars": 0}


def test_benchmark(spark, stages):
    """A document goes just if some item is within its error budget of a part of it, by the plain table of edit distances."""
    before, after = stages[0][3:5]
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in after}

    def near(item, text):
        most = int(0.05 * len(item))
        if not item or not any(item[i : i + 12] in text for i in range(0, max(1, len(item) - 11), 2)):
            return False  # at one edit in 20 characters, some 12 characters in a row stay
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row) <= most

    for r in before:
        text = decontaminate.normal(r["text"])
        hit = any(i in text for i in items if i) or any(near(i, text) for i in items if len(i) > 40)
        assert (r["doc_id"] not in kept) == hit


def test_tokens(stages):
    before, after = stages[0][4:6]
    want = plain([r["text"] for r in before])
    assert [(r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in after] == [(r["doc_id"], len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for r, x in zip(before, want)]


def test_run_equals_stages(spark, stages):
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == [tuple(r.values()) for r in stages[0][5]]
    assert re.fullmatch("[0-9a-f]{64}", stages[0][5][0]["decoded_sha256"])


ODD = "doc_id long, text string, `a.b` string, score double, n_words int, n_removed int, kept string, fp long, predicted int, tokens array<int>, n_chars int"


def test_odd_rows(spark):
    """Nulls in all columns, empty and very long texts, repeated rows, names with dots and names that operators use."""
    long = " ".join(f"w{i}" for i in range(30000))
    passage = " ".join(f"p{i}" for i in range(40))
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "yz")
    texts = [None, "", " \n", long, "a b", "a b", f"{passage} {one}", f"{two}\n\n{passage}", None, "x"]
    ids = [1, 2, 3, 4, 5, 5, 6, 7, None, None]
    docs = spark.createDataFrame([(i, t, "d", 0.5, 1, 2, "k", 3, 1, [4], None) for i, t in zip(ids, texts)], ODD)
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.written(stage(spark, now, SF), "t")
        assert now.columns == docs.columns, name
        assert all(tuple(r)[2:-1] == ("d", 0.5, 1, 2, "k", 3, 1, [4]) for r in now.collect()), name
    got = sorted(((r.doc_id, r.text) for r in now.collect()), key=repr)
    # one of the texts without words, one of the equal rows; the shared passage goes, the rest of its texts stays as it was
    assert got == sorted([(1, None), (4, long), (5, "a b"), (6, one), (7, f"{two}\n\n"), (None, "x")], key=repr)
    assert {(r.doc_id, r.n_tokens > 0) for r in corpus_pipeline.encoded(spark, now, SF).collect()} == {(1, False), (4, True), (5, True), (6, True), (7, True), (None, True)}


def test_empty_table(spark):
    now = spark.createDataFrame([], ODD)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0 and now.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_columns_called_like_steps(spark, sf_dir):
    """Columns with the names that the stages use inside come through unchanged, in value and type."""
    from crosslink.llm import licenses

    names = ["__k1", "__K2", "__t1", "_t2", "__null", "__words", "__removed", "own", "__score", "__predicted", "__held_out", "c0", "c1", "k1", "held_out", "a.b", "__codes", "__may", "least", "root", "m0"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.filter("doc_id < 60").select("*", *[(F.col("doc_id") * 10 + i).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and [t for n, t in out.dtypes] == [t for n, t in docs.dtypes], name
        rows = out.collect()
        assert rows and all(tuple(r)[-len(names) :] == tuple(r.doc_id * 10 + i for i in range(len(names))) for r in rows), name
    found = licenses.scan(docs)
    assert found.columns[: len(docs.columns)] == docs.columns and all(tuple(r)[len(docs.columns) - 1] == r.doc_id * 10 + len(names) - 1 for r in found.collect())
