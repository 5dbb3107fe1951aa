import hashlib

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from crosslink.llm import bpe_table as B
from tests.llm.test_token_orc import HARD, PATH, plain


def test_equals_library(spark, sf_dir):
    texts = HARD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(100).collect()] + [HARD[5]]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, tokens string")
    want, t = plain(texts), Tokenizer.from_file(PATH)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    encoded = B.encode(docs, PATH, ["doc_id", "text", "tokens"])
    got = {r.doc_id: r for r in B.decode(encoded, PATH).collect()}
    assert [got[i].tokens for i in range(len(texts))] == want
    assert [got[i].decoded for i in range(len(texts))] == [t.decode(x, skip_special_tokens=False) for x in want]
    got = {r.doc_id: r for r in B.digests(docs, PATH).collect()}
    assert all(got[i][1:] == (len(x), sha(" ".join(map(str, x))), sha(t.decode(x, skip_special_tokens=False))) for i, x in enumerate(want))


def test_each_word_once(spark):
    docs = spark.createDataFrame([(1, "a a, a b b c d"), (2, "a b e,"), (3, None), (4, " ")], "doc_id long, text string").repartition(3)
    texts, words = B.coded_blocks(docs, ["doc_id"], 4)
    un = lambda data: B.unpacked(pa.scalar(bytes(data), pa.binary()))
    buckets, seen = {}, []
    for r in words.collect():
        found = un(r.data)["words"].to_pylist()
        seen += [(r.block, w) for w in found]
        for w in found:
            buckets.setdefault(w.rstrip(","), set()).add(r.bucket)
    assert set(buckets) == set("abcde") and all(len(b) == 1 for b in buckets.values())  # so a word meets itself in one group
    assert len(seen) == len(set(seen))
    rows = [un(un(r.data)["data"][0].as_py()) for r in texts.collect()]
    assert {k: n for t in rows for k, n in zip(t["k0"].to_pylist(), t["n"].to_pylist())} == {1: 7, 2: 3, 3: 0, 4: 0}


def test_other_rows_the_second_time_raise(spark):
    import pytest
    from pyspark.sql import functions as F

    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.floor(F.rand() * 1e9).cast("string"), F.lit(" "), F.uuid()).alias("text"))
    with pytest.raises(Exception, match="write them first"):
        B.digests(docs.withColumn("text", F.expr("concat(text, ' ', repeat('x ', cast(rand() * 9 as int)), reflect('java.util.UUID', 'randomUUID'))")), PATH).collect()


def test_blocks_of_any_size():
    texts = ["x" * n for n in (5, 0, 30, 1, 1, 1, 12, 9)] + [None]
    batches = pa.Table.from_pydict({"t": pa.array(texts, pa.string())}).to_batches(max_chunksize=2)
    for most in (1, 10, 40, 1000):
        blocks = [b.column(0).to_pylist() for b in B.gathered(iter(batches), 0, most)]
        assert [t for b in blocks for t in b] == texts and all(len(b) == 1 or sum(len(t or "") for t in b) <= most for b in blocks)
    assert list(B.gathered(iter([]), 0)) == []


def test_decode_odd_ids(spark):
    rows = spark.createDataFrame([(1, [320, None, 999999, -1, 49407]), (2, None), (3, [])], "doc_id long, tokens array<int>")
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id: r.decoded for r in B.decode(rows, PATH).collect()} == {1: t.decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}


def test_empty(spark):
    assert B.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
