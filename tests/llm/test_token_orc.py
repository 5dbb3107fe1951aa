import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from crosslink.llm import token_orc
from crosslink.llm.common import scratch
from crosslink.llm.word_bpe import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", " ", "a\x0bb\x0cc\x1cd\x85e f g", "Don't it's 'll", "<|endoftext|> x<|startoftext|>y", "naïve é क़́abc, ΑΣ ΟΔΟΣ.", "...!!! 12.5% a1b2 word,", "日本語 test|pipe", "İstanbul ﬁ x̸", None, "a" * 5000]


def plain(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def split(counts, ids):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_encoder_equals_library(spark, sf_dir):
    texts = HARD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(150).collect()]
    coder = WordEncoder(PATH, cache_words=50)
    for _ in range(2):
        assert split(*coder.encode(pa.array(texts))) == plain(texts)


def test_orc_round_trip(spark):
    rows = [(i, t, "clash") for i, t in enumerate(HARD)] + [(None, "null id", "x"), (3, "again", "y"), (3, "again", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    path = scratch(spark, "t")
    token_orc.write_token_orc(docs, path, PATH, 2, parts=3)
    read = token_orc.read_token_orc(spark, path)
    got = token_orc.token_spans(read).orderBy("start").collect()
    want = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in rows), key=lambda r: (r[0], r[1], r[2].encode()))
    ids = [x + [2] for x in plain([w[2] for w in want])]
    assert [r.doc_id for r in got] == [w[1] if w[0] else None for w in want]
    assert [r.n_tokens for r in got] == [len(x) for x in ids]
    assert [r.start for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert [r.tokens for r in token_orc.read_token_orc(spark, path, [7]).collect()] == [plain([HARD[7]])[0] + [2]]


def test_orc_empty(spark):
    path = scratch(spark, "t")
    token_orc.write_token_orc(spark.createDataFrame([], "doc_id long, text string"), path, PATH, 2)
    assert token_orc.token_spans(token_orc.read_token_orc(spark, path)).count() == 0


def test_letters_that_fall_apart():
    """Letters that the tokenizer composes or lower-cases into a letter and a mark, before each sign; and random Unicode."""
    import random

    r = random.Random(7)
    odd = ["İ", "ड़", "ড়", "שׁ", "ਫ਼", "གྷ", "ΑΣ", "ŉ", "ﬁ", "e\u0301", "²", "٣", "が", "\u200b", "𝐀", "<|endoftext|>"]
    plane = lambda: chr(r.choice([r.randrange(0x20, 0x600), r.randrange(0x600, 0xD800), r.randrange(0xE000, 0x1FFFF)]))
    sign = lambda: r.choice([r.choice("abcXYZ"), r.choice("  \n"), r.choice(".,;:!?|'"), r.choice(odd), plane()])
    texts = [a + m + b for a in odd for m in ".,;:!?|" for b in ("", "x", m)] + ["".join(sign() for _ in range(r.randrange(30))) for _ in range(10000)]
    coder = WordEncoder(PATH, cache_words=1000)
    for i in range(0, len(texts), 500):
        part = texts[i : i + 500]
        assert split(*coder.encode(pa.array(part))) == plain(part)


def test_files_have_indexes_and_skip(spark):
    """The row index and the Bloom filter stand in the files, and a reader with doc ids takes few rows in."""
    import glob

    from pyspark.sql import functions as F

    docs = spark.range(20000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    path = scratch(spark, "t")
    token_orc.write_token_orc(docs, path, PATH, 2, parts=2)
    files = sorted(glob.glob(path.removeprefix("file:") + "/*.orc"))
    assert len(files) == 2
    jvm = spark._jvm.org.apache
    reader = jvm.orc.OrcFile.createReader(jvm.hadoop.fs.Path(files[0]), jvm.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    assert reader.getRowIndexStride() == 1000
    kinds = {str(s.getKind()) for s in reader.rows().readStripeFooter(reader.getStripes()[0]).getStreamsList()}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    for wanted, rows, most in ((10, 1, 1024), (11, 0, 0)):  # 11 lies between two ids, so only the Bloom filter can tell
        df = token_orc.read_token_orc(spark, path, [wanted])
        assert len(df.collect()) == rows
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numOutputRows").value() <= most  # of 20,000 rows


def test_an_id_of_most_rows_is_in_many_files(spark, tmp_path):
    rows = [(None, f"text {i}") for i in range(300)] + [(7, f"{i} copy") for i in range(300)] + [(i, "x y") for i in range(8, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    path = f"file:{tmp_path}/hot"
    token_orc.write_token_orc(docs, path, PATH, 2, parts=8)
    read = token_orc.read_token_orc(spark, path)
    parts = {k: {r.part for r in read.collect() if r.doc_id == k} for k in (None, 7)}
    assert all(len(p) > 1 for p in parts.values())
    spans = sorted(token_orc.token_spans(read).collect(), key=lambda r: r.start)
    assert len(spans) == len(rows) and [r.start for r in spans] == [sum(x.n_tokens for x in spans[:i]) for i in range(len(spans))]
    ids = [r.doc_id for r in spans]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
