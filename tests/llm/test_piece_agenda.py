import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from crosslink.llm import piece_agenda as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = [None, "", " ", "  ", "\n", "a", "▁", "▁▁ a  b", " " * 1000, "a" * 3000, "é" * 100, "日本語", "x\x00y", "<s></s><0x0A><unk>", "\r\n\r\n  {\r\n", "😀👍🏽 ok", "İstanbul K", " \t \t", " " * 37 + "x" + "\n" * 60]


@pytest.fixture(scope="module")
def agenda():
    return P.Agenda(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def odd_texts(agenda, n):
    rnd = random.Random(7)
    letters = " abcdethn  .,;()'\"\n\r\t▁éñ日x0123456789́😀\x00ſẞ{}"
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 120))) for _ in range(n)]
    out += ["".join(rnd.choice(agenda.pieces) for _ in range(rnd.randint(0, 12))) for _ in range(n)]
    return out + ["".join(chr(rnd.choice([rnd.randint(0, 0xD7FF), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_equals_library(agenda, library):
    texts = HARD + odd_texts(agenda, 1500)
    lists, same = agenda.encode(pa.array(texts, pa.string()), library)
    want = [library.encode(t or "") for t in texts]
    assert lists.to_pylist() == want and same.all()
    assert agenda.decode(lists).to_pylist() == [library.decode(w) for w in want]


def test_decode_any_ids(agenda, library):
    rnd = random.Random(3)
    rows = [[rnd.choice([rnd.randint(0, 260), rnd.randint(0, 31999), rnd.randint(128, 258)]) for _ in range(rnd.randint(0, 8))] for _ in range(3000)]
    assert agenda.decode(pa.array(rows, pa.list_(pa.int32()))).to_pylist() == [library.decode(r) for r in rows]
    odd = pa.array([None, [None, 7658], [-1, 99999, 7658]], pa.list_(pa.int32()))
    assert agenda.decode(odd).to_pylist() == ["", library.decode([7658]), library.decode([7658])]


def test_heap_and_rounds_agree(agenda):
    rnd = random.Random(5)
    for _ in range(300):
        symbols = [agenda.symbols[c] for c in "".join(rnd.choice("the in▁▁éa.") for _ in range(rnd.randint(1, 60))).replace(" ", "")]
        together = agenda.many(np.array(symbols, np.int32), np.array([len(symbols)]))[0].tolist()
        assert together == agenda.one(list(symbols))


def test_a_wrong_id_is_seen(agenda, library):
    class Other:
        def encode(self, texts, num_threads):
            return [w if "z" not in t else [*w[:-1], 5] for t, w in zip(texts, library.encode(texts))]

    assert agenda.encode(pa.array(["a b", "a zebra b", "c"]), Other())[1].tolist() == [True, False, True]


def test_frames(spark, sf_dir, library):
    docs = spark.createDataFrame([(i, t, "x", 2.0) for i, t in enumerate(HARD + [HARD[5]])], "doc_id long, text string, tokens string, `a.b` double").repartition(3)
    encoded = P.encode(docs, PATH)
    rows = {r.doc_id: r for r in P.decode(P.checked(encoded, PATH), PATH).collect()}
    for i, t in enumerate(HARD + [HARD[5]]):
        ids = library.encode(t or "")
        assert (rows[i].text, rows[i].tokens, rows[i].decoded, rows[i].agrees, rows[i]["a.b"]) == (t, ids, library.decode(ids), True, 2.0)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {r.doc_id: library.encode(r.text) for r in documents.collect()}
    got = {r.doc_id: r for r in P.digests(documents, PATH).collect()}
    assert all(tuple(got[i])[1:] == (len(w), sha(",".join(map(str, w))), sha(library.decode(w)), True) for i, w in want.items()) and len(got) == len(want)
    assert P.checked(encoded.withColumn("tokens", F.lit([5])), PATH).filter("agrees").isEmpty()


def test_empty_and_null_ids(spark):
    assert P.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    rows = P.digests(spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string"), PATH).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 1, 1]


def test_other_vocabularies_raise(tmp_path):
    path = tmp_path / "other.model"
    piece = b"\x0a\x01a\x15\x00\x00\x00\x00"
    path.write_bytes(b"\x0a" + bytes([len(piece)]) + piece + b"\x12\x02\x18\x01" + b"\x1a\x00")
    with pytest.raises(ValueError, match="merge-type"):
        P.Agenda(str(path))
