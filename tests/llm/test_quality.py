import numpy as np

from crosslink.llm import quality as Q
from crosslink.llm.queries import op2_quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op2_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) / len(held) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(i % 251 for i in range(n))
        chunks, of = Q.chunks_of([b"", text])
        step, own = Q.CHUNK - Q.OVERLAP, chunks[of == 1]
        whole = np.concatenate([own[0], *[c[Q.OVERLAP :] for c in own[1:]]])
        assert bytes(whole[:n].astype(np.uint8)) == text and (whole[n:] == Q.PAD).all()
        assert all((a[step:] == b[: Q.OVERLAP]).all() for a, b in zip(own, own[1:]))


def test_gradients():
    r = np.random.default_rng(3)
    net, texts = Q.Net.new(1), [bytes(r.integers(0, 256, n).astype(np.uint8)) for n in (0, 40, 700, 2000)]
    for k in vars(net):
        if k != "prior":
            setattr(net, k, getattr(net, k).astype(np.float64))
    y, weight = np.array([0, 1, 1, 0.0]), np.ones(4)
    loss = lambda: -np.log(np.abs(1 - y - net.scores(texts))).sum()
    for k, g in net.learn(texts, y, weight).items():
        flat, g = getattr(net, k).reshape(-1), np.asarray(g).reshape(-1)
        for i in np.argsort(-np.abs(g))[:3]:
            was, e = flat[i], 1e-4
            flat[i] = was + e
            up = loss()
            flat[i] = was - e
            assert abs((up - loss()) / (2 * e) - g[i]) < 0.05 * abs(g[i]) + 1e-3, k
            flat[i] = was


def test_scores_do_not_depend_on_neighbours():
    net, texts = Q.Net.new(), [b"", b"a b c", b"x" * 3000, "é!".encode() * 400]
    assert np.allclose(net.scores(texts), np.concatenate([net.scores([t]) for t in texts]), atol=1e-6)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "s"), (None, "", "t"), (2, "x" * 30000, "u")], "doc_id long, text string, score string")
    none, labels = docs.filter("false"), spark.createDataFrame([(1, 1), (7, None), (None, 0)], "doc_id long, quality int")
    got = Q.score(docs, Q.train(docs, labels, per_class=5))
    assert got.columns == ["doc_id", "text", "held_out", "score", "predicted"] and got.count() == 3
    assert Q.score(none, Q.train(none, labels.filter("false"))).count() == 0


def test_scores_equal_plain_forward_pass():
    """One chunk, one place and one filter after another, without any array operation of the model's own."""
    net, r = Q.Net.new(5), np.random.default_rng(5)
    texts = [b"", b"short", bytes(r.integers(0, 256, 1300).astype(np.uint8)), "é! ".encode() * 300]
    got = net.scores(texts)
    for text, score in zip(texts, got):
        step = Q.CHUNK - Q.OVERLAP
        n = max(1, -(-(len(text) - Q.OVERLAP) // step))
        values = []
        for i in range(n):
            chunk = list(text[i * step : i * step + Q.CHUNK])
            chunk += [Q.PAD] * (Q.CHUNK - len(chunk))
            pooled = [-np.inf] * Q.FILTERS
            for at in range(0, Q.CHUNK - Q.WIDTH + 1, Q.STRIDE):
                seen = [float(x) for b in chunk[at : at + Q.WIDTH] for x in net.embed[b]]
                for f in range(Q.FILTERS):
                    pooled[f] = max(pooled[f], sum(x * float(w) for x, w in zip(seen, net.filters[:, f])))
            pooled = [max(0.0, p + float(o)) for p, o in zip(pooled, net.offset)]
            hidden = [np.tanh(sum(p * float(w) for p, w in zip(pooled, net.dense[:, j])) + float(net.dense_offset[j])) for j in range(net.dense.shape[1])]
            values.append(sum(h * float(w) for h, w in zip(hidden, net.out)))
        three = [max(values), sum(values) / len(values), min(values)]
        logit = sum(x * float(m) for x, m in zip(three, net.mix)) + float(net.mix[-1]) + net.prior
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-5
