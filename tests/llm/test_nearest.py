import numpy as np

from crosslink.llm import nearest as N
from crosslink.llm.queries import op5_nearest


def exact(ids, x, asked, k):
    out = {}
    for i in asked:
        others = ids != ids[i]
        score = (x[others] * x[i]).sum(axis=1)
        order = np.lexsort((ids[others], -score))[:k]
        out[int(ids[i])] = list(zip(ids[others][order].tolist(), score[order].tolist()))
    return out


def test_recall_on_real_vectors(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    want = exact(ids, x, np.flatnonzero(ids % 20 == 0), 20)
    got = {}
    for r in op5_nearest(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert all(abs(s - dict(exact(ids, x, [np.flatnonzero(ids == q)[0]], len(ids))[q])[v]) < 1e-12 for q in list(got)[:3] for v, s in got[q])
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_lengths_shards_and_ties(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((600, 8)) * r.random((600, 1)) * 3
    x[100:140] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = exact(np.arange(600), x, range(0, 600, 20), 10)
    got = {}
    for y in N.nearest(df, df.filter("vec_id % 20 = 0"), 10, shard=150, centres=3, together=7).orderBy("query_id", "rank").collect():
        got.setdefault(y.query_id, []).append(y.vec_id)
    assert np.mean([len(set(got[q]) & {v for v, _ in want[q]}) / 10 for q in want]) >= 0.9
    for vs in got.values():
        same = [v for v in vs if 100 <= v < 140]
        assert same == sorted(same)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (21, [-1.0, 5.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = [tuple(r) for r in N.nearest(df, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 2.0), (0, 2, 20, 2.0), (0, 3, 21, -1.0), (20, 1, 21, 3.0), (20, 2, 0, 2.0)]
    assert N.nearest(df.filter("false"), df.filter("false")).count() == 0


def recalls(x, n_queries=64, k=20):
    """Recall of production parameters on one shard, and the share of vectors that were verified."""
    ids = np.arange(len(x))
    asked = ids[:: len(x) // n_queries]
    want = exact(ids, x, asked, k)
    shard = N.Shard(x, ids, k, 64, 0.75, 0.9)
    got = {i: set(shard.search(x[i], i, -np.inf)[0].tolist()) for i in asked.tolist()}
    return np.mean([len(got[q] & {v for v, _ in want[q]}) / k for q in want]), shard.verified / len(asked) / len(x)


def test_recall_on_other_vectors():
    """With production parameters: random directions, Gaussian vectors, norms that vary much, many dimensions, clusters, few dimensions."""
    r = np.random.default_rng(11)
    n = 8192
    unit = lambda d: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(r.standard_normal((n, d)))
    one = np.ones((n, 1))
    one[5] = 3
    kinds = {
        "unit, 64": unit(64),
        "Gaussian, 64": r.standard_normal((n, 64)),
        "one long vector": unit(64) * one,
        "norms lognormal 0.25": unit(64) * np.exp(0.25 * r.standard_normal((n, 1))),
        "norms lognormal 1": unit(64) * np.exp(r.standard_normal((n, 1))),
        "Gaussian, 256": r.standard_normal((n, 256)),
        "unit, 256": unit(256),
        "clusters": r.standard_normal((n // 32, 64)).repeat(32, axis=0) + 0.3 * r.standard_normal((n, 64)),
        "two dimensions": r.standard_normal((n, 2)),
        "small": unit(64) * 1e-120,
    }
    found = {name: recalls(x) for name, x in kinds.items()}
    print({k: (round(float(a), 3), round(b, 3)) for k, (a, b) in found.items()})
    assert not {k: v for k, v in found.items() if v[0] < 0.9}
    assert found["clusters"][1] < 0.1


def test_ends_for_huge_vectors(spark):
    r = np.random.default_rng(12)
    x = r.standard_normal((400, 4))
    x[7] *= 1e200
    x[8] *= 1e160
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = N.nearest(df, df.filter("vec_id < 10"), 5, shard=100).collect()
    assert len(rows) == 50 and {r.query_id for r in rows} == set(range(10))


def test_exact_way_and_clusters(spark):
    """target=1 equals brute force; with clusters most shards are ruled out and recall stays."""
    r = np.random.default_rng(13)
    x = r.standard_normal((30, 16)).repeat(100, axis=0) * 3 + 0.2 * r.standard_normal((3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = exact(np.arange(3000), x, range(0, 3000, 20), 20)
    for target, least in ((1, 1.0), (0.9, 0.9)):
        got = {}
        for y in N.nearest(df, df.filter("vec_id % 20 = 0"), 20, target=target, shard=250).orderBy("query_id", "rank").collect():
            got.setdefault(y.query_id, []).append(y.vec_id)
        recall = np.mean([len(set(got[q]) & {v for v, _ in want[q]}) / 20 for q in want])
        assert recall >= least and all(len(v) == 20 for v in got.values())
        if target == 1:
            assert all(got[q] == [v for v, _ in want[q]] for q in want)
