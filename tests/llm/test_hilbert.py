"""Recall and exact scores against brute force; the curve itself; odd vectors."""

import numpy as np

from meterstone.llm import hilbert
from meterstone.llm.common import table


def test_curve_visits_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        keys = hilbert.hilbert_keys(cells, bits)
        order = cells[np.argsort(keys)]
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_recall(spark, small_folder):
    df = table(spark, small_folder, "embeddings")
    rows = df.collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])
    got = {}
    for r in hilbert.neighbours(df, df.where("vec_id % 20 = 0"), share=0.08, least=40, block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((ids, d)) if i != q][:10]
        own = sorted(got[ids[q]])
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert all(abs(s - d[np.flatnonzero(ids == v)[0]]) < 1e-12 for _, v, s in own)
        hit += len({v for _, v, _ in own} & set(ids[want]))
        total += 10
    assert hit >= 0.9 * total


def test_copies_ties_and_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, rank int, score double, entry long"
    row = lambda i, v: (i, v, 1, 2.0, 3)
    rows = [row(i, [1.0, 2.0]) for i in range(100, 140)] + [row(1, [0.0, 0.0]), row(2, None), row(3, [float("nan"), 1.0]), row(4, [None, 1.0]),
            row(5, []), row(None, [1.0, 1.0]), row(6, [1.0]), row(7, [float("inf"), 0.0]), row(8, [3.0, 2.0]), row(9, [-1.0, 2.0]), row(9, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, schema)
    got = {}
    for r in hilbert.neighbours(df, df.where("vec_id in (8, 9, 120, 1, 2)")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == {8, 9, 120}
    assert got[120] == [(i, 0.0) for i in range(100, 110)]
    assert got[8] == [(i, 2.0) for i in range(100, 110)] and [v for v, _ in got[9]] == list(range(100, 110))
    assert hilbert.neighbours(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id in (8, 100)")
    assert [(r.query_id, r.vec_id) for r in hilbert.neighbours(few, few).orderBy("query_id").collect()] == [(8, 100), (100, 8)]


def test_every_tie_is_ranked_exactly():
    rng = np.random.default_rng(3)
    binary = np.unique(rng.integers(0, 2, (1700, 16)).astype(float), axis=0)
    spread = rng.normal(size=(500, 16))
    for x in (binary, np.eye(300), np.round(spread * 2) / 2, spread + 1e7, np.vstack([spread, spread[:1] * 1e9])):
        ids = rng.permutation(len(x))
        q = x[:60]
        for (got, score), one in zip(hilbert.nearest(q, x, ids, 11), q):
            d = np.sqrt(((x - one) ** 2).sum(1))
            want = np.lexsort((ids, d))[:11]
            assert got.tolist() == ids[want].tolist() and np.array_equal(score, d[want])


def test_recall_with_outliers_and_clusters(spark):
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(3000, 64))
    unit /= np.sqrt((unit ** 2).sum(1))[:, None]
    far = unit.copy()
    far[5] *= 1e4
    clustered = rng.normal(size=(5, 64))[rng.integers(0, 5, 3000)] * 100 + unit
    for x in (far, clustered):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        got = {}
        for r in hilbert.neighbours(df, df.where("vec_id % 60 = 0"), least=40, block=64).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        hit = 0
        for q in range(0, 3000, 60):
            d = ((x - x[q]) ** 2).sum(1)
            hit += len(got[q] & set(np.argsort(d, kind="stable")[1:11].tolist()))
        print("recall", hit / 500)
        assert hit >= 0.9 * 500


def test_ids_that_repeat_more_often_than_k(spark):
    rows = [(1, [1.0, 2.0])] * 14 + [(i, [1.0, 2.0]) for i in range(2, 20)] + [(50, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hilbert.neighbours(df, df.where("vec_id in (1, 50)")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 3)) for r in got] == (
        [(1, i, i + 1, 0.0) for i in range(1, 11)] + [(50, i, i, 2.236) for i in range(1, 11)])
