"""Nearest neighbours against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelhouse.llm import vector_search as vs


def _frame(spark, ids, x):
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")


def _found(spark, ids, x, k=20, **kw):
    got = defaultdict(list)
    for r in vs.search(_frame(spark, ids, x), F.col("vec_id") % 20 == 0, k, **kw).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    return got


def _exact(ids, x, q, k=20):
    x = np.asarray(x, np.float32).astype(float)
    score = x @ x[ids.tolist().index(q)]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
    return [int(ids[i]) for i in order], [score[i] for i in order]


def test_clustered_vectors_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(vs, "LEAF_ROWS", 40)
    monkeypatch.setattr(vs, "CHUNK", 50)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    ids = rng.permutation(6000)[:3000]
    got = _found(spark, ids, x)
    hits = total = 0
    for q in ids[ids % 20 == 0].tolist():
        near, _ = _exact(ids, x, q)
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        hits, total = hits + len(set(near) & {i for _, i, _ in got[q]}), total + 20
    assert hits / total >= 0.9


def test_equal_vectors_and_ties_are_exact(spark):
    """A third of all rows hold one vector; ties go to the smaller id, and no query finds itself."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[::3] = x[0]
    ids = np.arange(900)
    got = _found(spark, ids, x, recall=1.0)
    for q in range(0, 900, 20):
        near, score = _exact(ids, x, q)
        assert [i for _, i, _ in got[q]] == near
        assert np.allclose([s for _, _, s in got[q]], score, rtol=0, atol=1e-12)


def test_unusable_vectors_take_no_part(spark):
    good = np.random.default_rng(3).normal(size=(30, 4)).tolist()
    odd = [None, [0, 0, 0, 0], [1, None, 0, 0], [float("nan"), 1, 1, 1], [float("inf"), 1, 1, 1], [], [1, 2]]
    ids = [*range(30), *range(100, 100 + 20 * len(odd), 20)]
    got = _found(spark, np.array(ids), [*good, *odd])
    assert set(got) == {0, 20} and all(i < 30 for found in got.values() for _, i, _ in found)
    assert all(len(found) == 20 for found in got.values())


def test_few_rows_and_none(spark):
    got = _found(spark, np.array([0, 7]), [[1.0, 0.0], [0.5, 0.5]])
    assert got == {0: [(1, 7, 0.5)]}
    assert _found(spark, np.array([], int), []) == {}
    assert _found(spark, np.array([20]), [[1.0, 2.0]]) == {}
    assert _found(spark, np.array([1, 2]), [[1.0, 0.0], [0.0, 1.0]]) == {}


def test_best_bins_come_in_order_of_their_centres():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    tree = vs.fit_tree(x, 10)
    assert tree.leaves > 20 and set(vs.leaf_of(x, tree).tolist()) == set(range(tree.leaves))
    for v in x[:20]:
        assert sorted(vs.best_bins(v, tree, tree.leaves)) == list(range(tree.leaves))
        assert vs.best_bins(v, tree, 3) == vs.best_bins(v, tree, 5)[:3]
