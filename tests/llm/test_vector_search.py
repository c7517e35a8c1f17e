import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import vector_search as vs


def plain(rows, k=10):
    """rows: (vec_id, vector or None) -> sorted (query_id, rank, vec_id, score)"""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(kept):
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(kept) if m != n and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, row int, shard string")
    return sorted(tuple(r) for r in vs.top_k(df, F.col("vec_id") % 100 == 0, **options).collect())


@pytest.mark.parametrize("dim,shard", [(4, 40), (16, 60), (1, 30)])
def test_random_vectors_over_many_shards(spark, dim, shard):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist()) for i in range(-100, 420)]
    assert found(spark, rows, shard_rows=shard, leaf_rows=5, query_rows=2) == plain(rows)


def test_ties_repeats_and_unsound_rows(spark):
    rng = np.random.default_rng(7)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same if i % 3 else rng.normal(size=3).round(1).tolist()) for i in range(301)]
    rows += [(100, same), (100, same), (None, same), (700, None), (800, [0.1, None, 0.2]), (900, [0.1, float("nan"), 0.2]), (1000, [float("inf"), 0.0, 0.0]), (1100, [0.5]), (1101, [0.25]), (1200, []), (1300, [1e7, 2e7, -3e7])]
    assert found(spark, rows, shard_rows=50, leaf_rows=4) == plain(rows)
    assert found(spark, rows) == plain(rows)


def test_few_and_no_rows(spark):
    assert found(spark, [(0, [1.0, 2.0])]) == []
    assert found(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])]) == [(0, 1, 1, 2 * 1024 * 1024), (0, 2, 2, -1024 * 1024)]
    assert vs.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).count() == 0


def test_tree_bounds_are_tight_and_prune():
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.integers(0, 10, (500, 3)) + c for c in (0, 1000, -1000)])
    tree = vs.Tree(np.arange(len(v)), np.arange(len(v)), v, 20)
    for node, (a, z) in enumerate(tree.span):
        assert (tree.lo[node] == tree.vectors[a:z].min(axis=0)).all() and (tree.hi[node] == tree.vectors[a:z].max(axis=0)).all()
    q = np.array([[5, 5, 5]])
    best = next(tree.search(q, np.array([-1]), [None], 10))
    assert [s for s, _, _ in best] == sorted(-(v @ q[0]))[:10]
    assert next(tree.search(q, np.array([-1]), [(best[4][0], best[4][1])], 10)) == best[:5]
