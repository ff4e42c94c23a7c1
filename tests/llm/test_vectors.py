"""Neighbour search on hand-made tables."""

import numpy as np

from quoteloom.llm import neighbours


def table(spark, vectors, ids=None):
    rows = [(i, v, 1) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int")


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [[1.0, 0.0], [0.0, 1.0], None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], [], [2.0, 0.0], [2.0, 0.0], [-1.0, 0.0]]
    vectors = table(spark, rows + [[5.0, 5.0]], [*range(len(rows)), None])
    found = neighbours.nearest(vectors, vectors, k=3).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == [0, 1, 9, 10, 11]
    assert got[0] == [(9, 2.0), (10, 2.0), (1, 0.0)]
    assert got[9] == [(10, 4.0), (0, 2.0), (1, 0.0)]
    assert got[1] == [(0, 0.0), (9, 0.0), (10, 0.0)]
    assert neighbours.nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    assert neighbours.nearest(vectors.where("vec_id = 0"), vectors.where("vec_id = 0")).count() == 0


def test_unequal_norms_copies_and_chunks(spark):
    """Inner products of vectors of all lengths, a hot group of copies, cells in many chunks."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 16)) * rng.uniform(0.2, 3, size=(900, 1))
    vectors[300:600] = vectors[300]
    rows = table(spark, vectors.tolist())
    found = neighbours.nearest(rows.repartition(3), rows.where("vec_id % 20 = 0"), k=10, chunk_rows=64).toPandas()
    hits = []
    for q in range(0, 900, 20):
        score = (vectors * vectors[q]).sum(axis=1)
        score[q] = -np.inf
        edge = np.sort(score)[-10]
        own = found[found.query_id == q]
        assert len(own) == 10 and q not in set(own.vec_id)
        hits.append((own.score >= edge - 1e-9).mean())
    assert np.mean(hits) >= 0.9
