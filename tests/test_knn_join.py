"""The kNN join against all distances, and the classifier on all training rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators.knn_join import knn_join
from cohortlens.operators.neighbours import cosine_knn

SCHEMA = "hadm_id long, v array<double>"


def table(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(a) for a in row]) for i, row in enumerate(x)], SCHEMA)


def brute(queries, points, k, same):
    out = {}
    ids = np.arange(len(points))
    for i, q in queries:
        diff = points - q
        d = np.sqrt((diff * diff).sum(1))
        keep = ids != i if same else ids >= 0
        order = np.lexsort((ids[keep], d[keep]))[:k]
        out[i] = [(int(a), float(b)) for a, b in zip(ids[keep][order], d[keep][order])]
    return out


def points(seed, kind):
    r = np.random.default_rng(seed)
    if kind == "clusters":
        return r.normal(size=(8, 6))[r.integers(0, 8, 900)] * 5 + r.normal(size=(900, 6)) * 0.2
    if kind == "grid":  # ties everywhere
        return r.integers(0, 3, size=(900, 3)).astype(float)
    x = r.normal(size=(900, 12)) + 1e4  # unstructured and far from the origin
    x[200:500] = x[7]  # a third are copies
    return x


@pytest.mark.parametrize("kind", ["clusters", "grid", "copies"])
@pytest.mark.parametrize("same", [True, False])
def test_equals_all_distances(spark, kind, same):
    x = points(3, kind)
    df = table(spark, x)
    got = {}
    for r in knn_join(df.where("hadm_id % 7 = 0"), df, 5, exclude_same_id=same, pivots=40, cell=64, block=20).collect():
        got.setdefault(r.query_id, []).append((r.id, r.distance))
    want = brute([(i, x[i]) for i in range(0, 900, 7)], x, 5, same)
    assert {i: [a for a, _ in sorted(v, key=lambda p: (p[1], p[0]))] for i, v in got.items()} == {i: [a for a, _ in v] for i, v in want.items()}
    assert all(np.allclose(sorted(b for _, b in got[i]), [b for _, b in v], rtol=1e-12, atol=1e-12) for i, v in want.items())


def test_most_cells_are_ruled_out(spark):
    from cohortlens.operators import knn_join as module

    x = points(5, "clusters")
    seen = []
    wrapped = module._visits
    module._visits = lambda *a: seen.append(wrapped(*a)) or seen[-1]
    try:
        knn_join(table(spark, x), table(spark, x), 3, pivots=40).collect()
    finally:
        module._visits = wrapped
    assert seen[0].count() < 900 * 40 / 4


def test_odd_vectors_few_rows_and_empty(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, []),
            (None, [0.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", cell string")
    got = sorted((r.query_id, r.id, r.distance) for r in knn_join(df.where("hadm_id < 8"), df, 9).collect())
    assert got == [(1, 2, 1.0), (1, 8, 1.0), (1, 8, 1.0), (2, 1, 1.0), (2, 8, 0.0), (2, 8, 0.0)]  # repeated rows count each
    assert knn_join(df, df.limit(0), 2).collect() == [] and knn_join(df.limit(0), df, 2).collect() == []
    with pytest.raises(Exception, match="length other than"):
        knn_join(df.where("hadm_id = 1"), df.unionByName(spark.createDataFrame([(9, [1.0], "")], SCHEMA + ", cell string")), 2).collect()


def test_classifier_on_all_rows(spark):
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(9)
    x = np.concatenate([r.normal(size=(500, 5)), np.zeros((3, 5))])
    x[100:140] = x[100] * 2.0 ** r.integers(-2, 3, size=(40, 1))  # one direction: distance 0, and ties for all others
    y = r.integers(0, 2, 503)
    df = spark.createDataFrame([(i, int(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))],
                               "hadm_id long, label int, f array<double>").withColumn("features", array_to_vector("f"))
    train, test = df.where("hadm_id % 4 > 0"), df.where("hadm_id % 4 = 0")
    got = {row.hadm_id: (row.label, row.score) for row in cosine_knn(train, test, k=7, fit_rows=None).collect()}
    size = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, size, out=np.zeros_like(x), where=size > 0)
    ids = np.array([i for i in range(503) if i % 4])
    for i in range(0, 503, 4):
        far = ((u[ids] - u[i]) ** 2).sum(1) / 2  # equal for equal rows, unlike 1 less a product
        far[(size[ids] == 0)[:, 0] | (size[i] == 0)] = 1
        far[far < 1e-12] = 0
        near = np.lexsort((ids, far))[:7]
        d, votes = far[near], y[ids][near]
        want = votes[d == 0].mean() if (d == 0).any() else (votes / d).sum() / (1 / d).sum()
        assert got[i][0] == y[i] and got[i][1] == pytest.approx(want), i
    nothing = cosine_knn(train.limit(0), test, fit_rows=None).agg(F.count("score").alias("n"), F.count("hadm_id").alias("rows")).first()
    assert (nothing.n, nothing.rows) == (0, 126)
