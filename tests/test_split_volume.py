"""The split compares rows with the edge of their class; the vote's matrix-free top k."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators.evaluate import stratified_split
from cohortlens.operators.neighbours import smallest


def test_rows_of_the_split_are_not_shuffled(spark):
    df = spark.range(500).select(F.col("id").alias("hadm_id"), (F.col("id") % 3).alias("y"), F.lit("wide").alias("more"))
    out = stratified_split(df, "y", 0.2, 42)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("size", [0.0, 0.2, 0.5, 1.0])
def test_split_equals_ranks_with_nulls_and_repeated_ids(spark, size):
    rows = [(i % 40 if i < 30 else i, [0, 1, 1, None][i % 4]) for i in range(200)] * 2 + [(None, 1), (7, 0), (7, 1)]
    got = stratified_split(spark.createDataFrame(rows, "hadm_id long, y int"), "y", size, 42)
    assert got.columns == ["y", "hadm_id", "is_test"]
    found = {}
    for r in got.collect():
        found.setdefault((r.y, r.hadm_id), []).append(r.is_test)
    for y in (0, 1):
        ids = sorted((i for i, label in rows if label == y and i is not None),
                     key=lambda i: (hashlib.md5(f"{i}42".encode()).hexdigest(), i))
        first = ids[: math.floor(len(ids) * size + 0.5)]
        assert {i for label, i in found if label == y} == set(ids)
        for i in set(ids):
            assert len(found[y, i]) == ids.count(i) and sum(found[y, i]) == first.count(i)


def test_smallest_equals_a_stable_sort():
    x = np.random.default_rng(3).integers(0, 6, (40, 30)) / 4.0
    for k in (1, 5, 29, 30, 50):
        row, column = smallest(x, k)
        order = np.argsort(x, axis=1, kind="stable")[:, :k]
        assert row.tolist() == np.repeat(np.arange(40), order.shape[1]).tolist()
        assert column.tolist() == order.ravel().tolist()
    row, column = smallest(x, 5, x < 1)
    assert (x[row, column] < 1).all()
