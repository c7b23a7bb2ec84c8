import math
import random

import numpy as np
import pytest

from cohortlens.operators.cosine import KNN_NUMERIC, knn_neighbours
from cohortlens.operators.neighbours import neighbour_vote


def test_neighbour_vote_matches_brute_force(spark):
    rnd = random.Random(11)
    dx, rx = list("ABCDEF"), ["a", "b", "c"]
    rows = []
    for i in range(40):
        rows.append((i, rnd.sample(dx, rnd.randint(1, 3)), [], None, 60, 2, 0.5, "F", "X",
                     rnd.sample(rx, rnd.randint(0, 2)), rnd.sample(["p1", "p2"], rnd.randint(0, 1)), rnd.randint(0, 1)))
    schema = ("hadm_id long, diagnoses_icd_list array<string>, diagnoses_3digit_list array<string>, "
              "primary_diagnosis_icd string, age int, diagnosis_count long, treatment_complexity_score double, "
              "gender string, race string, rx_drug_list array<string>, proc_icd_list array<string>, mortality int")
    df = spark.createDataFrame(rows, schema)
    train, test = df.filter("hadm_id >= 10"), df.filter("hadm_id < 10")
    got = {r.hadm_id: r.score for r in neighbour_vote(train, test, "mortality", top_k=5).collect()}

    def jac(a, b):
        u = len(set(a) | set(b))
        return len(set(a) & set(b)) / u if u else 0.0

    base = np.mean([r[-1] for r in rows if r[0] >= 10])
    for q in (r for r in rows if r[0] < 10):
        tq = {"rx:" + x for x in q[9]} | {"proc:" + x for x in q[10]}
        sims = []
        for c in (r for r in rows if r[0] >= 10):
            tc = {"rx:" + x for x in c[9]} | {"proc:" + x for x in c[10]}
            s = 0.6 * jac(q[1], c[1]) + 0.4 * jac(tq, tc)
            if s > 0:
                sims.append((-s, c[0], c[-1]))
        top = sorted(sims)[:5]
        want = sum(s * s * y for s, _, y in top) / sum(s * s for s, _, _ in top) if top else base
        assert got[q[0]] == pytest.approx(want)


def test_cosine_matches_dense_vectors(spark):
    rnd = random.Random(2)
    codes, groups = list("ABCDE"), ["g1", "g2"]
    rows = []
    for i in range(30):
        rows.append((i, i, rnd.choice([30, 50, 70]), rnd.choice(["F", "M"]), rnd.choice(["X", "Y"]),
                     rnd.choice([None, 20.0, 30.0]), 120.0, 80.0, rnd.randint(1, 4), rnd.randint(1, 3), 0.5,
                     sorted(rnd.sample(codes, 2)), sorted(rnd.sample(groups, 1)), 3))
    schema = ("hadm_id long, subject_id long, age int, gender string, race string, bmi double, systolic_bp double, "
              "diastolic_bp double, diagnosis_count long, unique_icd_count long, diagnosis_diversity_ratio double, "
              "diagnoses_icd_list array<string>, diagnoses_3digit_list array<string>, los_days long")
    df = spark.createDataFrame(rows, schema)
    got = knn_neighbours(df, None, k=5).collect()
    cols = {c: i for i, c in enumerate(schema.replace(",", "").split()[::2])}
    num = np.array([[np.nan if r[cols[c]] is None else float(r[cols[c]]) for c in KNN_NUMERIC] for r in rows])
    med = np.nanmedian(num, axis=0)
    num = np.where(np.isnan(num), med, num)
    sd = num.std(axis=0)
    z = (num - num.mean(axis=0)) / np.where(sd > 0, sd, 1.0)

    def vec(i):
        r = rows[i]
        onehot = [float(r[3] == g) for g in ("F", "M")] + [float(r[4] == x) for x in ("X", "Y")]
        multi = [float(g in r[12]) for g in groups] + [float(c in r[11]) for c in codes]
        return np.concatenate([z[i], onehot, multi])

    q = vec(0)
    dists = sorted((1 - float(q @ vec(i) / (np.linalg.norm(q) * np.linalg.norm(vec(i)))), i) for i in range(1, 30))
    assert [r.hadm_id for r in got] == [i for _, i in dists[:5]]
    assert [r.distance for r in got] == pytest.approx([d for d, _ in dists[:5]])
    assert math.isclose(got[0].similarity, min(max(1 - dists[0][0], 0), 1))
