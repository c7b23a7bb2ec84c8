import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.running import md5_bucket, quantile_bucket, running_sums
from cohortlens.operators.evaluate import (band_edges, classification_metrics, outcome_alignment,
                                           stratified_split, tune_threshold)


def test_running_sums_matches_cumsum(spark):
    rnd = random.Random(1)
    rows = [(g, rnd.randint(0, 50), i, rnd.randint(1, 5)) for i, g in enumerate(rnd.choices(["a", "b"], k=300))]
    df = spark.createDataFrame(rows, "g string, o int, id int, v int")
    out = running_sums(df, ["g"], [F.col("o"), F.col("id")], ["v"], bucket=quantile_bucket(df, F.col("o"), 8))
    got = {r.id: r.cum_v for r in out.collect()}
    for g in ("a", "b"):
        acc = 0
        for _, o, i, v in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])):
            acc += v
            assert got[i] == acc


def test_md5_bucket_is_monotone(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("h"))
    rows = df.select("h", md5_bucket(F.col("h")).alias("b")).collect()
    ordered = sorted(rows, key=lambda r: r.h)
    assert all(a.b <= b.b for a, b in zip(ordered, ordered[1:]))


def _brute_alignment(sample, bins):
    pairs = []
    for (ia, sa, ya), (ib, sb, yb) in itertools.combinations(sorted(sample), 2):
        u = len(set(sa) | set(sb))
        x = len(set(sa) & set(sb)) / u if u else 0.0
        pairs.append((x, float(ya == yb)))
    return pairs


def test_alignment_closed_form_equals_all_pairs(spark):
    rnd = random.Random(3)
    codes = list("ABCDEFGH")
    rows = [(i, rnd.sample(codes, rnd.randint(0, 3)), rnd.randint(0, 1), "mixed") for i in range(60)]
    df = spark.createDataFrame(rows, "hadm_id long, diagnoses_icd_list array<string>, mortality int, "
                                     "icd_version_mix string")
    summary, bands = outcome_alignment(df, "mortality", sample_size=1000, bins=5)
    s = summary.first()
    pairs = _brute_alignment([(r[0], r[1], r[2]) for r in rows], 5)
    n = len(pairs)
    assert s.pair_count == n
    mx = sum(p[0] for p in pairs) / n
    my = sum(p[1] for p in pairs) / n
    cov = sum((x - mx) * (y - my) for x, y in pairs)
    vx = sum((x - mx) ** 2 for x, _ in pairs)
    vy = sum((y - my) ** 2 for _, y in pairs)
    assert s.mean_similarity == pytest.approx(mx)
    assert s.correlation == pytest.approx(cov / math.sqrt(vx * vy))
    edges = band_edges(5)
    counts = [0] * 5
    for x, _ in pairs:
        counts[next(i for i in range(5) if x <= edges[i + 1])] += 1
    assert [r.pair_count for r in bands.orderBy("band").collect()] == counts


def test_auc_and_threshold_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [("m", rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(80)]
    df = spark.createDataFrame(rows, "model string, label int, score double").withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int"))
    m = classification_metrics(df).first()
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    u = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    assert m.roc_auc == pytest.approx(u / (len(pos) * len(neg)))
    best = None
    for t in sorted(set([0.5] + [s for *_, s in rows])):
        pred = [(y, int(s >= t)) for _, y, s in rows]
        tp = sum(1 for y, p in pred if y == 1 and p == 1)
        fp = sum(1 for y, p in pred if y == 0 and p == 1)
        fn = sum(1 for y, p in pred if y == 1 and p == 0)
        acc = sum(1 for y, p in pred if y == p) / len(pred)
        f1 = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
        if best is None or acc > best[1] or (acc == best[1] and f1 > best[2]):
            best = (t, acc, f1)
    got = tune_threshold(df).first()
    assert got.threshold == pytest.approx(best[0]) and got.tuned


def test_stratified_split_exact_counts(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(203)], "hadm_id long, y int")
    out = stratified_split(df, "y", 0.2, 42)
    counts = {(r.y, r.is_test): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    n1, n0 = 51, 152
    assert counts[(1, True)] == math.floor(n1 * 0.2 + 0.5)
    assert counts[(0, True)] == math.floor(n0 * 0.2 + 0.5)
