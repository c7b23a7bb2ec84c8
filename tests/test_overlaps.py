"""Overlap statistics from subset counts against all pairs."""
import itertools
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.evaluate import outcome_alignment
from cohortlens.operators.overlaps import pair_totals, shared_pairs, signatures

SCHEMA = "hadm_id long, diagnoses_icd_list array<string>, mortality int, los_days int, icd_version_mix string"


def rows(seed=3, n=70, codes="ABCDEFGHIJ", most=7):
    r = random.Random(seed)
    out = [(i, r.sample(codes, r.randint(0, most)), r.randint(0, 1), r.choice([0, 1, 1, 2, 9]), r.choice(["v9", "v10", None])) for i in range(n)]
    out += [(n + i, ["A", "B"], 1, 1, "v9") for i in range(30)]  # a third of equal rows
    return out + [(1000, None, 1, 2, "v9"), (1001, ["A", "A", None], 0, 2, "v9"), (1002, ["A"], None, None, "v9")]


def clean(s):
    return {x for x in s or [] if x is not None}


@pytest.mark.parametrize("most_items", [12, 3, 1])
@pytest.mark.parametrize("outcome, same", [("mortality", False), ("los_days", True)])
def test_shared_pairs_equal_all_pairs(spark, most_items, outcome, same):
    rate = 0.05 if outcome == "los_days" else None
    df = spark.createDataFrame(rows(), SCHEMA)
    at = 2 if outcome == "mortality" else 3
    own = [r for r in rows() if r[at] is not None and (not same or r[4])]
    sigs = signatures(df.where(F.col(outcome).isNotNull() & (F.lit(not same) | F.col("icd_version_mix").isNotNull())),
                      "diagnoses_icd_list", outcome, F.col("icd_version_mix") if same else F.lit("all"))
    want, n, total = defaultdict(lambda: [0, 0.0]), 0, 0.0
    for p, q in itertools.permutations(own, 2):
        if same and p[4] != q[4]:
            continue
        agree = math.exp(-0.05 * abs(p[at] - q[at])) if rate else float(p[at] == q[at])
        n, total = n + 1, total + agree
        k = len(clean(p[1]) & clean(q[1]))
        if k:
            cell = want[len(clean(p[1])), len(clean(q[1])), k]
            cell[0] += 1
            cell[1] += agree
    got = {(r.a, r.b, r.k): [int(r.pairs), r.agree] for r in shared_pairs(sigs, rate, most_items).collect()}
    assert got.keys() == want.keys()
    assert all(got[c][0] == want[c][0] and got[c][1] == pytest.approx(want[c][1]) for c in want)
    totals = pair_totals(sigs, rate).first()
    assert totals.N * 2 == n and totals.Y * 2 == pytest.approx(total)


def test_summary_does_not_depend_on_the_split(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    a, b = (outcome_alignment(df, "los_days", same_version_only=True, most_items=m)[0].first().asDict() for m in (12, 2))
    assert a == pytest.approx(b)


def test_sample_and_empty(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert outcome_alignment(df, "mortality", sample_size=10)[0].first().sampled_patients == 10
    summary, bands = outcome_alignment(df.limit(0), "mortality")
    s = summary.first()
    assert s.pair_count == 0 and s.correlation is None
    assert [r.pair_count for r in bands.orderBy("band").collect()] == [0] * 5


def test_no_pair_join_for_short_sets(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = shared_pairs(signatures(df, "diagnoses_icd_list", "mortality", F.lit("all")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
