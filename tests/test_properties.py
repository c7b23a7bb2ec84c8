"""Properties of the similarity operators (hypothesis-generated sets)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.functions.expr import jaccard
from cohortlens.operators.similarity import diagnosis_similarity_expr, top_k

codes = st.lists(st.sampled_from(list("ABCDEFG")), max_size=5)
rows = st.lists(st.tuples(st.sampled_from(["I10", "J18", None]), codes, codes), min_size=2, max_size=12)


@settings(max_examples=15, deadline=None)
@given(rows)
def test_diagnosis_similarity_properties(spark, data):
    schema = ("hadm_id long, primary_diagnosis_icd string, diagnoses_icd_list array<string>, "
              "diagnoses_3digit_list array<string>")
    df = spark.createDataFrame([(i, p, a, b) for i, (p, a, b) in enumerate(data)], schema)
    q = {"primary_diagnosis_icd": data[0][0], "diagnoses_icd_list": data[0][1], "diagnoses_3digit_list": data[0][2]}
    scored = df.select("hadm_id", diagnosis_similarity_expr(q).alias("s"))
    got = {r.hadm_id: r.s for r in scored.collect()}
    assert all(0.0 <= v <= 1.0 + 1e-12 for v in got.values())
    # self-similarity is 1 when every part is defined
    if data[0][0] is not None and data[0][1] and data[0][2]:
        assert abs(got[0] - 1.0) < 1e-12
    # top-k equals sort-then-head under the (score desc, id desc) order
    k = 3
    head = [i for i, _ in sorted(got.items(), key=lambda kv: (-kv[1], -kv[0]))[:k]]
    assert [r.hadm_id for r in top_k(scored, "s", k).collect()] == head


@settings(max_examples=15, deadline=None)
@given(codes, codes)
def test_jaccard_symmetric(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    r = df.select(jaccard(F.array_distinct("a"), F.array_distinct("b")).alias("x"),
                  jaccard(F.array_distinct("b"), F.array_distinct("a")).alias("y")).first()
    assert r.x == r.y
