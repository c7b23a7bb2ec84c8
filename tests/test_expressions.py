import math

from pyspark.sql import functions as F

from cohortlens.functions.expr import duration_closeness, intensity_label_bins, jaccard
from cohortlens.operators.similarity import diagnosis_similarity_expr


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_jaccard_flavours(spark):
    schema = "a array<string>, b array<string>"
    assert _one(spark, jaccard("a", "b"), schema, ([], [])) == 0.0
    assert _one(spark, jaccard("a", "b", both_empty=1.0), schema, ([], [])) == 1.0
    assert _one(spark, jaccard("a", "b", both_empty=1.0), schema, (["x"], [])) == 0.0
    assert math.isclose(_one(spark, jaccard("a", "b"), schema, (["A", "B"], ["B", "C"])), 1 / 3)


def test_null_primary_gives_lists_only(spark):
    q = {"primary_diagnosis_icd": None, "diagnoses_icd_list": ["A", "B"], "diagnoses_3digit_list": ["9_A"]}
    schema = "primary_diagnosis_icd string, diagnoses_icd_list array<string>, diagnoses_3digit_list array<string>"
    v = _one(spark, diagnosis_similarity_expr(q), schema, (None, ["B", "A"], ["9_A"]))
    assert math.isclose(v, 0.6)


def test_duration_and_bins(spark):
    assert math.isclose(_one(spark, duration_closeness("a", "b"), "a int, b int", (3, 6)), 0.5)
    assert _one(spark, duration_closeness("a", "b"), "a int, b int", (None, 0)) == 1.0
    schema = "s double, n int"
    assert _one(spark, intensity_label_bins("s", "n"), schema, (0.33, 0)) == "Low"
    assert _one(spark, intensity_label_bins("s", "n"), schema, (0.34, 0)) == "Medium"
    assert _one(spark, intensity_label_bins("s", "n"), schema, (0.52, 1)) == "High"
    assert _one(spark, intensity_label_bins("s", "n"), schema, (0.0, 0)) == "Low"
