from cohortlens.operators.treatments import load_treatment_features
from cohortlens.sources.io import table_or_fallback


def test_schema_dispatch_uses_existing_aggregate(spark):
    agg = spark.createDataFrame(
        [(1, ["b", "a", None, ""], ["549"], 2, 1, 3, 1, 0.5), (2, None, [], 1, 0, 1, 0, 0.0)],
        "hadm_id long, rx_drug_list array<string>, proc_icd_list array<string>, rx_unique_drugs long, "
        "proc_count long, treatment_days long, surgery_count long, rx_iv_ratio double")
    out = {r.hadm_id: r for r in load_treatment_features(agg, None, None, None, None).collect()}
    assert out[1].rx_drug_list == ["a", "b"] and out[2].rx_drug_list == []
    assert out[1].treatment_intensity_label == "High"           # surgery bonus
    assert 0.0 <= out[2].treatment_complexity_score <= 1.0


def test_table_or_fallback(spark):
    spark.range(3).createOrReplaceTempView("cohortlens_test_view")
    assert table_or_fallback(spark, "cohortlens_test_view", lambda: spark.range(0)).count() == 3
    assert table_or_fallback(spark, "cohortlens_missing_table", lambda: spark.range(5)).count() == 5
