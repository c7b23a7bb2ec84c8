"""Plan-shape checks: what reaches the scan, join strategies, exchange keys."""

import os
import re

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(plan: str, table: str) -> str:
    return next(line for line in plan.splitlines() if "FileScan parquet" in line and f"{table}.parquet" in line)


def columns(scan: str) -> set[str]:
    return {c.split("#")[0].strip() for c in re.search(r"FileScan parquet \[([^\]]*)\]", scan)[1].split(",")}


def test_measurements_read_only_their_columns(spark):
    from cohortlens.operators.measurements import daily_latest
    from cohortlens.sources.tpch import raw_tables

    plan = plan_of(daily_latest(raw_tables(spark, SF).omr))
    assert columns(scan_of(plan, "lineitem")) == {
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"}
    assert columns(scan_of(plan, "orders")) == {"o_orderkey", "o_custkey"}
    assert "IsNotNull(l_orderkey)" in scan_of(plan, "lineitem")
    # one partial aggregate, then one exchange on subject, type and day
    assert len(re.findall(r"Exchange hashpartitioning\(subject_id#\d+L?, result_name#\d+, chartdate#\d+", plan)) == 1


def test_topk_is_take_ordered_over_one_scan(spark):
    from cohortlens.operators.similarity import find_similar_diagnoses
    from cohortlens.plans.features import Features

    plan = plan_of(find_similar_diagnoses(Features(spark, SF).dx, None, k=5))
    assert "TakeOrderedAndProject(limit=5" in plan
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "Join" not in plan


def test_titles_meet_counted_codes(spark):
    """The dictionary join stands above the per-code aggregate, so a hot code is
    partially aggregated instead of shuffled row by row."""
    from cohortlens.operators.codes import diagnosis_features

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = spark.range(10).select(F.col("id").alias("hadm_id"), F.col("id").cast("int").alias("seq_num"),
                                    F.concat(F.lit("c"), F.col("id") % 3).alias("icd_code"), (F.col("id") % 2 + 9).cast("int").alias("icd_version"))
        base = spark.range(10).select(F.col("id").alias("hadm_id"), F.col("id").alias("subject_id"))
        titles = spark.range(3).select(F.col("id").cast("string").alias("icd_code"), (F.col("id") % 2 + 9).cast("int").alias("icd_version"),
                                      F.col("id").cast("string").alias("long_title"))
        plan = plan_of(diagnosis_features(d, base, titles))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "LeftOuter" in x)
    counted = next(i for i, x in enumerate(lines) if "Aggregate" in x and "icd_code" in x and "icd_version" in x and "count(1)" in x)
    assert join < counted  # plans print the last operator first


def test_treatment_features_do_not_read_the_dictionary(spark):
    from cohortlens.operators import treatments
    from cohortlens.sources.tpch import raw_tables

    r = raw_tables(spark, SF)
    assert "long_title" not in plan_of(treatments._procedure_features(r.procedures_icd, r.d_icd_procedures, False))
    assert "long_title" in plan_of(treatments._procedure_features(r.procedures_icd, r.d_icd_procedures, True))


def test_vote_is_one_pass_without_pairs(spark):
    from cohortlens.operators.neighbours import cosine_knn, neighbour_vote  # noqa: F401
    from cohortlens.plans.features import Features

    clin = Features(spark, SF).clin
    plan = plan_of(neighbour_vote(clin.where("hadm_id % 5 <> 0"), clin.where("hadm_id % 5 = 0"), fit_rows=2000))
    assert "MapInArrow" in plan and "Generate" not in plan and "CartesianProduct" not in plan


def test_vote_against_all_rows_has_no_nested_loop(spark):
    from cohortlens.operators.neighbours import neighbour_vote
    from cohortlens.operators.similarity import batch_similar_diagnoses
    from cohortlens.plans.features import Features

    f = Features(spark, SF)
    for plan in (plan_of(neighbour_vote(f.clin.where("hadm_id % 5 <> 0"), f.clin.where("hadm_id % 5 = 0"))),
                 plan_of(batch_similar_diagnoses(f.dx, f.dx.where("hadm_id % 50 = 0")))):
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "MapInArrow" not in plan
        assert "WindowGroupLimit" in plan


def test_a_probe_is_one_row_for_all_types(spark):
    """The as-of lookup deals a probe once, not once for each measurement type."""
    from cohortlens.operators.measurements import daily_latest, latest_as_of
    from cohortlens.sources.tpch import raw_tables

    daily = daily_latest(raw_tables(spark, SF).omr)
    day = F.lit("1997-01-01").cast("date")
    probes = spark.range(5).select(F.col("id").alias("hadm_id"), F.col("id").alias("subject_id"), day.alias("admit_day"), F.lit("t2").alias("kind"), day.alias("b"))
    found = latest_as_of(probes, daily)
    assert "Generate" not in plan_of(found) and found.count() == 5
    assert [c for c in found.columns if c.startswith("ord_")] == ["ord_0", "ord_1", "ord_2", "ord_3"]


def test_joins_below_several_passes_run_once(spark):
    from cohortlens.operators.dataset import joined_dataset, modelling_flags
    from cohortlens.plans.features import Features

    f = Features(spark, SF)
    for df in (f.cohort, f.knn, modelling_flags(joined_dataset(f.base, f.dx, None))):
        assert "Join" not in plan_of(df)
