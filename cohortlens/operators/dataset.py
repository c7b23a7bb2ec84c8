"""Joined modelling datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.quantiles import exact_medians
from cohortlens.functions.expr import canonical_set
from cohortlens.operators.treatments import treatment_summary
from cohortlens.session import materialize

DIAGNOSIS_JOIN_COLUMNS = ["hadm_id", "primary_diagnosis_icd", "primary_icd_3digit", "diagnosis_count",
                          "unique_icd_count", "diagnosis_diversity_ratio", "diagnoses_icd_list",
                          "diagnoses_3digit_list", "icd_version_mix"]
TREATMENT_JOIN_COLUMNS = ["hadm_id", "procedure_list", "proc_icd_list", "proc_count", "proc_group_count",
                          "surgery_count", "rx_drug_list", "rx_routes_list", "route_diversity", "rx_drug_types",
                          "rx_total_count", "rx_unique_drugs", "rx_unique_formulary_drugs", "rx_iv_count",
                          "rx_oral_count", "rx_iv_ratio", "treatment_days", "avg_rx_duration_days",
                          "treatment_complexity_score", "treatment_intensity_label"]
SUMMARY_COLUMNS = ["treatment_row_count", "treatment_event_count", "unique_treatment_count",
                   "unique_treatment_source_count"]


def joined_dataset(base: DataFrame, dx: DataFrame, tall: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """J9 + J11 + P2 + P12: base with diagnoses (inner or left) and the
    per-admission treatment summary (left), defaults filled."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    df = base.join(dx.select(*DIAGNOSIS_JOIN_COLUMNS), "hadm_id", how)
    df = (df.withColumn("diagnoses_icd_list", canonical_set("diagnoses_icd_list"))
          .withColumn("diagnoses_3digit_list", canonical_set("diagnoses_3digit_list"))
          .withColumn("icd_version_mix", F.coalesce("icd_version_mix", F.lit("unknown")))
          .withColumn("diagnosis_count", F.coalesce("diagnosis_count", F.lit(0)).cast("long"))
          .withColumn("unique_icd_count", F.coalesce("unique_icd_count", F.lit(0)).cast("long"))
          .withColumn("diagnosis_diversity_ratio", F.coalesce("diagnosis_diversity_ratio", F.lit(0.0))))
    if tall is not None:
        df = df.join(treatment_summary(tall), "hadm_id", "left")
        for c in SUMMARY_COLUMNS:
            df = df.withColumn(c, F.coalesce(c, F.lit(0)).cast("long"))
    return df


def clinical_dataset(base: DataFrame, dx: DataFrame, tr: DataFrame) -> DataFrame:
    """Base, diagnoses and treatment features, inner on hadm_id."""
    return (base.join(dx.select(*DIAGNOSIS_JOIN_COLUMNS), "hadm_id")
            .join(tr.select(*TREATMENT_JOIN_COLUMNS), "hadm_id"))


def knn_dataset(base: DataFrame, dx: DataFrame) -> DataFrame:
    """J10 + P12: base left-joined to diagnoses on (subject, admission) with
    the defaults of the cosine kNN loader."""
    d = dx.select("subject_id", "hadm_id", "primary_diagnosis_icd", "primary_diagnosis_title",
                  "primary_icd_3digit", "diagnosis_count", "unique_icd_count", "icd_version_mix",
                  "diagnosis_diversity_ratio", "diagnoses_icd_list", "diagnoses_3digit_list")
    df = base.join(d, ["subject_id", "hadm_id"], "left")
    return df.select(
        "subject_id", "hadm_id", "age", F.coalesce("gender", F.lit("unknown")).alias("gender"),
        F.coalesce("race", F.lit("unknown")).alias("race"), "bmi", "systolic_bp", "diastolic_bp",
        "los_days", F.coalesce(F.col("mortality"), F.lit(0)).cast("int").alias("mortality"),
        *([F.coalesce("discharge_location", F.lit("unknown")).alias("discharge_location")]
          if "discharge_location" in df.columns else []),
        F.coalesce("primary_diagnosis_icd", F.lit("")).alias("primary_diagnosis_icd"),
        F.coalesce("primary_diagnosis_title", F.lit("")).alias("primary_diagnosis_title"),
        F.coalesce("primary_icd_3digit", F.lit("")).alias("primary_icd_3digit"),
        F.coalesce("diagnosis_count", F.lit(0)).cast("long").alias("diagnosis_count"),
        F.coalesce("unique_icd_count", F.lit(0)).cast("long").alias("unique_icd_count"),
        F.coalesce("icd_version_mix", F.lit("unknown")).alias("icd_version_mix"),
        F.coalesce("diagnosis_diversity_ratio", F.lit(0.0)).alias("diagnosis_diversity_ratio"),
        canonical_set("diagnoses_icd_list").alias("diagnoses_icd_list"),
        canonical_set("diagnoses_3digit_list").alias("diagnoses_3digit_list"))


def modelling_flags(df: DataFrame) -> DataFrame:
    """P20: elderly (> 65), high burden (> 10), age median-filled.

    The median is exact and comes from counted values.  Only the columns that
    are read are written once, so that joins below run once."""
    need = ["hadm_id", "age", "diagnosis_count", "diagnosis_diversity_ratio", *SUMMARY_COLUMNS]
    df = materialize(df.select(*[c for c in need if c in df.columns]))
    median = exact_medians(df, ["age"])["age"]
    out = df.withColumn("age_filled", F.coalesce(F.col("age").cast("double"), F.lit(median).cast("double")))
    cols = [F.col("hadm_id"), F.col("age_filled").alias("age"),
            (F.col("age_filled") > 65).cast("int").alias("elderly"),
            F.coalesce("diagnosis_count", F.lit(0)).cast("long").alias("diagnosis_count"),
            (F.coalesce("diagnosis_count", F.lit(0)) > 10).cast("int").alias("high_diagnosis_burden"),
            F.coalesce("diagnosis_diversity_ratio", F.lit(0.0)).alias("diagnosis_diversity_ratio")]
    cols += [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in SUMMARY_COLUMNS if c in df.columns]
    return out.select(*cols)
