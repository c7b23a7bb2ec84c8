"""Diagnosis feature table (one row per admission)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import code_group
from cohortlens.session import materialize


def dedupe_dictionary(dictionary: DataFrame, title: str = "long_title") -> DataFrame:
    """J6 prerequisite: one title per (trimmed code, version), or counts inflate."""
    return (dictionary.select(F.trim("icd_code").alias("d_code"), F.col("icd_version").alias("d_version"),
                              F.col(title).alias("long_title"))
            .groupBy("d_code", "d_version").agg(F.min("long_title").alias("long_title")))


def diagnosis_features(diagnoses_icd: DataFrame, base: DataFrame, dictionary: DataFrame) -> DataFrame:
    """J5, J6, A4, A8, A10, A12, A13.

    ``diagnoses_icd`` needs hadm_id, seq_num, icd_code, icd_version and may
    carry ``icd_group`` (else the version-prefixed first three characters).
    The primary code and group come from the same row: lowest seq_num (null
    last), then smallest code, group and title; the title is the first
    non-null one in that order.  A row with a null code counts as a diagnosis
    but is in no list and never primary while another row has a code.

    Codes are grouped per admission before titles are looked up, so the
    dictionary meets one row per (admission, code, version) instead of every
    event.
    """
    group = F.col("icd_group") if "icd_group" in diagnoses_icd.columns else code_group("icd_version", "icd_code")
    d = diagnoses_icd.select("hadm_id", "seq_num", F.trim("icd_code").alias("icd_code"), "icd_version", group.alias("grp"))
    d = d.join(base.select("hadm_id", "subject_id"), "hadm_id")  # base is unique per hadm_id: acts as a semi join
    rank = F.struct(F.col("icd_code").isNull().alias("no_code"), F.col("seq_num").isNull().alias("no_seq"), "seq_num", "icd_code", "grp")
    coded = (d.groupBy("hadm_id", "subject_id", "icd_code", "icd_version")
             .agg(F.min(rank).alias("rank"), F.count(F.lit(1)).alias("n"), F.collect_set("grp").alias("groups")))
    # Written once, so that its size is known and a small one is sent to the tasks.
    titles = materialize(dedupe_dictionary(dictionary))
    coded = coded.join(titles, (coded.icd_code == titles.d_code) & (coded.icd_version == titles.d_version), "left")
    agg = coded.groupBy("hadm_id", "subject_id").agg(
        F.min("rank").alias("p"),
        F.min(F.when(F.col("long_title").isNotNull(), F.struct("rank", "long_title"))).alias("pt"),
        F.sum("n").alias("diagnosis_count"),
        F.array_sort(F.collect_set("icd_code")).alias("diagnoses_icd_list"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("groups")))).alias("diagnoses_3digit_list"),
        F.min("icd_version").alias("vmin"), F.max("icd_version").alias("vmax"))
    mix = (F.when((F.col("vmin") == 9) & (F.col("vmax") == 9), F.lit("ICD9_only"))
           .when((F.col("vmin") == 10) & (F.col("vmax") == 10), F.lit("ICD10_only"))
           .otherwise(F.lit("mixed")))
    unique = F.size("diagnoses_icd_list").cast("long")
    return agg.select(
        "hadm_id", "subject_id",
        F.col("p.icd_code").alias("primary_diagnosis_icd"),
        F.col("pt.long_title").alias("primary_diagnosis_title"),
        F.col("p.grp").alias("primary_icd_3digit"),
        "diagnosis_count", unique.alias("unique_icd_count"), "diagnoses_icd_list", "diagnoses_3digit_list",
        mix.alias("icd_version_mix"),
        F.try_divide(unique.cast("double"), F.col("diagnosis_count").cast("double")).alias("diagnosis_diversity_ratio"))
