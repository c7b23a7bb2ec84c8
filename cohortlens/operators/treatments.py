"""Treatment feature tables.

Two flavours exist and both are kept, chosen by function:

* ``treatment_features_capped``: regex noise filter, substring route flags,
  distinct start dates as treatment days, complexity with fixed caps and a
  rule-based intensity label.  Not restricted to the cohort.
* ``treatment_features_minmax``: LIKE noise filter, prefix route flags,
  repaired prescription times, span of days, complexity by data min-max and a
  binned label with a surgery bonus.  Restricted to the cohort.

Both keep only admissions with prescriptions *and* procedures (J7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import (complexity_capped, intensity_label_bins, intensity_label_rule,
                                       is_noise_drug_like, is_noise_drug_regex, route_flags_prefix,
                                       route_flags_substring, surgery_flag)
from cohortlens.operators.codes import dedupe_dictionary
from cohortlens.session import materialize

# Two-digit surgical chapters of version 9 codes: "01" to "86", built by rule.
SURGICAL_V9_PREFIXES = [f"{i:02d}" for i in range(1, 87)]


def _seconds(ts: str) -> F.Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def treatment_features_capped(prescriptions: DataFrame, procedures_icd: DataFrame,
                              d_icd_procedures: DataFrame, word_bounded_noise: bool = False) -> DataFrame:
    rx = prescriptions.filter(F.col("drug").isNotNull() & (F.col("drug") != "")
                              & ~is_noise_drug_regex("drug", word_bounded_noise)
                              & F.col("starttime").isNotNull())
    iv, oral = route_flags_substring("route")
    rx_f = rx.groupBy("subject_id", "hadm_id").agg(
        F.array_sort(F.collect_set(F.lower("drug"))).alias("rx_drug_list"),
        F.array_sort(F.collect_set("route")).alias("rx_routes_list"),
        F.size(F.collect_set("route")).cast("long").alias("route_diversity"),
        F.array_sort(F.collect_set("drug_type")).alias("rx_drug_types"),
        F.count(F.lit(1)).alias("rx_total_count"),
        F.size(F.collect_set(F.lower("drug"))).cast("long").alias("rx_unique_drugs"),
        F.size(F.collect_set("formulary_drug_cd")).cast("long").alias("rx_unique_formulary_drugs"),
        F.count_if(iv).alias("rx_iv_count"),
        F.count_if(oral).alias("rx_oral_count"),
        F.size(F.collect_set(F.to_date("starttime"))).cast("long").alias("treatment_days"),
        F.avg((_seconds("stoptime") - _seconds("starttime")) / F.lit(86400.0)).alias("avg_dur"))
    rx_f = (rx_f.withColumn("rx_iv_ratio", F.round(F.try_divide(F.col("rx_iv_count").cast("double"),
                                                                 F.col("rx_total_count").cast("double")), 2))
            .withColumn("avg_rx_duration_days", F.round("avg_dur", 1)).drop("avg_dur"))

    p = procedures_icd
    v9_surgery = (F.col("icd_version") == 9) & F.substring("icd_code", 1, 2).isin(SURGICAL_V9_PREFIXES)
    v10_surgery = (F.col("icd_version") == 10) & (F.substring("icd_code", 1, 1) == "0")
    proc_f = p.groupBy("subject_id", "hadm_id").agg(
        F.array_sort(F.collect_set("icd_code")).alias("procedure_list"),
        F.array_sort(F.collect_set(F.substring("icd_code", 1, 3))).alias("proc_icd_list"),
        F.array_join(F.array_sort(F.collect_set(F.col("icd_version").cast("string"))), ",")
        .alias("proc_icd_versions"),
        F.count(F.lit(1)).alias("proc_count"),
        F.size(F.collect_set(F.substring("icd_code", 1, 3))).cast("long").alias("proc_group_count"),
        F.count_if(F.coalesce(v9_surgery | v10_surgery, F.lit(False))).alias("surgery_count"))

    t = proc_f.join(rx_f, ["hadm_id", "subject_id"])
    return t.select(
        "subject_id", "hadm_id", "procedure_list", "proc_icd_list", "proc_icd_versions", "proc_count",
        "proc_group_count", "surgery_count", "rx_drug_list", "rx_routes_list", "route_diversity",
        "rx_drug_types", "rx_total_count", "rx_unique_drugs", "rx_unique_formulary_drugs", "rx_iv_count",
        "rx_oral_count", F.coalesce("rx_iv_ratio", F.lit(0.0)).alias("rx_iv_ratio"), "treatment_days",
        F.coalesce("avg_rx_duration_days", F.lit(0.0)).alias("avg_rx_duration_days"),
        complexity_capped("rx_unique_drugs", "proc_count", "rx_iv_count", "treatment_days")
        .alias("treatment_complexity_score"),
        intensity_label_rule("rx_unique_drugs", "surgery_count", "proc_count").alias("treatment_intensity_label"))


def _or_unknown(c: str) -> F.Column:
    return F.trim(F.coalesce(F.col(c), F.lit("UNKNOWN")))


def _drug_features(prescriptions: DataFrame, raw: bool) -> DataFrame:
    """Drug features per admission of the min-max flavour;
    with ``raw`` also the prescriptions themselves as a nested list.

    A missing end of a prescription takes the other one, and an end before the
    start takes the start; both together are ``greatest`` of the filled ends."""
    begin, stop = (F.col(c).try_cast("timestamp_ntz") for c in ("starttime", "stoptime"))
    kept = prescriptions.where(F.col("hadm_id").isNotNull() & (F.trim("drug") != "") & ~is_noise_drug_like("drug"))
    kept = kept.withColumns({"_from": F.coalesce(begin, stop), "_to": F.greatest(F.coalesce(stop, begin), F.coalesce(begin, stop))})
    iv, oral = route_flags_prefix("route")
    distinct = {"rx_drug_list": F.lower(F.trim("drug")), "rx_routes_list": F.upper(_or_unknown("route")),
                "rx_drug_types": F.upper(_or_unknown("drug_type")), "_forms": F.nullif(F.trim("formulary_drug_cd"), F.lit(""))}
    seconds = F.coalesce(_seconds("_to") - _seconds("_from"), F.lit(0))
    nested = [F.array_sort(F.collect_list(F.struct(
        F.col("_from").alias("starttime"), F.trim("drug").alias("drug"), _or_unknown("drug_type").alias("drug_type"),
        distinct["_forms"].alias("formulary_drug_cd"), "prod_strength", "doses_per_24_hrs",
        _or_unknown("route").alias("route"), F.col("_to").alias("stoptime")))).alias("prescriptions_raw")] if raw else []
    per = kept.groupBy("hadm_id").agg(
        F.min("subject_id").alias("subject_id"),
        *[F.array_sort(F.collect_set(c)).alias(n) for n, c in distinct.items()],
        F.count(F.lit(1)).alias("rx_total_count"),
        F.sum(iv).cast("long").alias("rx_iv_count"), F.sum(oral).cast("long").alias("rx_oral_count"),
        F.datediff(F.max(F.to_date("_to")), F.min(F.to_date("_from"))).alias("_span"),
        F.avg(seconds / F.lit(86400.0)).alias("avg_rx_duration_days"), *nested)
    return per.withColumns({
        "route_diversity": F.size("rx_routes_list").cast("long"), "rx_unique_drugs": F.size("rx_drug_list").cast("long"),
        "rx_unique_formulary_drugs": F.size("_forms").cast("long"),
        "treatment_days": F.greatest(F.coalesce(F.col("_span") + 1, F.lit(1)), F.lit(1)).cast("long"),
        "rx_iv_ratio": F.col("rx_iv_count").cast("double") / F.col("rx_total_count").cast("double")}).drop("_forms", "_span")


def _procedure_features(procedures_icd: DataFrame, d_icd_procedures: DataFrame, raw: bool) -> DataFrame:
    """Procedure features per admission; with ``raw`` also, per code version,
    the procedures with their titles (null when there is none).  The dictionary
    is only read for the titles."""
    code = F.trim("icd_code")
    kept = procedures_icd.where(F.col("hadm_id").isNotNull() & (code != "")).select(
        "hadm_id", code.alias("code"), F.col("icd_version").cast("int").alias("version"))
    nested = []
    if raw:
        titles = materialize(dedupe_dictionary(d_icd_procedures))
        kept = kept.join(titles, (kept.code == titles.d_code) & (kept.version == titles.d_version), "left")
        one = F.struct(F.col("code").alias("icd_code"), F.coalesce("long_title", "code").alias("long_title"))
        lists = {v: F.array_sort(F.collect_list(F.when(F.col("version") == v, one))) for v in (9, 10)}
        nested = [F.when(F.size(x) > 0, x).alias(f"procedures_icd{v}") for v, x in lists.items()]
    per = kept.groupBy("hadm_id").agg(
        F.array_sort(F.collect_set("code")).alias("procedure_list"),
        F.array_sort(F.collect_set(F.substring("code", 1, 3))).alias("proc_icd_list"),
        F.array_sort(F.collect_set(F.col("version").cast("string"))).alias("proc_version_list"),
        F.count(F.lit(1)).alias("proc_count"),
        F.count_if(surgery_flag("version", "code")).alias("surgery_count"), *nested)
    return per.withColumn("proc_group_count", F.size("proc_icd_list").cast("long"))


def treatment_features_minmax(prescriptions: DataFrame, procedures_icd: DataFrame, d_icd_procedures: DataFrame,
                              base: DataFrame, include_raw_columns: bool = False) -> DataFrame:
    """Events are reduced to one row per admission and
    kind first; the cohort then only meets those rows."""
    both = (_drug_features(prescriptions, include_raw_columns)
            .join(_procedure_features(procedures_icd, d_icd_procedures, include_raw_columns), "hadm_id")
            .join(base.select("hadm_id"), "hadm_id", "left_semi"))
    return with_minmax_complexity(both)


def with_minmax_complexity(t: DataFrame) -> DataFrame:
    """P13 + P15: min-max normalised complexity and its binned label.

    The global minima and maxima are one single-row aggregate, joined back as
    a broadcast (its size is one row by construction).  The table is
    checkpointed first so that the statistics and the scoring read it once
    instead of recomputing its aggregation twice."""
    t = materialize(t)
    stats = t.agg(*[F.min(c).cast("double").alias(f"{c}_min") for c in ("rx_unique_drugs", "proc_count",
                                                                        "treatment_days")],
                  *[F.max(c).cast("double").alias(f"{c}_max") for c in ("rx_unique_drugs", "proc_count",
                                                                       "treatment_days")])
    t = t.crossJoin(F.broadcast(stats))

    def norm(c):
        lo, hi = F.col(f"{c}_min"), F.col(f"{c}_max")
        return (F.when(hi == lo, F.when(hi == 0.0, F.lit(0.0)).otherwise(F.lit(1.0)))
                .otherwise((F.col(c).cast("double") - lo) / (hi - lo)))

    iv = F.least(F.greatest(F.coalesce("rx_iv_ratio", F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    score = 0.35 * norm("rx_unique_drugs") + 0.30 * norm("proc_count") + 0.20 * iv + 0.15 * norm("treatment_days")
    score = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    t = t.withColumn("treatment_complexity_score", score)
    t = t.withColumn("treatment_intensity_label", intensity_label_bins("treatment_complexity_score", "surgery_count"))
    return t.drop(*[c for c in t.columns if c.endswith("_min") or c.endswith("_max")])


def treatment_tall(prescriptions: DataFrame, procedures_icd: DataFrame, d_icd_procedures: DataFrame) -> DataFrame:
    """A16 + U1: one row per admission and treatment (prescription by drug,
    procedure by version:code)."""
    rx = (prescriptions.filter(F.col("hadm_id").isNotNull() & F.col("drug").isNotNull() & (F.trim("drug") != ""))
          .groupBy("subject_id", "hadm_id", F.upper(F.trim("drug")).alias("treatment_key"))
          .agg(F.min("drug").alias("treatment_name"), F.count(F.lit(1)).alias("treatment_count"))
          .withColumn("treatment_source", F.lit("prescription")))
    code = F.trim("icd_code")
    per = (procedures_icd.filter(F.col("hadm_id").isNotNull() & (code != ""))
           .groupBy("subject_id", "hadm_id", "icd_version", code.alias("code"))
           .agg(F.count(F.lit(1)).alias("treatment_count")))
    # Titles are looked up once per admission and code, after the counting.
    # Written once, so that its size is known and a small one is sent to the tasks.
    d = materialize(dedupe_dictionary(d_icd_procedures))
    pr = (per.join(d, (per.code == d.d_code) & (per.icd_version == d.d_version), "left")
          .select("subject_id", "hadm_id", "treatment_count", F.lit("procedure").alias("treatment_source"),
                  F.concat(F.col("icd_version").cast("string"), F.lit(":"), F.col("code")).alias("treatment_key"),
                  F.coalesce("long_title", "code").alias("treatment_name")))
    cols = ["subject_id", "hadm_id", "treatment_source", "treatment_key", "treatment_name", "treatment_count"]
    return rx.select(*cols).unionByName(pr.select(*cols))


def treatment_summary(tall: DataFrame) -> DataFrame:
    """Per-admission treatment counts; the event sum falls back to the row count."""
    return tall.groupBy("hadm_id").agg(
        F.count(F.lit(1)).alias("treatment_row_count"),
        F.coalesce(F.sum("treatment_count"), F.count(F.lit(1))).alias("treatment_event_count"),
        F.size(F.collect_set("treatment_key")).cast("long").alias("unique_treatment_count"),
        F.size(F.collect_set("treatment_source")).cast("long").alias("unique_treatment_source_count"))


AGGREGATED_REQUIRED = ["hadm_id", "rx_drug_list", "proc_icd_list", "rx_unique_drugs", "proc_count",
                       "treatment_days", "surgery_count", "rx_iv_ratio"]


def load_treatment_features(existing: DataFrame | None, prescriptions: DataFrame, procedures_icd: DataFrame,
                            d_icd_procedures: DataFrame, cohort: DataFrame) -> DataFrame:
    """Use an existing aggregated treatment table when it has the required
    columns (lists canonicalised, complexity recomputed when absent); else
    derive the table from the raw events."""
    from cohortlens.functions.expr import canonical_set
    from cohortlens.sources.io import has_columns
    if existing is not None and has_columns(existing, AGGREGATED_REQUIRED):
        t = existing
        for c in ("rx_drug_list", "proc_icd_list", "procedure_list", "rx_routes_list", "rx_drug_types"):
            if c in t.columns:
                t = t.withColumn(c, canonical_set(c))
        if "treatment_complexity_score" not in t.columns or "treatment_intensity_label" not in t.columns:
            t = with_minmax_complexity(t.drop("treatment_complexity_score", "treatment_intensity_label"))
        return t
    return treatment_features_minmax(prescriptions, procedures_icd, d_icd_procedures, cohort)
