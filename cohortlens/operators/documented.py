"""Operators described in the reference's documents but absent from its code
(D1-D8), built as batch DataFrame jobs."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import gaussian, jaccard
from cohortlens.operators.recommend import score_treatments
from cohortlens.operators.similarity import lit_set, lookup_row

# Fixed values of the documented two-stage search.
RERANK_WEIGHTS = {"groups": 0.50, "codes": 0.25, "primary": 0.15, "context": 0.10}
# Context scales are not given in the documents; these are our parameters.
CONTEXT_SCALES = {"age": 10.0, "bmi": 5.0, "bp": 15.0}
RECOMMENDATION_POOL = 30
DISPLAY_POOL = 5
DISPLAY_EXCLUDE = ["flush", "bag"]


def _lit(v: Any) -> Column:
    return F.lit(v)


def match_signals(knn: DataFrame, q: dict) -> DataFrame:
    """The first-stage signals of every other admission: primary match,
    group overlap, code overlap, primary-group match and age distance.  All
    admissions go on to the second stage: both stages are column expressions of
    one scan, so nothing is gained by a cut between them."""
    qg, qd = lit_set(q.get("diagnoses_3digit_list")), lit_set(q.get("diagnoses_icd_list"))
    return knn.filter(F.col("hadm_id") != _lit(q["hadm_id"])).select(
        "*",
        F.coalesce((F.col("primary_diagnosis_icd") == _lit(q.get("primary_diagnosis_icd"))).cast("int"), F.lit(0))
        .alias("primary_match"),
        F.size(F.array_intersect(qg, "diagnoses_3digit_list")).alias("group_overlap"),
        F.size(F.array_intersect(qd, "diagnoses_icd_list")).alias("code_overlap"),
        F.coalesce((F.col("primary_icd_3digit") == _lit(q.get("primary_icd_3digit"))).cast("int"), F.lit(0))
        .alias("primary_group_match"),
        F.abs(F.col("age").cast("double") - _lit(float(q["age"]) if q.get("age") is not None else None).cast("double"))
        .alias("age_distance"))


def rerank(pool: DataFrame, q: dict, weights: dict | None = None, scales: dict | None = None) -> DataFrame:
    """0.50 group Jaccard + 0.25 code Jaccard + 0.15 primary match +
    0.10 context (mean of age, BMI, systolic and diastolic Gaussians and
    gender / race equality)."""
    w, s = weights or RERANK_WEIGHTS, scales or CONTEXT_SCALES
    qv = {k: (float(q[k]) if q.get(k) is not None else None) for k in ("age", "bmi", "systolic_bp", "diastolic_bp")}
    parts = [gaussian(F.lit(qv["age"]).cast("double"), "age", s["age"]),
             gaussian(F.lit(qv["bmi"]).cast("double"), "bmi", s["bmi"]),
             gaussian(F.lit(qv["systolic_bp"]).cast("double"), "systolic_bp", s["bp"]),
             gaussian(F.lit(qv["diastolic_bp"]).cast("double"), "diastolic_bp", s["bp"]),
             F.coalesce((F.col("gender") == _lit(q.get("gender"))).cast("double"), F.lit(0.0)),
             F.coalesce((F.col("race") == _lit(q.get("race"))).cast("double"), F.lit(0.0))]
    context = sum(parts[1:], parts[0]) / F.lit(float(len(parts)))
    score = (F.lit(w["groups"]) * jaccard(lit_set(q.get("diagnoses_3digit_list")), "diagnoses_3digit_list")
             + F.lit(w["codes"]) * jaccard(lit_set(q.get("diagnoses_icd_list")), "diagnoses_icd_list")
             + F.lit(w["primary"]) * F.col("primary_match").cast("double")
             + F.lit(w["context"]) * context)
    return pool.withColumn("context_similarity", context).withColumn("rerank_score", score)


def two_stage_search(knn: DataFrame, query_hadm_id: Any = None, keep: int = RECOMMENDATION_POOL) -> DataFrame:
    """D1 + D2: signals, rerank of the whole cohort, best ``keep`` (ties by id)."""
    q = lookup_row(knn, "hadm_id", query_hadm_id)
    ranked = rerank(match_signals(knn, q), q)
    return ranked.orderBy(F.col("rerank_score").desc(), F.col("hadm_id").asc()).limit(int(keep))


def pool_recommendations(neighbours: DataFrame, tall: DataFrame, display: int = DISPLAY_POOL) -> DataFrame:
    """D3: treatments of the recommendation pool, without display noise
    (names containing flush or bag), top ``display``."""
    t = tall.select("hadm_id", "treatment_source", "treatment_key", "treatment_name", "treatment_count")
    name = F.lower(F.col("treatment_name"))
    noise = F.lit(False)
    for word in DISPLAY_EXCLUDE:
        noise = noise | name.contains(word)
    t = t.filter(~noise)
    n = neighbours.select("hadm_id", F.col("rerank_score").alias("similarity"), "los_days")
    return score_treatments(n.join(t, "hadm_id"), top_n=display)


def readmission_30day(admissions: DataFrame, days: int = 30) -> DataFrame:
    """1 when the same subject is admitted again after this discharge and
    within ``days`` of it.

    An existence test (left semi join) on (subject, time bucket): later
    admissions are bucketed by admission day in ``days``-wide buckets, and a
    discharge probes the two buckets its window can touch, so no admission is
    paired with every admission of its subject."""
    a = admissions.select("hadm_id", "subject_id", "admittime", "dischtime")
    later = a.select(F.col("subject_id").alias("l_subject"), F.col("hadm_id").alias("l_hadm"),
                     F.col("admittime").alias("l_admit"),
                     F.floor(F.unix_date(F.to_date("admittime")) / days).alias("l_bucket"))
    probe_bucket = F.floor(F.unix_date(F.to_date("dischtime")) / days)
    probes = a.filter(F.col("dischtime").isNotNull()).select(
        "hadm_id", "subject_id", "dischtime",
        F.explode(F.array(probe_bucket, probe_bucket + 1)).alias("bucket"))
    hit = probes.join(later, (F.col("subject_id") == F.col("l_subject")) & (F.col("bucket") == F.col("l_bucket"))
                      & (F.col("l_hadm") != F.col("hadm_id")) & (F.col("l_admit") > F.col("dischtime"))
                      & (F.col("l_admit") <= F.col("dischtime") + F.make_dt_interval(days=F.lit(days))), "left_semi")
    flagged = hit.select("hadm_id").distinct().withColumn("readmission_30day", F.lit(1))
    return a.join(flagged, "hadm_id", "left").select(
        "hadm_id", "subject_id", F.coalesce("readmission_30day", F.lit(0)).alias("readmission_30day"))


def data_tiers(base: DataFrame, dx: DataFrame) -> DataFrame:
    """Which similarity tier an admission supports given its data:
    ``full`` (diagnoses plus BMI and blood pressure), ``diagnoses`` (codes
    only) or ``demographics`` (neither)."""
    j = base.join(dx.select("hadm_id", "diagnosis_count"), "hadm_id", "left")
    has_dx = F.coalesce(F.col("diagnosis_count"), F.lit(0)) > 0
    has_meas = F.col("bmi").isNotNull() & F.col("systolic_bp").isNotNull()
    tier = (F.when(has_dx & has_meas, F.lit("full")).when(has_dx, F.lit("diagnoses"))
            .otherwise(F.lit("demographics")))
    return j.select("hadm_id", tier.alias("similarity_tier"))


def early_window_labs(cohort: DataFrame, labs: DataFrame, hours: int = 24) -> DataFrame:
    """Per admission and item, count / min / max of numeric results in the
    first ``hours`` after admission.  Labs are matched by subject and
    calendar day (a window of h hours touches at most ceil(h/24) + 1 days),
    then filtered exactly."""
    span = hours // 24 + 2
    probes = cohort.select("hadm_id", "subject_id", "admittime",
                           F.explode(F.sequence(F.lit(0), F.lit(span - 1))).alias("k")).withColumn(
        "day", F.date_add(F.to_date("admittime"), F.col("k")))
    lab = labs.filter(F.col("valuenum").isNotNull()).select(
        F.col("subject_id").alias("l_subject"), "itemid", "charttime", "valuenum",
        F.to_date("charttime").alias("l_day"))
    j = probes.join(lab, (F.col("subject_id") == F.col("l_subject")) & (F.col("day") == F.col("l_day"))
                    & (F.col("charttime") >= F.col("admittime"))
                    & (F.col("charttime") < F.col("admittime") + F.make_dt_interval(hours=F.lit(hours))))
    return j.groupBy("hadm_id", "itemid").agg(F.count(F.lit(1)).alias("n_results"),
                                              F.min("valuenum").alias("min_value"),
                                              F.max("valuenum").alias("max_value"))


def euclidean_neighbours(emb: DataFrame, query_id: Any = None, k: int = 10, id_col: str = "vec_id",
                         vec_col: str = "embedding") -> DataFrame:
    """K nearest vectors by Euclidean distance to one query vector (self
    excluded, ties by id), computed with array intrinsics (no UDF)."""
    q = lookup_row(emb, id_col, query_id, columns=[id_col, vec_col])
    qv = F.array(*[F.lit(float(x)) for x in q[vec_col]])
    sq = F.aggregate(F.zip_with(F.col(vec_col).cast("array<double>"), qv, lambda a, b: (a - b) * (a - b)),
                     F.lit(0.0), lambda acc, x: acc + x)
    return (emb.filter(F.col(id_col) != F.lit(q[id_col])).select(id_col, F.sqrt(sq).alias("distance"))
            .orderBy(F.col("distance").asc(), F.col(id_col).asc()).limit(int(k)))
