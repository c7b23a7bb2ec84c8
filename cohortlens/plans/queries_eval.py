"""Registered quality, cosine-kNN and evaluation queries with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import cosine, evaluate, quality
from cohortlens.operators.dataset import joined_dataset, modelling_flags
from cohortlens.operators.knn_join import knn_join
from cohortlens.operators.neighbours import FIT_ROWS, neighbour_vote, vote_columns
from cohortlens.plans.features import Features
from cohortlens.plans.oracle_ctes import BASE_CTES, CLIN_CTES, DX_CTES, TALL_CTE, TR_CTES, TRC_CTE, base_ctes, with_ctes
from cohortlens.plans.queries import jac_sql, r6, register
from cohortlens.session import materialize

def _r6_all(df, skip=()):
    return df.select(*[r6(c).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


# --- quality ------------------------------------------------------------------

@register("validate_diagnoses", with_ctes(BASE_CTES, DX_CTES) + """
SELECT count(*) AS row_count, count(*) FILTER (WHERE primary_diagnosis_icd IS NULL) AS null_primary,
  count(*) FILTER (WHERE diagnoses_icd_list IS NULL) AS null_icd_list,
  count(*) FILTER (WHERE diagnoses_3digit_list IS NULL) AS null_group_list,
  count(*) FILTER (WHERE unique_icd_count > diagnosis_count) AS count_order_violations,
  count(*) FILTER (WHERE len(diagnoses_icd_list) <> unique_icd_count) AS list_size_mismatches FROM dx""")
def q_validate_diagnoses(spark, sf_dir):
    return quality.validate_diagnoses(Features(spark, sf_dir).dx)


@register("validate_treatments", with_ctes(BASE_CTES, TR_CTES) + """
SELECT count(*) AS row_count,
  count(*) FILTER (WHERE rx_drug_list IS NULL OR proc_icd_list IS NULL) AS null_lists,
  count(*) FILTER (WHERE rx_unique_drugs > rx_total_count) AS drug_count_violations,
  count(*) FILTER (WHERE proc_group_count > proc_count) AS proc_count_violations,
  count(*) FILTER (WHERE rx_iv_ratio < 0 OR rx_iv_ratio > 1) AS ratio_out_of_range,
  count(*) FILTER (WHERE treatment_complexity_score < 0 OR treatment_complexity_score > 1) AS score_out_of_range
FROM tr""")
def q_validate_treatments(spark, sf_dir):
    return quality.validate_treatments(Features(spark, sf_dir).tr)


@register("key_uniqueness", with_ctes(BASE_CTES) + """
SELECT count(*) AS row_count, count(DISTINCT hadm_id) AS distinct_keys,
       count(*) - count(DISTINCT hadm_id) AS duplicate_rows FROM base""")
def q_key_uniqueness(spark, sf_dir):
    return quality.key_uniqueness(Features(spark, sf_dir).base, "hadm_id")


@register("intensity_distribution", with_ctes(BASE_CTES, TR_CTES) + """
SELECT treatment_intensity_label, count(*) AS admissions, round(avg(rx_unique_drugs), 6) AS mean_unique_drugs,
       round(avg(proc_count), 6) AS mean_proc_count FROM tr GROUP BY 1""")
def q_intensity_distribution(spark, sf_dir):
    return _r6_all(quality.intensity_distribution(Features(spark, sf_dir).tr))


@register("treatment_qa", with_ctes(TRC_CTE) + """
, labels AS (SELECT treatment_intensity_label AS label, count(*) AS n, min(treatment_complexity_score) AS low,
                    max(treatment_complexity_score) AS high FROM trc GROUP BY ALL),
subjects AS (SELECT DISTINCT subject_id FROM trc), admitted AS (SELECT DISTINCT hadm_id FROM trc)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, (SELECT count(subject_id) FROM subjects) AS n_subjects,
  (SELECT count(hadm_id) FROM admitted) AS n_admissions, round(min(low), 6) AS lowest_score, round(max(high), 6) AS highest_score,
  CAST(coalesce(sum(CASE label WHEN 'High' THEN n END), 0) AS BIGINT) AS high_rows,
  CAST(coalesce(sum(CASE label WHEN 'Medium' THEN n END), 0) AS BIGINT) AS medium_rows,
  CAST(coalesce(sum(CASE label WHEN 'Low' THEN n END), 0) AS BIGINT) AS low_rows FROM labels""")
def q_treatment_qa(spark, sf_dir):
    return _r6_all(quality.treatment_qa(Features(spark, sf_dir).tr_capped))


@register("diagnosis_qa", with_ctes(BASE_CTES, DX_CTES) + """
, halves AS (SELECT primary_diagnosis_icd IS NULL AS bare, count(*) AS n, sum(diagnosis_count) AS codes FROM dx GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, round(sum(codes) / sum(n), 6) AS mean_codes,
       CAST(coalesce(sum(CASE WHEN bare THEN n END), 0) AS BIGINT) AS without_primary FROM halves""")
def q_diagnosis_qa(spark, sf_dir):
    return _r6_all(quality.diagnosis_qa(Features(spark, sf_dir).dx))


_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_PROFILE_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                  "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@register("table_profile", " UNION ALL ".join(
    f"SELECT count(*) AS row_count, '{c}' AS column_name, '{_PROFILE_TYPES[c]}' AS data_type, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count FROM orders"
    for c in _PROFILE_COLS))
def q_table_profile(spark, sf_dir):
    f = Features(spark, sf_dir)
    return quality.table_profile(f.table("orders"), _PROFILE_COLS)


@register("table_preview", with_ctes().rstrip().rstrip(",") + """
SELECT subject_id, hadm_id, admission_type, 'subject_id,hadm_id' AS id_columns
FROM admissions ORDER BY subject_id NULLS LAST, hadm_id NULLS LAST LIMIT 25""")
def q_table_preview(spark, sf_dir):
    a = Features(spark, sf_dir).raw.admissions.select("subject_id", "hadm_id", "admission_type")
    return quality.row_sample(a).withColumn("id_columns", F.lit(",".join(quality.id_columns(a))))


@register("top_lab_items", with_ctes("""
top AS (SELECT itemid, count(*) AS event_count, count(DISTINCT subject_id) AS patient_count,
               count(valuenum) AS numeric_count
        FROM labevents WHERE itemid IS NOT NULL AND valuenum IS NOT NULL
        GROUP BY itemid ORDER BY patient_count DESC, itemid ASC LIMIT 50)""") + """
SELECT d.itemid, d.label, d.fluid, d.category, t.event_count, t.patient_count, t.numeric_count
FROM top t JOIN d_labitems d ON t.itemid = d.itemid""")
def q_top_lab_items(spark, sf_dir):
    f = Features(spark, sf_dir)
    return quality.top_items(f.raw.labevents, f.raw.d_labitems, 50)


# --- cosine kNN -----------------------------------------------------------------

KNN_CTES = r"""
knn AS MATERIALIZED (
  SELECT b.subject_id, b.hadm_id, b.age, coalesce(b.gender, 'unknown') AS gender, coalesce(b.race, 'unknown') AS race,
         b.bmi, b.systolic_bp, b.diastolic_bp, b.los_days, b.mortality,
         coalesce(d.diagnosis_count, 0) AS diagnosis_count, coalesce(d.unique_icd_count, 0) AS unique_icd_count,
         coalesce(d.diagnosis_diversity_ratio, 0.0) AS diagnosis_diversity_ratio,
         coalesce(d.diagnoses_icd_list, []) AS diagnoses_icd_list,
         coalesce(d.diagnoses_3digit_list, []) AS diagnoses_3digit_list
  FROM base b LEFT JOIN dx d ON b.subject_id = d.subject_id AND b.hadm_id = d.hadm_id),
med AS (SELECT {med} FROM knn),
imp AS (SELECT k.*, {imp} FROM knn k, med),
st AS (SELECT {st} FROM imp),
z AS MATERIALIZED (SELECT imp.*, {z} FROM imp, st),
q AS (SELECT * FROM z WHERE hadm_id = (SELECT min(hadm_id) FROM z)),
scored AS (
  SELECT c.*,
    ({dot} + CAST(c.gender = q.gender AS DOUBLE) + CAST(c.race = q.race AS DOUBLE)
      + len(list_intersect(q.diagnoses_3digit_list, c.diagnoses_3digit_list))
      + len(list_intersect(q.diagnoses_icd_list, c.diagnoses_icd_list)))
    / (sqrt({cn} + 2 + len(c.diagnoses_3digit_list) + len(c.diagnoses_icd_list))
       * sqrt({qn} + 2 + len(q.diagnoses_3digit_list) + len(q.diagnoses_icd_list))) AS cosine,
    q.diagnoses_icd_list AS q_dx, q.diagnoses_3digit_list AS q_dx3, q.gender AS q_gender, q.race AS q_race,
    q.age AS q_age, q.bmi AS q_bmi, q.systolic_bp AS q_sbp, q.diastolic_bp AS q_dbp
  FROM z c, q WHERE c.hadm_id <> q.hadm_id),
nb AS (SELECT *, 1.0 - cosine AS distance, least(greatest(cosine, 0.0), 1.0) AS similarity
       FROM scored ORDER BY distance ASC, hadm_id ASC LIMIT 7)
"""
_N = cosine.KNN_NUMERIC
KNN_CTES = KNN_CTES.format(
    med=", ".join(f"coalesce(median(CAST({c} AS DOUBLE)), 0.0) AS m_{c}" for c in _N),
    imp=", ".join(f"coalesce(CAST(k.{c} AS DOUBLE), m_{c}) AS i_{c}" for c in _N),
    st=", ".join(f"avg(i_{c}) AS a_{c}, CASE WHEN stddev_pop(i_{c}) > 0 THEN stddev_pop(i_{c}) ELSE 1.0 END AS s_{c}"
                 for c in _N),
    z=", ".join(f"(i_{c} - a_{c}) / s_{c} AS z_{c}" for c in _N),
    dot=" + ".join(f"q.z_{c} * c.z_{c}" for c in _N),
    cn=" + ".join(f"c.z_{c} * c.z_{c}" for c in _N),
    qn=" + ".join(f"q.z_{c} * q.z_{c}" for c in _N))


@register("knn_neighbours", with_ctes(BASE_CTES, DX_CTES, KNN_CTES) + """
SELECT hadm_id, subject_id, round(distance, 6) AS distance, round(similarity, 6) AS similarity, los_days,
  array_to_string(list_sort(list_intersect(q_dx, diagnoses_icd_list))[1:10], ',') AS shared_diagnoses,
  array_to_string(list_sort(list_intersect(q_dx3, diagnoses_3digit_list))[1:10], ',') AS shared_icd_groups,
  gender = q_gender AS same_gender, race = q_race AS same_race,
  round(abs(CAST(q_age AS DOUBLE) - age), 6) AS age_difference, round(abs(q_bmi - bmi), 6) AS bmi_difference,
  round(abs(q_sbp - systolic_bp), 6) AS systolic_bp_difference,
  round(abs(q_dbp - diastolic_bp), 6) AS diastolic_bp_difference,
  len(list_intersect(q_dx, diagnoses_icd_list)) AS shared_diagnosis_count FROM nb""")
def q_knn_neighbours(spark, sf_dir):
    nb = cosine.knn_neighbours(Features(spark, sf_dir).knn, None, k=7)
    return _r6_all(nb.withColumn("shared_diagnoses", F.array_join("shared_diagnoses", ","))
                   .withColumn("shared_icd_groups", F.array_join("shared_icd_groups", ","))
                   .withColumn("age_difference", F.col("age_difference").cast("double")))


@register("knn_treatments", with_ctes(BASE_CTES, DX_CTES, KNN_CTES, TALL_CTE) + """
, rows_ AS (SELECT t.*, nb.similarity, greatest(coalesce(CAST(nb.los_days AS DOUBLE), 0.0), 1e-6) AS los
            FROM nb JOIN tall t ON nb.hadm_id = t.hadm_id),
agg AS (SELECT treatment_source, treatment_key, treatment_name, count(DISTINCT hadm_id) AS frequency,
               avg(los) AS average_los, sum(similarity / los) AS weighted_score,
               CAST(sum(treatment_count) AS BIGINT) AS event_count_sum,
               array_to_string(list_sort(list(DISTINCT hadm_id)), ',') AS supporting_hadm_ids
        FROM rows_ GROUP BY 1, 2, 3)
SELECT treatment_source, treatment_key, treatment_name, frequency, round(average_los, 6) AS average_los,
       round(weighted_score, 6) AS weighted_score, event_count_sum, supporting_hadm_ids,
       round(frequency / greatest(average_los, 1e-6), 6) AS score
FROM agg ORDER BY weighted_score DESC, frequency / greatest(average_los, 1e-6) DESC, frequency DESC,
         treatment_name ASC, treatment_key ASC LIMIT 10""")
def q_knn_treatments(spark, sf_dir):
    f = Features(spark, sf_dir)
    nb = cosine.knn_neighbours(f.knn, None, k=7)
    rec = cosine.recommend_from_neighbours(nb, f.tall, top_n=10)
    return _r6_all(rec.withColumn("supporting_hadm_ids", F.regexp_replace("supporting_hadm_ids", " ", "")))


# --- datasets -------------------------------------------------------------------

@register("joined_dataset", with_ctes(BASE_CTES, DX_CTES, TALL_CTE) + """
, summ AS (SELECT hadm_id, count(*) AS treatment_row_count, coalesce(sum(treatment_count), count(*)) AS ev,
                  count(DISTINCT treatment_key) AS unique_treatment_count,
                  count(DISTINCT treatment_source) AS unique_treatment_source_count FROM tall GROUP BY hadm_id)
SELECT b.hadm_id, b.subject_id, b.mortality, d.icd_version_mix, d.diagnosis_count,
       coalesce(s.treatment_row_count, 0) AS treatment_row_count, CAST(coalesce(s.ev, 0) AS BIGINT) AS treatment_event_count,
       coalesce(s.unique_treatment_count, 0) AS unique_treatment_count,
       coalesce(s.unique_treatment_source_count, 0) AS unique_treatment_source_count,
       array_to_string(d.diagnoses_icd_list, ',') AS diagnoses_icd_list
FROM base b JOIN dx d ON b.hadm_id = d.hadm_id LEFT JOIN summ s ON b.hadm_id = s.hadm_id""")
def q_joined_dataset(spark, sf_dir):
    f = Features(spark, sf_dir)
    j = f.joined
    return j.select("hadm_id", "subject_id", "mortality", "icd_version_mix", "diagnosis_count",
                    "treatment_row_count", "treatment_event_count", "unique_treatment_count",
                    "unique_treatment_source_count", F.array_join("diagnoses_icd_list", ",").alias("diagnoses_icd_list"))


@register("modelling_flags", with_ctes(BASE_CTES, DX_CTES) + """
, j AS (SELECT b.hadm_id, b.age, d.diagnosis_count, d.diagnosis_diversity_ratio FROM base b JOIN dx d ON b.hadm_id = d.hadm_id)
SELECT hadm_id, coalesce(CAST(age AS DOUBLE), (SELECT median(age) FROM j)) AS age,
       CAST(coalesce(CAST(age AS DOUBLE), (SELECT median(age) FROM j)) > 65 AS INTEGER) AS elderly,
       CAST(coalesce(diagnosis_count, 0) AS BIGINT) AS diagnosis_count,
       CAST(coalesce(diagnosis_count, 0) > 10 AS INTEGER) AS high_diagnosis_burden,
       round(coalesce(diagnosis_diversity_ratio, 0.0), 6) AS diagnosis_diversity_ratio FROM j""")
def q_modelling_flags(spark, sf_dir):
    f = Features(spark, sf_dir)
    return _r6_all(modelling_flags(joined_dataset(f.base, f.dx, None)))


# --- alignment (M6, A26, A27) ------------------------------------------------------

ALIGN_CTES = r"""
elig AS (SELECT b.hadm_id, d.diagnoses_icd_list AS s, CAST({y} AS DOUBLE) AS y, {g} AS g
         FROM base b JOIN dx d ON b.hadm_id = d.hadm_id WHERE {y} IS NOT NULL AND {g} IS NOT NULL),
places AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS place FROM (SELECT DISTINCT unnest(s) AS code FROM elig)),
masks AS (SELECT e.hadm_id, any_value(e.y) AS y, any_value(e.g) AS g, len(any_value(e.s)) AS n,
                 coalesce(bit_or(1::HUGEINT << CAST(p.place AS INTEGER)), 0::HUGEINT) AS m
          FROM (SELECT *, unnest(CASE WHEN len(s) = 0 THEN [NULL] ELSE s END) AS code FROM elig) e LEFT JOIN places p ON p.code = e.code GROUP BY e.hadm_id),
prs AS MATERIALIZED (
  SELECT x, yy, count(*) AS w FROM (
    SELECT CASE WHEN a.n + b.n = 0 THEN 0.0 ELSE bit_count(a.m & b.m) * 1.0 / (a.n + b.n - bit_count(a.m & b.m)) END AS x, {agree} AS yy
    FROM masks a JOIN masks b ON a.hadm_id < b.hadm_id AND a.g = b.g) GROUP BY x, yy),
tot AS (SELECT sum(w) AS n, sum(w * x) AS sx, sum(w * x * x) AS sxx, sum(w * yy) AS sy, sum(w * yy * yy) AS syy, sum(w * x * yy) AS sxy FROM prs),
bnd AS (SELECT *, CASE {bands} END AS band FROM prs)
"""
_ALIGN_SUMMARY = """
SELECT '{outcome}' AS outcome_column, (SELECT count(*) FROM elig) AS sampled_patients, CAST(n AS BIGINT) AS pair_count,
       {same} AS same_version_only, round((n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)), 6) AS correlation,
       round(sx / n, 6) AS mean_similarity, round(sy / n, 6) AS mean_outcome_match_rate FROM tot"""


def _align_ctes(y: str, g: str, agree: str) -> str:
    return ALIGN_CTES.format(y=y, g=g, agree=agree, bands=" ".join(
        f"WHEN x <= {repr(e)} THEN {i}" for i, e in enumerate(evaluate.band_edges(5)[1:])))


_DIED_ALIGN = _align_ctes("b.mortality", "'all'", "CAST(a.y = b.y AS DOUBLE)")
_LOS_ALIGN = _align_ctes("b.los_days", "d.icd_version_mix", "exp(-0.05 * abs(a.y - b.y))")


def _alignment(spark, sf_dir):
    """All pairs of the whole cohort."""
    f = Features(spark, sf_dir)
    return evaluate.outcome_alignment(joined_dataset(f.base, f.dx, None), "mortality")


@register("alignment_summary", with_ctes(BASE_CTES, DX_CTES, _DIED_ALIGN) + _ALIGN_SUMMARY.format(outcome="mortality", same="false"))
def q_alignment_summary(spark, sf_dir):
    return _r6_all(_alignment(spark, sf_dir)[0])


@register("alignment_bands", with_ctes(BASE_CTES, DX_CTES, _DIED_ALIGN) + """
, bl AS (SELECT range AS band FROM range(5))
SELECT bl.band, round(bl.band * 0.2, 6) AS band_lower, round(CASE WHEN bl.band = 4 THEN 1.0 ELSE (bl.band + 1) * 0.2 END, 6) AS band_upper,
       CAST(coalesce(sum(w), 0) AS BIGINT) AS pair_count, round(sum(w * x) / sum(w), 6) AS similarity_mean, round(sum(w * yy) / sum(w), 6) AS outcome_match_rate
FROM bl LEFT JOIN bnd ON bl.band = bnd.band GROUP BY bl.band""")
def q_alignment_bands(spark, sf_dir):
    b = _alignment(spark, sf_dir)[1]
    return _r6_all(b.withColumn("band", F.col("band").cast("bigint")))


@register("alignment_los_same_version", with_ctes(BASE_CTES, DX_CTES, _LOS_ALIGN) + _ALIGN_SUMMARY.format(outcome="los_days", same="true"))
def q_alignment_los_same_version(spark, sf_dir):
    f = Features(spark, sf_dir)
    return _r6_all(evaluate.outcome_alignment(joined_dataset(f.base, f.dx, None), "los_days", same_version_only=True)[0])


# --- predictions of whole-table scores (M7, M9, M10, M20) -----------------------------

def _score_predictions(spark, sf_dir):
    clin = Features(spark, sf_dir).clin
    a = clin.select(F.lit("complexity_score").alias("model"), "hadm_id", F.col("mortality").cast("int").alias("label"),
                    F.col("treatment_complexity_score").cast("double").alias("score"))
    b = clin.select(F.lit("diversity_ratio").alias("model"), "hadm_id", F.col("mortality").cast("int").alias("label"),
                    F.col("diagnosis_diversity_ratio").cast("double").alias("score"))
    # Written once to the checkpoint folder: the metrics read it several times.
    return materialize(a.unionByName(b).withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


PRED_CTE = """
pred AS MATERIALIZED (
  SELECT 'complexity_score' AS model, hadm_id, CAST(mortality AS INTEGER) AS label,
         CAST(treatment_complexity_score AS DOUBLE) AS score FROM clin
  UNION ALL
  SELECT 'diversity_ratio', hadm_id, CAST(mortality AS INTEGER), CAST(diagnosis_diversity_ratio AS DOUBLE) FROM clin),
pr AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM pred)
"""
_CLIN_ALL = (BASE_CTES, DX_CTES, TR_CTES, CLIN_CTES, PRED_CTE)


@register("score_metrics", with_ctes(*_CLIN_ALL) + """
, rk AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
                + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM pr),
auc AS (SELECT model, sum(r) FILTER (WHERE label = 1) AS sr, count(*) FILTER (WHERE label = 1) AS n1,
               count(*) FILTER (WHERE label = 0) AS n0 FROM rk GROUP BY model),
cm AS (SELECT model, count(*) AS n,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
       FROM pr GROUP BY model)
SELECT cm.model, round((tp + tn) / n, 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1_score,
  round(CASE WHEN n1 > 0 AND n0 > 0 THEN (sr - n1 * (n1 + 1) / 2.0) / (n1 * n0) END, 6) AS roc_auc
FROM cm JOIN auc ON cm.model = auc.model""")
def q_score_metrics(spark, sf_dir):
    return _r6_all(evaluate.classification_metrics(_score_predictions(spark, sf_dir)))


@register("confusion_matrix", with_ctes(*_CLIN_ALL) + """
SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM pr GROUP BY model""")
def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_score_predictions(spark, sf_dir))


@register("threshold_tuning", with_ctes(*_CLIN_ALL) + """
, s AS (SELECT label, score FROM pred WHERE model = 'complexity_score'),
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS n1 FROM s),
cand AS (SELECT DISTINCT score AS t FROM s UNION SELECT 0.5),
ev AS (SELECT t, (SELECT count(*) FILTER (WHERE label = 1 AND score >= t) FROM s) AS tp,
              (SELECT count(*) FILTER (WHERE label = 0 AND score >= t) FROM s) AS fp FROM cand),
m AS (SELECT t, (tp + (n - n1 - fp)) * 1.0 / n AS acc,
             CASE WHEN 2 * tp + fp + (n1 - tp) > 0 THEN 2.0 * tp / (2 * tp + fp + (n1 - tp)) ELSE 0.0 END AS f1, n, n1
      FROM ev, tot),
best AS (SELECT * FROM m ORDER BY acc DESC, f1 DESC, t ASC LIMIT 1)
SELECT CASE WHEN n >= 20 AND n1 >= 2 AND n1 < n THEN round(t, 6) ELSE 0.5 END AS threshold,
       CASE WHEN n >= 20 AND n1 >= 2 AND n1 < n THEN round(acc, 6) END AS validation_accuracy,
       CASE WHEN n >= 20 AND n1 >= 2 AND n1 < n THEN round(f1, 6) END AS validation_f1,
       n >= 20 AND n1 >= 2 AND n1 < n AS tuned FROM best""")
def q_threshold_tuning(spark, sf_dir):
    p = _score_predictions(spark, sf_dir).filter(F.col("model") == "complexity_score")
    return _r6_all(evaluate.tune_threshold(p))


@register("residual_histogram", with_ctes(*_CLIN_ALL) + """
, r AS (SELECT model, label - score AS r FROM pred),
rng AS (SELECT model, CASE WHEN min(r) = max(r) THEN min(r) - 0.5 ELSE min(r) END AS lo,
               CASE WHEN min(r) = max(r) THEN max(r) + 0.5 ELSE max(r) END AS hi FROM r GROUP BY model),
c AS (SELECT r.model, CAST(least(floor((r - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS cnt
      FROM r JOIN rng ON r.model = rng.model GROUP BY 1, 2),
g AS (SELECT rng.*, CAST(range AS INTEGER) AS bin FROM rng, range(30))
SELECT g.model, g.bin, round(lo + g.bin * ((hi - lo) / 30), 6) AS bin_lower,
       round(lo + (g.bin + 1) * ((hi - lo) / 30), 6) AS bin_upper, coalesce(cnt, 0) AS count
FROM g LEFT JOIN c ON g.model = c.model AND g.bin = c.bin""")
def q_residual_histogram(spark, sf_dir):
    return _r6_all(evaluate.residual_histogram(_score_predictions(spark, sf_dir), 30, "model"))


# --- split and neighbour vote (M11, M8) ------------------------------------------------

@register("stratified_split", with_ctes(BASE_CTES, DX_CTES, TR_CTES, CLIN_CTES) + """
, r AS (SELECT hadm_id, mortality, row_number() OVER (PARTITION BY mortality
          ORDER BY md5(CAST(hadm_id AS VARCHAR) || '42'), hadm_id) AS rn,
        count(*) OVER (PARTITION BY mortality) AS n FROM clin)
SELECT hadm_id, mortality, rn <= floor(n * 0.2 + 0.5) AS is_test FROM r""")
def q_stratified_split(spark, sf_dir):
    s = evaluate.stratified_split(Features(spark, sf_dir).clin, "mortality", 0.2, 42)
    return s.select("hadm_id", "mortality", "is_test")


def _vote(spark, sf_dir, fit_rows=None):
    """Every held-out admission of the whole cohort is scored, against all
    training rows or ``fit_rows`` of them."""
    clin = Features(spark, sf_dir).clin.select("hadm_id", "mortality", *vote_columns())
    split = materialize(evaluate.stratified_split(clin, "mortality", 0.2, 42))
    return materialize(neighbour_vote(split.filter(~F.col("is_test")), split.filter("is_test"), "mortality", fit_rows=fit_rows))


VOTE_CTES = r"""
sp AS MATERIALIZED (
  SELECT *, array_concat(list_transform(rx_drug_list, lambda x: 'rx:' || x), list_transform(proc_icd_list, lambda x: 'proc:' || x)) AS tt,
    row_number() OVER (PARTITION BY mortality ORDER BY md5(CAST(hadm_id AS VARCHAR) || '42'), hadm_id)
      <= floor(count(*) OVER (PARTITION BY mortality) * 0.2 + 0.5) AS is_test FROM clin),
fit AS MATERIALIZED (SELECT * FROM sp WHERE NOT is_test ORDER BY md5(CAST(hadm_id AS VARCHAR) || '7'), hadm_id LIMIT {fit}),
pairs AS (
  SELECT q.hadm_id AS qid, c.hadm_id AS cid, CAST(c.mortality AS DOUBLE) AS y,
         0.6 * {jd} + 0.4 * {jt} AS sim
  FROM sp q JOIN fit c ON q.is_test),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, cid ASC) AS k
                       FROM pairs WHERE sim > 0) WHERE k <= 15),
votes AS (SELECT qid, sum(pow(sim, 2) * y) / sum(pow(sim, 2)) AS vote FROM top GROUP BY qid),
vp AS (SELECT t.hadm_id, CAST(t.mortality AS INTEGER) AS label,
              coalesce(v.vote, (SELECT avg(CAST(mortality AS DOUBLE)) FROM sp WHERE NOT is_test)) AS score
       FROM sp t LEFT JOIN votes v ON t.hadm_id = v.qid WHERE t.is_test)
""".format(jd=jac_sql("q.diagnoses_icd_list", "c.diagnoses_icd_list"), jt=jac_sql("q.tt", "c.tt"), fit=FIT_ROWS)
#: Against all training rows.
VOTE_OF_ALL_CTES = VOTE_CTES.replace(f" ORDER BY md5(CAST(hadm_id AS VARCHAR) || '7'), hadm_id LIMIT {FIT_ROWS}", "")


@register("neighbour_vote", with_ctes(BASE_CTES, DX_CTES, TR_CTES, CLIN_CTES, VOTE_OF_ALL_CTES) + """
SELECT hadm_id, label, round(score, 6) AS score FROM vp""")
def q_neighbour_vote(spark, sf_dir):
    return _r6_all(_vote(spark, sf_dir))


@register("neighbour_vote_metrics", with_ctes(BASE_CTES, DX_CTES, TR_CTES, CLIN_CTES, VOTE_CTES) + """
, pr AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM vp),
rk2 AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM pr),
auc AS (SELECT sum(r) FILTER (WHERE label = 1) AS sr, count(*) FILTER (WHERE label = 1) AS n1,
               count(*) FILTER (WHERE label = 0) AS n0 FROM rk2),
cm AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM pr)
SELECT 'neighbour_vote' AS model, round((tp + tn) / n, 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1_score,
  round(CASE WHEN n1 > 0 AND n0 > 0 THEN (sr - n1 * (n1 + 1) / 2.0) / (n1 * n0) END, 6) AS roc_auc
FROM cm, auc""")
def q_neighbour_vote_metrics(spark, sf_dir):
    p = _vote(spark, sf_dir, FIT_ROWS).withColumn("model", F.lit("neighbour_vote")).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int"))
    return _r6_all(evaluate.classification_metrics(p))


# --- Spark ML model benchmark (no SQL oracle: rows-only check) ----------------------

def _model_tables(spark, sf_dir):
    """Predictions for every held-out admission and importances, built once
    per input and definition like the feature tables."""
    from cohortlens.operators.models import run_model_benchmark
    f = Features(spark, sf_dir)
    made = {}

    def bench(part):
        if not made:
            made.update(run_model_benchmark(f.clin, "mortality", include_gbt=True))
        return made[part]

    return (f._stored("ml_predictions", lambda: bench("predictions")),
            f._stored("ml_importance", lambda: bench("importance")))


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    from cohortlens.operators.models import compare_models
    return compare_models(_model_tables(spark, sf_dir)[0])


@register("model_predictions")
def q_model_predictions(spark, sf_dir):
    return _model_tables(spark, sf_dir)[0]


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    from cohortlens.operators.models import top_features
    return top_features(_model_tables(spark, sf_dir)[1], 10)


@register("best_model")
def q_best_model(spark, sf_dir):
    from cohortlens.operators.models import compare_models
    return compare_models(_model_tables(spark, sf_dir)[0]).limit(1).select("model", "roc_auc", "f1_score", "accuracy")


@register("model_confusion")
def q_model_confusion(spark, sf_dir):
    return evaluate.confusion_matrix(_model_tables(spark, sf_dir)[0])


@register("model_residuals")
def q_model_residuals(spark, sf_dir):
    return evaluate.residual_histogram(_model_tables(spark, sf_dir)[0], 30, "model")


# --- documented operators (D1-D8) ----------------------------------------------------

from cohortlens.operators import documented  # noqa: E402
from cohortlens.operators.measurements import adult_cohort, measurement_features  # noqa: E402

KNN2_CTES = r"""
knn2 AS MATERIALIZED (
  SELECT b.subject_id, b.hadm_id, b.age, coalesce(b.gender, 'unknown') AS gender, coalesce(b.race, 'unknown') AS race,
         b.bmi, b.systolic_bp, b.diastolic_bp, b.los_days,
         coalesce(d.primary_diagnosis_icd, '') AS primary_diagnosis_icd,
         coalesce(d.primary_icd_3digit, '') AS primary_icd_3digit,
         coalesce(d.diagnoses_icd_list, []) AS diagnoses_icd_list,
         coalesce(d.diagnoses_3digit_list, []) AS diagnoses_3digit_list
  FROM base b LEFT JOIN dx d ON b.subject_id = d.subject_id AND b.hadm_id = d.hadm_id),
q2 AS (SELECT * FROM knn2 WHERE hadm_id = (SELECT min(hadm_id) FROM knn2)),
pool AS (
  SELECT c.*, coalesce(CAST(c.primary_diagnosis_icd = q2.primary_diagnosis_icd AS INTEGER), 0) AS primary_match,
    len(list_intersect(q2.diagnoses_3digit_list, c.diagnoses_3digit_list)) AS group_overlap,
    len(list_intersect(q2.diagnoses_icd_list, c.diagnoses_icd_list)) AS code_overlap,
    coalesce(CAST(c.primary_icd_3digit = q2.primary_icd_3digit AS INTEGER), 0) AS primary_group_match,
    abs(CAST(c.age AS DOUBLE) - CAST(q2.age AS DOUBLE)) AS age_distance,
    (coalesce(exp(-pow((CAST(q2.age AS DOUBLE) - c.age) / 10.0, 2)), 0.5)
     + coalesce(exp(-pow((q2.bmi - c.bmi) / 5.0, 2)), 0.5)
     + coalesce(exp(-pow((q2.systolic_bp - c.systolic_bp) / 15.0, 2)), 0.5)
     + coalesce(exp(-pow((q2.diastolic_bp - c.diastolic_bp) / 15.0, 2)), 0.5)
     + coalesce(CAST(c.gender = q2.gender AS DOUBLE), 0.0) + coalesce(CAST(c.race = q2.race AS DOUBLE), 0.0)) / 6.0
      AS context_similarity,
    {jg} AS jg, {jc} AS jc
  FROM knn2 c, q2 WHERE c.hadm_id <> q2.hadm_id),
reranked AS (
  SELECT *, 0.50 * jg + 0.25 * jc + 0.15 * primary_match + 0.10 * context_similarity AS rerank_score
  FROM pool ORDER BY rerank_score DESC, hadm_id ASC LIMIT 30)
""".format(jg=jac_sql("q2.diagnoses_3digit_list", "c.diagnoses_3digit_list"),
           jc=jac_sql("q2.diagnoses_icd_list", "c.diagnoses_icd_list"))


def _two_stage(spark, sf_dir):
    f = Features(spark, sf_dir)
    return documented.two_stage_search(f.knn, None)


@register("two_stage_search", with_ctes(BASE_CTES, DX_CTES, KNN2_CTES) + """
SELECT hadm_id, primary_match, group_overlap, code_overlap, primary_group_match, round(age_distance, 6) AS age_distance,
       round(context_similarity, 6) AS context_similarity, round(rerank_score, 6) AS rerank_score FROM reranked""")
def q_two_stage_search(spark, sf_dir):
    r = _two_stage(spark, sf_dir)
    return _r6_all(r.select("hadm_id", "primary_match", "group_overlap", "code_overlap", "primary_group_match",
                            "age_distance", "context_similarity", "rerank_score"))


@register("pool_recommendations", with_ctes(BASE_CTES, DX_CTES, KNN2_CTES, TALL_CTE) + """
, rows_ AS (SELECT t.*, r.rerank_score AS similarity, greatest(coalesce(CAST(r.los_days AS DOUBLE), 0.0), 1e-6) AS los
            FROM reranked r JOIN tall t ON r.hadm_id = t.hadm_id
            WHERE NOT (contains(lower(t.treatment_name), 'flush') OR contains(lower(t.treatment_name), 'bag'))),
agg AS (SELECT treatment_source, treatment_key, treatment_name, count(DISTINCT hadm_id) AS frequency,
               avg(los) AS average_los, sum(similarity / los) AS weighted_score,
               CAST(sum(treatment_count) AS BIGINT) AS event_count_sum,
               array_to_string(list_sort(list(DISTINCT hadm_id)), ',') AS supporting_hadm_ids
        FROM rows_ GROUP BY 1, 2, 3)
SELECT treatment_source, treatment_key, treatment_name, frequency, round(average_los, 6) AS average_los,
       round(weighted_score, 6) AS weighted_score, event_count_sum, supporting_hadm_ids,
       round(frequency / greatest(average_los, 1e-6), 6) AS score
FROM agg ORDER BY weighted_score DESC, frequency / greatest(average_los, 1e-6) DESC, frequency DESC,
         treatment_name ASC, treatment_key ASC LIMIT 5""")
def q_pool_recommendations(spark, sf_dir):
    f = Features(spark, sf_dir)
    return _r6_all(documented.pool_recommendations(_two_stage(spark, sf_dir), f.tall))


@register("readmission_30day", with_ctes() .rstrip().rstrip(",") + """
SELECT a.hadm_id, a.subject_id,
  CAST(EXISTS (SELECT 1 FROM admissions b WHERE b.subject_id = a.subject_id AND b.hadm_id <> a.hadm_id
               AND b.admittime > a.dischtime AND b.admittime <= a.dischtime + INTERVAL 30 DAY) AS INTEGER)
    AS readmission_30day
FROM admissions a""")
def q_readmission_30day(spark, sf_dir):
    return documented.readmission_30day(Features(spark, sf_dir).raw.admissions)


@register("base_features_lookback30", with_ctes(base_ctes(30))
    + """
SELECT hadm_id, height_inches, height_source, weight_lbs, weight_source, bmi, bmi_source, systolic_bp, systolic_source,
       diastolic_bp, diastolic_source FROM base""")
def q_base_features_lookback30(spark, sf_dir):
    r = Features(spark, sf_dir).raw
    return measurement_features(adult_cohort(r.patients, r.admissions), r.omr, lookback_days=30)


@register("data_tiers", with_ctes(BASE_CTES, DX_CTES) + """
SELECT similarity_tier, count(*) AS admissions FROM (
  SELECT CASE WHEN coalesce(d.diagnosis_count, 0) > 0 AND b.bmi IS NOT NULL AND b.systolic_bp IS NOT NULL THEN 'full'
              WHEN coalesce(d.diagnosis_count, 0) > 0 THEN 'diagnoses' ELSE 'demographics' END AS similarity_tier
  FROM base b LEFT JOIN dx d ON b.hadm_id = d.hadm_id) t GROUP BY 1""")
def q_data_tiers(spark, sf_dir):
    f = Features(spark, sf_dir)
    return documented.data_tiers(f.base, f.dx).groupBy("similarity_tier").agg(F.count(F.lit(1)).alias("admissions"))


@register("early_window_labs", with_ctes(BASE_CTES) + """
SELECT c.hadm_id, l.itemid, count(*) AS n_results, min(l.valuenum) AS min_value, max(l.valuenum) AS max_value
FROM cohort c JOIN labevents l ON c.subject_id = l.subject_id AND l.valuenum IS NOT NULL
 AND l.charttime >= c.admittime AND l.charttime < c.admittime + INTERVAL 24 HOUR
GROUP BY 1, 2""")
def q_early_window_labs(spark, sf_dir):
    r = Features(spark, sf_dir).raw
    return documented.early_window_labs(adult_cohort(r.patients, r.admissions), r.labevents, 24)


@register("euclidean_neighbours", """
WITH q AS (SELECT * FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT e.vec_id, round(sqrt(list_sum(list_transform(list_zip(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])),
                                                  lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 6) AS distance
FROM embeddings e, q WHERE e.vec_id <> q.vec_id
ORDER BY distance ASC, e.vec_id ASC LIMIT 10""")
def q_euclidean_neighbours(spark, sf_dir):
    emb = Features(spark, sf_dir).table("embeddings")
    return _r6_all(documented.euclidean_neighbours(emb, None, 10))


@register("euclidean_knn_batch", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT q.vec_id AS query_id, e.vec_id AS id,
             sqrt(list_sum(list_transform(list_zip(e.v, q.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
      FROM e, e q WHERE q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id)
SELECT query_id, id, round(distance, 6) AS distance FROM d
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 10""")
def q_euclidean_knn_batch(spark, sf_dir):
    """Ten nearest vectors of every id divisible by 50 among all vectors."""
    emb = Features(spark, sf_dir).table("embeddings")
    return _r6_all(knn_join(emb.where("vec_id % 50 = 0"), emb, 10, key="vec_id", vector="embedding"))


# --- profile search (S8, P18, P19) ---------------------------------------------------

@register("profile_knn", with_ctes(BASE_CTES, DX_CTES, KNN_CTES.split("\nq AS (")[0]) + """
, src AS (SELECT * FROM z WHERE hadm_id = (SELECT max(hadm_id) FROM z)),
qp AS (SELECT s.*, len(s.diagnoses_icd_list) AS n_codes,
              (CAST(coalesce(s.age, m.m_age) AS DOUBLE) - st.a_age) / st.s_age AS qz_age,
              (coalesce(s.bmi, m.m_bmi) - st.a_bmi) / st.s_bmi AS qz_bmi,
              (coalesce(s.systolic_bp, m.m_systolic_bp) - st.a_systolic_bp) / st.s_systolic_bp AS qz_systolic_bp,
              (coalesce(s.diastolic_bp, m.m_diastolic_bp) - st.a_diastolic_bp) / st.s_diastolic_bp AS qz_diastolic_bp,
              (len(s.diagnoses_icd_list) - st.a_diagnosis_count) / st.s_diagnosis_count AS qz_diagnosis_count,
              (len(s.diagnoses_icd_list) - st.a_unique_icd_count) / st.s_unique_icd_count AS qz_unique_icd_count,
              ((CASE WHEN len(s.diagnoses_icd_list) > 0 THEN 1.0 ELSE 0.0 END) - st.a_diagnosis_diversity_ratio)
                / st.s_diagnosis_diversity_ratio AS qz_diagnosis_diversity_ratio
       FROM src s, med m, st),
ps AS (
  SELECT c.hadm_id, c.subject_id, c.los_days,
    (qp.qz_age * c.z_age + qp.qz_bmi * c.z_bmi + qp.qz_systolic_bp * c.z_systolic_bp
     + qp.qz_diastolic_bp * c.z_diastolic_bp + qp.qz_diagnosis_count * c.z_diagnosis_count
     + qp.qz_unique_icd_count * c.z_unique_icd_count + qp.qz_diagnosis_diversity_ratio * c.z_diagnosis_diversity_ratio
     + CAST(c.gender = qp.gender AS DOUBLE) + CAST(c.race = qp.race AS DOUBLE)
     + len(list_intersect(qp.diagnoses_icd_list, c.diagnoses_icd_list)))
    / (sqrt(c.z_age * c.z_age + c.z_bmi * c.z_bmi + c.z_systolic_bp * c.z_systolic_bp
            + c.z_diastolic_bp * c.z_diastolic_bp + c.z_diagnosis_count * c.z_diagnosis_count
            + c.z_unique_icd_count * c.z_unique_icd_count + c.z_diagnosis_diversity_ratio * c.z_diagnosis_diversity_ratio
            + 2 + len(c.diagnoses_3digit_list) + len(c.diagnoses_icd_list))
       * sqrt(qp.qz_age * qp.qz_age + qp.qz_bmi * qp.qz_bmi + qp.qz_systolic_bp * qp.qz_systolic_bp
              + qp.qz_diastolic_bp * qp.qz_diastolic_bp + qp.qz_diagnosis_count * qp.qz_diagnosis_count
              + qp.qz_unique_icd_count * qp.qz_unique_icd_count
              + qp.qz_diagnosis_diversity_ratio * qp.qz_diagnosis_diversity_ratio + 2 + qp.n_codes)) AS cosine
  FROM z c, qp)
SELECT hadm_id, subject_id, round(1.0 - cosine, 6) AS distance, round(least(greatest(cosine, 0.0), 1.0), 6) AS similarity,
       los_days FROM ps ORDER BY 1.0 - cosine ASC, hadm_id ASC LIMIT 7""")
def q_profile_knn(spark, sf_dir):
    """A profile batch read from JSON (here: the newest admission rendered to
    JSON and parsed back with the declared schema), completed against the
    cohort vocabulary, then searched."""
    from cohortlens.sources.io import PROFILE_SCHEMA
    knn = Features(spark, sf_dir).knn
    src = knn.orderBy(F.col("hadm_id").desc()).limit(1)
    js = src.select(F.to_json(F.struct(
        F.lit(1).cast("long").alias("profile_id"), F.col("age").cast("double").alias("age"), "gender", "race",
        "bmi", "systolic_bp", "diastolic_bp", "diagnoses_icd_list")).alias("json"))
    profiles = js.select(F.from_json("json", PROFILE_SCHEMA).alias("p")).select("p.*")
    done = cosine.complete_profile(profiles, knn).first().asDict()
    return _r6_all(cosine.knn_for_profile(knn, done, k=7))


PROFILE_BATCH_CTES = KNN_CTES.split("\nq AS (")[0] + """
qp AS MATERIALIZED (SELECT s.*, len(s.diagnoses_icd_list) AS n_codes, {z}
       FROM z s, med m, st WHERE s.hadm_id % 50 = 0),
ps AS (
  SELECT qp.hadm_id AS profile_id, c.hadm_id, c.subject_id, c.los_days,
    ({dot} + CAST(c.gender = qp.gender AS DOUBLE) + CAST(c.race = qp.race AS DOUBLE)
     + len(list_intersect(qp.diagnoses_icd_list, c.diagnoses_icd_list)))
    / (sqrt({cn} + 2 + len(c.diagnoses_3digit_list) + len(c.diagnoses_icd_list)) * sqrt({qn} + 2 + qp.n_codes)) AS cosine
  FROM z c, qp)
""".format(
    z=", ".join(f"({v} - st.a_{c}) / st.s_{c} AS qz_{c}" for c, v in [
        ("age", "CAST(coalesce(s.age, m.m_age) AS DOUBLE)"), *[(c, f"coalesce(s.{c}, m.m_{c})") for c in ("bmi", "systolic_bp", "diastolic_bp")],
        ("diagnosis_count", "len(s.diagnoses_icd_list)"), ("unique_icd_count", "len(s.diagnoses_icd_list)"),
        ("diagnosis_diversity_ratio", "(CASE WHEN len(s.diagnoses_icd_list) > 0 THEN 1.0 ELSE 0.0 END)")]),
    dot=" + ".join(f"qp.qz_{c} * c.z_{c}" for c in _N), cn=" + ".join(f"c.z_{c} * c.z_{c}" for c in _N),
    qn=" + ".join(f"qp.qz_{c} * qp.qz_{c}" for c in _N))


@register("profile_knn_batch", with_ctes(BASE_CTES, DX_CTES, PROFILE_BATCH_CTES) + """
SELECT profile_id, CAST(row_number() OVER w AS INTEGER) AS rank, hadm_id, subject_id, round(1.0 - cosine, 6) AS distance,
       round(least(greatest(cosine, 0.0), 1.0), 6) AS similarity, los_days
FROM ps WINDOW w AS (PARTITION BY profile_id ORDER BY round(1.0 - cosine, 9), hadm_id) QUALIFY row_number() OVER w <= 7""")
def q_profile_knn_batch(spark, sf_dir):
    """A batch of JSON profiles (every admission whose id is divisible by 50,
    rendered and parsed back) against the whole cohort."""
    from cohortlens.sources.io import PROFILE_SCHEMA
    knn = Features(spark, sf_dir).knn
    js = knn.where("hadm_id % 50 = 0").select(F.to_json(F.struct(
        F.col("hadm_id").alias("profile_id"), F.col("age").cast("double").alias("age"), "gender", "race",
        "bmi", "systolic_bp", "diastolic_bp", "diagnoses_icd_list")).alias("json"))
    profiles = js.select(F.from_json("json", PROFILE_SCHEMA).alias("p")).select("p.*")
    return _r6_all(cosine.knn_for_profiles(knn, cosine.complete_profile(profiles, knn), k=7))


# --- dataset summary and feature checks (A25, A31) -------------------------------------

@register("dataset_summary", with_ctes(BASE_CTES, DX_CTES) + f"""
, j AS (SELECT b.*, d.primary_diagnosis_icd, d.diagnosis_count, d.diagnoses_icd_list, d.diagnoses_3digit_list
        FROM base b JOIN dx d ON b.hadm_id = d.hadm_id),
q AS (SELECT * FROM j WHERE hadm_id = (SELECT min(hadm_id) FROM j)),
s AS (SELECT c.*, 0.40 * coalesce(CAST(c.primary_diagnosis_icd = q.primary_diagnosis_icd AS DOUBLE), 0.0)
                 + 0.35 * {jac_sql('q.diagnoses_icd_list', 'c.diagnoses_icd_list')}
                 + 0.25 * {jac_sql('q.diagnoses_3digit_list', 'c.diagnoses_3digit_list')} AS sim FROM j c, q)
SELECT count(*) AS row_count, count(DISTINCT subject_id) AS unique_subjects,
       round(avg(CAST(mortality AS DOUBLE)), 6) AS mortality_rate, round(avg(los_days), 6) AS mean_los_days,
       round(avg(diagnosis_count), 6) AS mean_diagnosis_count, round(min(sim), 6) AS min_similarity,
       round(avg(sim), 6) AS mean_similarity, round(max(sim), 6) AS max_similarity FROM s""")
def q_dataset_summary(spark, sf_dir):
    from cohortlens.operators.similarity import diagnosis_similarity_expr, lookup_row
    f = Features(spark, sf_dir)
    j = joined_dataset(f.base, f.dx, None)
    q = lookup_row(j, "hadm_id", None, columns=["hadm_id", "primary_diagnosis_icd", "diagnoses_icd_list",
                                                 "diagnoses_3digit_list"])
    return _r6_all(evaluate.dataset_summary(j, q, diagnosis_similarity_expr(q)))


@register("knn_feature_missing", with_ctes(BASE_CTES, DX_CTES, KNN_CTES.split("\nmed AS (")[0]) + """
SELECT """ + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS {c}_missing"
                       for c in cosine.KNN_NUMERIC) + " FROM knn")
def q_knn_feature_missing(spark, sf_dir):
    knn = Features(spark, sf_dir).knn
    return quality.nan_check(knn.select(*[F.col(c).cast("double").alias(c) for c in cosine.KNN_NUMERIC]),
                             cosine.KNN_NUMERIC)
