"""Base feature table: adult cohort plus the latest body measurements.

Tier 1 is the latest measurement dated inside the stay; tier 2 (only for
types without tier 1) is the latest one dated before admission, else the
latest one overall, else an undated one.  "Latest" means chart date descending, then sequence
number ascending, null last (then value, to make the order total).

Scale design: a subject may own a large share of all rows, so no join here
pairs every admission of a subject with every measurement of that subject.
Measurements are first reduced to one row per (subject, type, day) by partial
aggregates.  They are then read in order of day together with the admissions'
bounds, per (subject, type, year), so that "latest on or before day b" is the
last record seen; a table with one row per (subject, type, year) carries the
latest record of earlier years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import bp_parts
from cohortlens.session import materialize

# Measurement names and the output columns they feed.
HEIGHT = "Height (Inches)"
WEIGHT = "Weight (Lbs)"
BMI = "BMI (kg/m2)"
BLOOD_PRESSURE = "Blood Pressure"
MEASUREMENT_NAMES = [HEIGHT, WEIGHT, BMI, BLOOD_PRESSURE]
_KEYS = {HEIGHT: "height", WEIGHT: "weight", BMI: "bmi", BLOOD_PRESSURE: "bp"}

OPTIONAL_ADMISSION_COLUMNS = ["admission_location", "discharge_location", "insurance", "language",
                              "marital_status"]
OPTIONAL_PATIENT_COLUMNS = ["anchor_year", "anchor_year_group"]


def adult_cohort(patients: DataFrame, admissions: DataFrame, min_age: int = 18) -> DataFrame:
    """P1 + J1: adults with a valid stay (discharge known and after admission)."""
    a_cols = ["subject_id", "hadm_id", "admittime", "dischtime", "admission_type"]
    a_cols += [c for c in OPTIONAL_ADMISSION_COLUMNS + ["race"] if c in admissions.columns]
    p_cols = ["subject_id", "gender", "anchor_age"]
    p_cols += [c for c in OPTIONAL_PATIENT_COLUMNS if c in patients.columns]
    if "race" not in admissions.columns and "race" in patients.columns:
        p_cols.append("race")
    a = admissions.select(*a_cols, F.col("hospital_expire_flag").alias("mortality"))
    p = patients.select(*p_cols)
    return (p.filter(F.col("anchor_age") >= min_age)
            .join(a.filter(F.col("dischtime").isNotNull() & (F.col("admittime") < F.col("dischtime"))),
                  "subject_id"))


def _order_key(day: str = "chartdate") -> F.Column:
    """Sort key whose minimum is the latest row: newest day, lowest sequence
    (null last), non-null value before null, then smallest value."""
    return F.struct((-F.unix_date(F.col(day))).alias("neg_day"), F.col("seq_num").isNull().alias("seq_null"),
                    F.col("seq_num").alias("seq"), F.col("result_value").isNull().alias("value_null"),
                    F.col("result_value").alias("value"))


def daily_latest(omr: DataFrame, names: list[str] = MEASUREMENT_NAMES) -> DataFrame:
    """One row per (subject, type, day) holding that day's first record; the
    day of undated records is null."""
    return (omr.filter(F.col("result_name").isin(names))
            .groupBy("subject_id", "result_name", "chartdate")
            .agg(F.min(_order_key()).alias("ord"))
            .withColumn("yr", F.year("chartdate"))
            .withColumn("mo", F.month("chartdate")))


def latest_as_of(probes: DataFrame, daily: DataFrame, names: list[str] = MEASUREMENT_NAMES) -> DataFrame:
    """As-of lookup: for each probe (hadm_id, admit_day, subject_id, kind, bound
    day b) and measurement type, the latest record dated on or before b; for
    kind ``t2`` else the subject's latest record overall, else an undated one.

    Probes and daily records are one table, dealt by (subject, year) and read
    in order of day: the last record of each type seen is the answer within the
    bound's year (a window of one subject's year, so a hot subject is split by
    year; a probe is one row for all types).  A small table with the latest
    records of all earlier years (a window over the calendar) answers for types
    of which none is seen in the year.  Returns (hadm_id, admit_day, kind) and a
    column ``ord_<place of the type>`` for each type, of its day and value."""
    # A type has one record a day, so the day alone orders its records.
    slim = daily.select("subject_id", "result_name", F.col("chartdate").alias("day"), "yr",
                        F.struct(F.col("ord")["neg_day"].alias("neg_day"), F.col("ord")["value"].alias("value")).alias("ord"))
    dated = slim.filter(F.col("day").isNotNull())
    kind = slim.schema["ord"].dataType
    types = {f"ord_{i}": F.col("result_name") == n for i, n in enumerate(names)}
    marks = probes.select("subject_id", F.lit(None).cast("string").alias("result_name"), F.col("b").alias("day"), F.year("b").alias("yr"),
                          F.lit(None).cast(kind).alias("ord"), "hadm_id", "admit_day", "kind")
    records = dated.select("subject_id", "result_name", "day", "yr", "ord",
                           *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in ("hadm_id", "admit_day", "kind")])
    in_order = (Window.partitionBy("subject_id", "yr")
                .orderBy("day", F.col("kind").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (records.unionByName(marks)
             .select("subject_id", "yr", "hadm_id", "admit_day", "kind",
                     *[F.last(F.when(t, F.col("ord")), ignorenulls=True).over(in_order).alias(c) for c, t in types.items()])
             .filter(F.col("hadm_id").isNotNull()))

    yearly = slim.groupBy("subject_id", "yr").agg(*[F.min(F.when(t, F.col("ord"))).alias(c) for c, t in types.items()])
    by_year = Window.partitionBy("subject_id").orderBy("yr")
    dated_years = yearly.filter(F.col("yr").isNotNull())
    earlier = dated_years.select(F.col("subject_id").alias("e_subject"), F.col("yr").alias("e_yr"),
                                 *[F.min(c).over(by_year.rowsBetween(Window.unboundedPreceding, 0)).alias(f"e_{c}") for c in types],
                                 F.lead("yr").over(by_year).alias("e_next"))
    ever = yearly.groupBy(F.col("subject_id").alias("s_subject")).agg(*[F.coalesce(
        F.min(F.when(F.col("yr").isNotNull(), F.col(c))), F.min(F.when(F.col("yr").isNull(), F.col(c)))).alias(f"s_{c}") for c in types])
    out = found.join(earlier, (F.col("subject_id") == F.col("e_subject"))
                     & (F.col("e_yr") < F.col("yr")) & (F.col("e_next").isNull() | (F.col("yr") <= F.col("e_next"))), "left")
    out = out.join(ever, F.col("subject_id") == F.col("s_subject"), "left")
    return out.select("hadm_id", "admit_day", "kind", *[
        F.when(F.col("kind") == "t2", F.coalesce(c, f"e_{c}", f"s_{c}")).otherwise(F.coalesce(c, f"e_{c}")).alias(c) for c in types])


def measurement_features(cohort: DataFrame, omr: DataFrame, lookback_days: int = 0) -> DataFrame:
    """One row per admission with tiered values.

    Tier 1 probes at the discharge day (a hit counts only if dated on or
    after the admission day); tier 2 probes at the day before admission,
    falling back to the subject's overall latest record.  Returns hadm_id
    plus height_inches, weight_lbs, bmi, systolic_bp, diastolic_bp and their
    *_source columns.  ``lookback_days`` > 0 widens the tier-1 window to
    start that many days before admission (D5).
    """
    admit = F.to_date("admittime")
    bounds = F.array(F.struct(F.lit("t1").alias("kind"), F.to_date("dischtime").alias("b")),
                     F.struct(F.lit("t2").alias("kind"), F.date_sub(admit, 1).alias("b")))
    probes = (cohort.select("hadm_id", "subject_id", admit.alias("admit_day"), F.explode(bounds).alias("pb"))
              .select("hadm_id", "subject_id", "admit_day", "pb.kind", "pb.b"))
    # The daily table is read three times; written once, its input is read once.
    cands = latest_as_of(probes, materialize(daily_latest(omr)))
    aggs = []
    for i, name in enumerate(MEASUREMENT_NAMES):
        for kind in ("t1", "t2"):
            aggs.append(F.min(F.when(F.col("kind") == kind, F.col(f"ord_{i}"))).alias(f"{_KEYS[name]}_{kind}"))
    per_adm = cands.groupBy("hadm_id", "admit_day").agg(*aggs)

    out = [F.col("hadm_id")]
    chosen = {}
    for name, key in _KEYS.items():
        t1 = F.col(f"{key}_t1")
        # Tier 1 counts only when its latest in-stay row is on or after admission.
        t1_ok = t1.isNotNull() & (-t1["neg_day"] >= F.unix_date(F.col("admit_day")) - F.lit(int(lookback_days)))
        t1_val = F.when(t1_ok, t1["value"])
        t2_val = F.col(f"{key}_t2")["value"]
        value = F.when(t1_val.isNotNull(), t1_val).otherwise(t2_val)
        source = (F.when(t1_val.isNotNull(), F.lit("TIER1"))
                  .when(t2_val.isNotNull(), F.lit("TIER2")))
        chosen[key] = (value, source)
    for key, out_name in (("height", "height_inches"), ("weight", "weight_lbs"), ("bmi", "bmi")):
        value, source = chosen[key]
        out += [value.try_cast("double").alias(out_name), source.alias(f"{key}_source")]
    bp_value, bp_source = chosen["bp"]
    sys_, dia = bp_parts(bp_value)
    out += [sys_.alias("systolic_bp"), bp_source.alias("systolic_source"),
            dia.alias("diastolic_bp"), bp_source.alias("diastolic_source")]
    return per_adm.select(*out)


def base_features(patients: DataFrame, admissions: DataFrame, omr: DataFrame,
                  min_age: int = 18, cohort: DataFrame | None = None) -> DataFrame:
    """The base feature table: one row per adult admission; ``cohort`` is
    :func:`adult_cohort` of the same tables where it is stored already."""
    # The cohort feeds the probes of every as-of branch and the final join:
    # computed once (checkpoint) instead of once per branch.
    if cohort is None:
        cohort = materialize(adult_cohort(patients, admissions, min_age))
    feats = measurement_features(cohort, omr)
    los_exact = ((F.unix_micros(F.col("dischtime").cast("timestamp"))
                  - F.unix_micros(F.col("admittime").cast("timestamp"))) / F.lit(86_400_000_000.0))
    base = cohort.join(feats, "hadm_id", "left")
    opt = [c for c in OPTIONAL_ADMISSION_COLUMNS + OPTIONAL_PATIENT_COLUMNS if c in base.columns]
    return base.select(
        "subject_id", "hadm_id", "admittime", "dischtime", "admission_type", *opt,
        "gender", "anchor_age", F.col("anchor_age").alias("age"), "race",
        F.datediff(F.to_date("dischtime"), F.to_date("admittime")).cast("long").alias("los_days"),
        los_exact.alias("los_days_exact"), "mortality",
        "height_inches", "height_source", "weight_lbs", "weight_source", "bmi", "bmi_source",
        "systolic_bp", "systolic_source", "diastolic_bp", "diastolic_source")
