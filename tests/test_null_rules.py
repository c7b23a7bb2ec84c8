"""Null codes, sequences and dates, on invented rows."""

import datetime as dt

from cohortlens.operators.codes import diagnosis_features
from cohortlens.operators.measurements import base_features
from cohortlens.operators.treatments import treatment_features_minmax

TS = dt.datetime


def test_null_codes_count_and_null_sequence_comes_last(spark):
    d = spark.createDataFrame(
        [(1, 1, "A1", 9), (1, 2, None, 9), (2, 1, None, 10), (3, None, "B1", 10), (3, 1, "C1", 10), (3, 2, "A0", 9),
         (4, None, "Z9", 9), (4, None, "Y9", 9)], "hadm_id long, seq_num int, icd_code string, icd_version int")
    base = spark.createDataFrame([(i, 10 + i) for i in range(1, 5)], "hadm_id long, subject_id long")
    titles = spark.createDataFrame([("A1", 9, "a"), (" C1", 10, "c2"), ("C1", 10, "c1")], "icd_code string, icd_version int, long_title string")
    rows = {r.hadm_id: r for r in diagnosis_features(d, base, titles).collect()}
    assert (rows[1].diagnosis_count, rows[1].unique_icd_count, rows[1].primary_diagnosis_icd) == (2, 1, "A1")
    assert (rows[2].diagnosis_count, rows[2].primary_diagnosis_icd, rows[2].diagnoses_icd_list) == (1, None, [])
    assert (rows[3].primary_diagnosis_icd, rows[3].primary_diagnosis_title, rows[3].icd_version_mix) == ("C1", "c1", "mixed")
    assert rows[4].primary_diagnosis_icd == "Y9" and rows[4].primary_diagnosis_title is None


def test_null_sequence_and_undated_measurements(spark):
    patients = spark.createDataFrame([(1, "F", 70, "A"), (2, "M", 40, "B")], "subject_id long, gender string, anchor_age int, race string")
    admissions = spark.createDataFrame([(1, 11, TS(2020, 3, 10), TS(2020, 3, 15), "U", 0), (2, 21, TS(2020, 1, 5), TS(2020, 1, 7), "U", 0)],
                                       "subject_id long, hadm_id long, admittime timestamp, dischtime timestamp, admission_type string, "
                                       "hospital_expire_flag int")
    day = dt.date(2020, 3, 12)
    omr = spark.createDataFrame(
        [(1, day, None, "BMI (kg/m2)", "99"), (1, day, 1, "BMI (kg/m2)", "22"),        # null sequence comes last
         (1, None, 1, "Height (Inches)", "60"), (1, dt.date(2020, 9, 1), 5, "Height (Inches)", "61"),  # dated before undated
         (2, None, None, "BMI (kg/m2)", "31"), (2, None, 2, "BMI (kg/m2)", "30")],      # undated only: used, lowest sequence
        "subject_id long, chartdate date, seq_num int, result_name string, result_value string")
    rows = {r.hadm_id: r for r in base_features(patients, admissions, omr).collect()}
    assert (rows[11].bmi, rows[11].bmi_source) == (22.0, "TIER1")
    assert (rows[11].height_inches, rows[11].height_source) == (61.0, "TIER2")
    assert (rows[21].bmi, rows[21].bmi_source) == (30.0, "TIER2")


def test_nested_lists_are_null_when_there_is_none(spark):
    rx = spark.createDataFrame([(1, 11, TS(2020, 1, 1), None, "MAIN", "Aspirin ", "F1", "5 mg", "PO", 2)],
                               "subject_id long, hadm_id long, starttime timestamp, stoptime timestamp, drug_type string, drug string, "
                               "formulary_drug_cd string, prod_strength string, route string, doses_per_24_hrs int")
    proc = spark.createDataFrame([(1, 11, 1, "0159", 9), (1, 11, 2, None, 9)], "subject_id long, hadm_id long, seq_num int, icd_code string, icd_version int")
    titles = spark.createDataFrame([("0159", 9, "Excision")], "icd_code string, icd_version int, long_title string")
    base = spark.createDataFrame([(11,)], "hadm_id long")
    r = treatment_features_minmax(rx, proc, titles, base, include_raw_columns=True).first()
    assert [(x.icd_code, x.long_title) for x in r.procedures_icd9] == [("0159", "Excision")] and r.procedures_icd10 is None
    assert r.prescriptions_raw[0].drug == "Aspirin" and r.surgery_count == 1 and r.treatment_days == 1
