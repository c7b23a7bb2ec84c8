"""Declared schemas of the raw admission tables (codes are strings)."""

from pyspark.sql import types as T

_L, _I, _S, _D, _TS, _DT = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampType(), T.DateType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_SCHEMAS = {
    "patients": _schema(("subject_id", _L), ("gender", _S), ("anchor_age", _I), ("anchor_year", _I),
                        ("anchor_year_group", _S), ("dod", _DT)),
    "admissions": _schema(("subject_id", _L), ("hadm_id", _L), ("admittime", _TS), ("dischtime", _TS),
                          ("deathtime", _TS), ("admission_type", _S), ("admit_provider_id", _S),
                          ("admission_location", _S), ("discharge_location", _S), ("insurance", _S),
                          ("language", _S), ("marital_status", _S), ("race", _S), ("edregtime", _TS),
                          ("edouttime", _TS), ("hospital_expire_flag", _I)),
    "omr": _schema(("subject_id", _L), ("chartdate", _DT), ("seq_num", _I), ("result_name", _S),
                   ("result_value", _S)),
    "diagnoses_icd": _schema(("subject_id", _L), ("hadm_id", _L), ("seq_num", _I), ("icd_code", _S),
                             ("icd_version", _I)),
    "d_icd_diagnoses": _schema(("icd_code", _S), ("icd_version", _I), ("long_title", _S)),
    "procedures_icd": _schema(("subject_id", _L), ("hadm_id", _L), ("seq_num", _I), ("chartdate", _DT),
                              ("icd_code", _S), ("icd_version", _I)),
    "d_icd_procedures": _schema(("icd_code", _S), ("icd_version", _I), ("long_title", _S)),
    "prescriptions": _schema(("subject_id", _L), ("hadm_id", _L), ("pharmacy_id", _L), ("poe_id", _S),
                             ("poe_seq", _I), ("order_provider_id", _S), ("starttime", _TS), ("stoptime", _TS),
                             ("drug_type", _S), ("drug", _S), ("formulary_drug_cd", _S), ("gsn", _S), ("ndc", _S),
                             ("prod_strength", _S), ("form_rx", _S), ("dose_val_rx", _S), ("dose_unit_rx", _S),
                             ("form_val_disp", _S), ("form_unit_disp", _S), ("doses_per_24_hrs", _D),
                             ("route", _S)),
    "labevents": _schema(("labevent_id", _L), ("subject_id", _L), ("hadm_id", _L), ("specimen_id", _L),
                         ("itemid", _L), ("order_provider_id", _S), ("charttime", _TS), ("storetime", _TS),
                         ("value", _S), ("valuenum", _D), ("valueuom", _S), ("ref_range_lower", _D),
                         ("ref_range_upper", _D), ("flag", _S), ("priority", _S), ("comments", _S)),
    "d_labitems": _schema(("itemid", _L), ("label", _S), ("fluid", _S), ("category", _S)),
    "transfers": _schema(("subject_id", _L), ("hadm_id", _L), ("transfer_id", _L), ("eventtype", _S),
                         ("careunit", _S), ("intime", _TS), ("outtime", _TS)),
}
