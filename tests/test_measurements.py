import datetime as dt

from cohortlens.operators.measurements import base_features

D = dt.date
TS = dt.datetime


def _tables(spark):
    patients = spark.createDataFrame(
        [(1, "F", 70, "A"), (2, "M", 40, "B"), (3, "M", 10, "C")],
        "subject_id long, gender string, anchor_age int, race string")
    admissions = spark.createDataFrame(
        [(1, 11, TS(2020, 3, 10), TS(2020, 3, 15), "URGENT", 0),
         (1, 12, TS(2021, 6, 1), TS(2021, 6, 3, 12), "ELECTIVE", 1),
         (2, 21, TS(2020, 1, 5), TS(2020, 1, 7), "URGENT", 0),
         (2, 22, TS(2020, 2, 1), None, "URGENT", 0),          # no discharge: dropped
         (3, 31, TS(2020, 1, 1), TS(2020, 1, 2), "URGENT", 0)],  # minor: dropped
        "subject_id long, hadm_id long, admittime timestamp, dischtime timestamp, admission_type string, "
        "hospital_expire_flag int")
    omr = spark.createDataFrame(
        [(1, D(2020, 3, 12), 1, "Weight (Lbs)", "150"),      # in stay of 11
         (1, D(2020, 3, 12), 2, "Weight (Lbs)", "151"),      # same day, later seq: loses
         (1, D(2020, 3, 14), 1, "Blood Pressure", "120/80"),  # in stay of 11
         (1, D(2019, 12, 1), 1, "Height (Inches)", "65"),     # before 11 and 12
         (1, D(2020, 5, 1), 1, "Height (Inches)", "66"),      # after 11, before 12
         (1, D(2021, 6, 2), 1, "Blood Pressure", "n/a"),      # in stay of 12, unparseable
         (2, D(2020, 2, 20), 1, "BMI (kg/m2)", "24.5"),      # only after 21
         (2, D(2020, 3, 20), 1, "BMI (kg/m2)", "25.5")],
        "subject_id long, chartdate date, seq_num int, result_name string, result_value string")
    return patients, admissions, omr


def test_tiers(spark):
    rows = {r.hadm_id: r for r in base_features(*_tables(spark)).collect()}
    assert sorted(rows) == [11, 12, 21]
    a = rows[11]
    assert (a.weight_lbs, a.weight_source) == (150.0, "TIER1")
    assert (a.systolic_bp, a.diastolic_bp, a.systolic_source) == (120.0, 80.0, "TIER1")
    assert (a.height_inches, a.height_source) == (65.0, "TIER2")       # latest before admission
    assert a.los_days == 5 and a.age == 70
    b = rows[12]
    assert (b.height_inches, b.height_source) == (66.0, "TIER2")
    assert (b.weight_lbs, b.weight_source) == (150.0, "TIER2")        # same day: lowest seq wins
    assert b.systolic_bp is None and b.systolic_source == "TIER1"      # unparseable text blocks tier 2
    assert abs(b.los_days_exact - 2.5) < 1e-9 and b.los_days == 2
    c = rows[21]
    assert (c.bmi, c.bmi_source) == (25.5, "TIER2")                    # nothing before: overall latest


def _brute_tiers(adms, omr, names):
    """Direct reading of the tier rules (rank, then keep non-null)."""
    out = {}
    for subj, hadm, admit, disch in adms:
        a_day, d_day = admit.date(), disch.date()
        for name in names:
            rows = [r for r in omr if r[0] == subj and r[3] == name]
            t1 = sorted((r for r in rows if a_day <= r[1] <= d_day),
                        key=lambda r: (-r[1].toordinal(), r[2], r[4] is None, r[4] or ""))
            if t1 and t1[0][4] is not None:
                out[(hadm, name)] = (t1[0][4], "TIER1")
                continue
            t2 = sorted(rows, key=lambda r: (0 if r[1] < a_day else 1, -r[1].toordinal(), r[2],
                                             r[4] is None, r[4] or ""))
            out[(hadm, name)] = (t2[0][4], "TIER2") if t2 and t2[0][4] is not None else (None, None)
    return out


def test_tiers_random_against_brute_force(spark):
    import random
    rnd = random.Random(9)
    names = ["Height (Inches)", "Weight (Lbs)"]
    adms, omr = [], []
    for h in range(40):
        subj = rnd.randint(1, 4)
        admit = TS(2018, 1, 1) + dt.timedelta(days=rnd.randint(0, 1500))
        adms.append((subj, h, admit, admit + dt.timedelta(days=rnd.randint(1, 40))))
    for _ in range(300):
        omr.append((rnd.randint(1, 4), D(2017, 6, 1) + dt.timedelta(days=rnd.randint(0, 1900)), rnd.randint(1, 3),
                    rnd.choice(names), rnd.choice([None, "60", "61", "62"])))
    patients = spark.createDataFrame([(s, "F", 50, "A") for s in range(1, 5)],
                                     "subject_id long, gender string, anchor_age int, race string")
    admissions = spark.createDataFrame([(s, h, a, d, "U", 0) for s, h, a, d in adms],
                                       "subject_id long, hadm_id long, admittime timestamp, dischtime timestamp, "
                                       "admission_type string, hospital_expire_flag int")
    omr_df = spark.createDataFrame(omr, "subject_id long, chartdate date, seq_num int, result_name string, "
                                        "result_value string")
    got = {r.hadm_id: r for r in base_features(patients, admissions, omr_df).collect()}
    want = _brute_tiers(adms, omr, names)
    for (hadm, name), (value, source) in want.items():
        r = got[hadm]
        col, src = ("height_inches", "height_source") if name.startswith("Height") else ("weight_lbs", "weight_source")
        assert (r[col], r[src]) == ((float(value) if value is not None else None), source), (hadm, name)
