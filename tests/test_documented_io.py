import datetime as dt
import random

from cohortlens.operators.documented import early_window_labs, readmission_30day
from cohortlens.sources.io import land_raw_tables, read_columns

TS = dt.datetime


def test_csv_landing_keeps_codes_as_strings(spark, tmp_path):
    src = tmp_path / "csv"
    src.mkdir()
    (src / "diagnoses_icd.csv").write_text(
        "subject_id,hadm_id,seq_num,icd_code,icd_version\n1,10,1,0389,9\n1,10,2,I10,10\n")
    out = tmp_path / "parquet"
    land_raw_tables(spark, str(src), str(out), partitions=2)
    df = read_columns(spark, str(out / "diagnoses_icd"), ["hadm_id", "icd_code"], ["not_there"])
    assert df.columns == ["hadm_id", "icd_code"]
    assert sorted(r.icd_code for r in df.collect()) == ["0389", "I10"]   # leading zero kept


def test_readmission_matches_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for h in range(60):
        admit = TS(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 200), hours=rnd.randint(0, 23))
        rows.append((rnd.randint(1, 5), h, admit, admit + dt.timedelta(days=rnd.randint(0, 10), hours=3)))
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, admittime timestamp, dischtime timestamp")
    got = {r.hadm_id: r.readmission_30day for r in readmission_30day(df).collect()}
    for s, h, a, d in rows:
        want = any(s2 == s and h2 != h and d < a2 <= d + dt.timedelta(days=30) for s2, h2, a2, _ in rows)
        assert got[h] == int(want)


def test_early_window_labs_matches_brute_force(spark):
    rnd = random.Random(6)
    adm = [(1, 100, TS(2020, 3, 1, 22)), (2, 200, TS(2020, 3, 5, 1))]
    labs = [(rnd.choice([1, 2]), rnd.choice([7, 8]), TS(2020, 3, 1) + dt.timedelta(hours=rnd.randint(0, 150)),
             float(rnd.randint(1, 9))) for _ in range(80)]
    cohort = spark.createDataFrame(adm, "subject_id long, hadm_id long, admittime timestamp")
    lab_df = spark.createDataFrame(labs, "subject_id long, itemid long, charttime timestamp, valuenum double")
    got = {(r.hadm_id, r.itemid): (r.n_results, r.min_value, r.max_value)
           for r in early_window_labs(cohort, lab_df, 24).collect()}
    want = {}
    for s, h, a in adm:
        for s2, item, t, v in labs:
            if s2 == s and a <= t < a + dt.timedelta(hours=24):
                n, lo, hi = want.get((h, item), (0, v, v))
                want[(h, item)] = (n + 1, min(lo, v), max(hi, v))
    assert got == want
