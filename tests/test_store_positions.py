"""Stored tables by file listing, rows by position, batches of profiles."""
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.quantiles import exact_medians
from cohortlens.operators import cosine, quality
from cohortlens.operators.similarity import key_at, lookup_row
from cohortlens.plans import features
from cohortlens.plans.features import Features, input_files

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    for name in features.ALL_INPUTS:
        shutil.copyfile(f"{DATA}/{name}.parquet", tmp_path / f"{name}.parquet")
    return tmp_path


def test_listing_reads_no_rows(spark, folder):
    uri = f"file://{folder}"
    files = input_files(spark, uri)
    assert {n: len(f) for n, f in files.items()} == dict.fromkeys(features.ALL_INPUTS, 1)
    with open(folder / "orders.parquet", "wb") as f:  # not a readable table any more; a listing does not mind
        f.write(b"nothing")
    changed = input_files(spark, uri)
    assert changed["orders"] != files["orders"] and changed["part"] == files["part"]


def test_only_tables_of_a_changed_input_are_built_again(spark, folder):
    uri = f"file://{folder}"
    before = Features(spark, uri)
    base, dx = before.base.inputFiles(), before.dx.inputFiles()
    os.utime(folder / "part.parquet", (1, 1))
    after = Features(spark, uri)
    assert after.base.inputFiles() == base and after.dx.inputFiles() != dx


@pytest.mark.parametrize("keys", [list(range(0, 40000, 7)), [5] * 300 + [6] * 20 + [10**15, -3], [0]])
def test_key_at_equals_sorting(spark, keys):
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in [*keys]] + [(None,)], "k long")
    for p in {0, len(keys) // 3, len(keys) // 2, len(keys) - 1}:
        assert key_at(df, "k", p, most=10) == sorted(keys)[p]
    with pytest.raises(KeyError):
        key_at(df, "k", len(keys))


def test_row_at_a_far_position(spark):
    df = spark.range(5000).select((F.col("id") * 3).alias("hadm_id"), (F.col("id") % 7).alias("x"))
    assert lookup_row(df, position=4321) == {"hadm_id": 4321 * 3, "x": 4321 % 7}


def test_medians_ignore_infinite_values(spark):
    r = random.Random(2)
    values = [r.gauss(0, 1) for _ in range(601)]
    df = spark.createDataFrame([(v,) for v in [*values, float("inf"), float("-inf"), float("nan"), None]], "a double")
    assert exact_medians(df, ["a"], most=50) == {"a": sorted(values)[300]}


def test_top_items_rank_by_patients(spark):
    events = [(1, p, 1.0) for p in range(3)] + [(2, 9, 1.0)] * 10 + [(3, p, None) for p in range(20)] + [(None, 1, 2.0), (4, None, 1.0)]
    d = spark.createDataFrame([(i, f"l{i}", "f", "c") for i in (1, 2, 3, 4)], "itemid long, label string, fluid string, category string")
    out = quality.top_items(spark.createDataFrame(events, "itemid long, subject_id long, valuenum double"), d, 2)
    got = {r.itemid: (r.event_count, r.patient_count, r.numeric_count) for r in out.collect()}
    assert got == {1: (3, 3, 3), 2: (10, 1, 10)}


def test_batch_of_profiles_equals_one_by_one(spark):
    r = random.Random(6)
    rows = [(i, i, r.randint(1, 9), r.choice("FM"), r.choice(["a", "b"]), float(r.randint(20, 90)), r.choice([None, 25.0, 31.5]), r.choice([None, 120.0]),
             r.choice([None, 80.0]), r.randint(0, 5), r.randint(0, 5), r.random(), sorted(r.sample("ABCDEF", r.randint(0, 4))), r.sample("xyz", r.randint(0, 2)))
            for i in range(90)]
    knn = spark.createDataFrame(rows, "hadm_id long, subject_id long, los_days int, gender string, race string, age double, bmi double, "
                                      "systolic_bp double, diastolic_bp double, diagnosis_count int, unique_icd_count int, "
                                      "diagnosis_diversity_ratio double, diagnoses_icd_list array<string>, diagnoses_3digit_list array<string>")
    made = [(1, 50.0, "F", "a", 22.0, None, None, ["A", "Q"], None, None, None), (2, None, None, "zz", None, 130.0, 70.0, None, None, 3, 2),
            (3, 71.0, "M", "b", 30.0, 120.0, 80.0, ["A", "B"], ["x"], 2, 2)]
    profiles = spark.createDataFrame(made, "profile_id long, age double, gender string, race string, bmi double, systolic_bp double, diastolic_bp double, "
                                           "diagnoses_icd_list array<string>, diagnoses_3digit_list array<string>, diagnosis_count long, unique_icd_count long")
    done = cosine.complete_profile(profiles, knn)
    got = {}
    for x in cosine.knn_for_profiles(knn, done, 5, block_rows=20, block_profiles=2).orderBy("profile_id", "rank").collect():
        got.setdefault(x.profile_id, []).append((x.hadm_id, round(x.distance, 9), round(x.similarity, 9)))
    for p in done.collect():
        one = cosine.knn_for_profile(knn, p.asDict(), 5).collect()
        assert got[p.profile_id] == [(x.hadm_id, round(x.distance, 9), round(x.similarity, 9)) for x in one]
    assert cosine.knn_for_profiles(knn, done.limit(0)).collect() == []


def test_distinct_integers_without_expand(spark):
    ids = [1, 1, None, 32768, 32769, -5, 10**14, 0, 0]
    df = spark.createDataFrame([(i, 0.5, "High", 7) for i in ids], "hadm_id long, treatment_complexity_score double, "
                                                                   "treatment_intensity_label string, subject_id int")
    assert quality.distinct_integers(df, "hadm_id", "n").first().n == 6
    assert quality.distinct_integers(df.limit(0), "hadm_id", "n").first().n == 0
    out = quality.treatment_qa(df)
    assert (out.first().n_rows, out.first().n_subjects, out.first().n_admissions, out.first().high_rows) == (9, 1, 6, 9)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_row_sample_and_id_columns(spark):
    df = spark.createDataFrame([(3, "b", 1), (1, "a", 2), (None, "c", 3), (1, "z", 1)], "stay_id long, note string, subjectID long")
    assert quality.id_columns(df) == ["stay_id", "subjectID"]
    assert [(r.stay_id, r.subjectID) for r in quality.row_sample(df, 3).collect()] == [(1, 1), (1, 2), (3, 1)]
    assert [r.note for r in quality.row_sample(df.select("note"), 2).collect()] == ["a", "b"]


def test_profile_blocks_are_matrix_products(spark):
    """No pair of a profile and an admission becomes a row; ties by id across chunks of items."""
    import pyarrow as pa

    from cohortlens.operators.cosine import _nearest_of_block

    def block(ids, key, codes):
        return pa.table({key: pa.array(ids, pa.int64()), "gender": pa.array([1 if i % 2 else None for i in ids], pa.int64()),
                         "race": pa.array([i % 3 for i in ids], pa.int64()), "z": pa.array([[float(i % 5), 1.0] for i in ids]),
                         "groups": pa.array([[i % 4] for i in ids], pa.list_(pa.int64())), "codes": pa.array(codes, pa.list_(pa.int64())),
                         "norm": pa.array([((i % 5) ** 2 + 4.0 + len(c)) ** 0.5 for i, c in zip(ids, codes)])})

    ids = [(i * 37) % 211 for i in range(211)]
    codes = {i: sorted({i % 7, i % 11 + 20, i % 13 + 40}) for i in ids}
    rows = block(ids, "hadm_id", [codes[i] for i in ids]).append_column("subject_id", pa.array(ids, pa.int64())).append_column("los_days", pa.array(ids, pa.int64()))
    mine = list(range(0, 211, 9))
    out = _nearest_of_block(6, chunk=4, most_words=3)(block(mine, "profile_id", [codes[i] for i in mine]), rows).to_pylist()
    for q in mine:
        def cos(c):
            dot = (q % 5) * (c % 5) + 1.0 + (q % 2 == 1 and c % 2 == 1) + (q % 3 == c % 3) + (q % 4 == c % 4) + len(set(codes[q]) & set(codes[c]))
            return dot / (((q % 5) ** 2 + 4.0 + len(codes[q])) * ((c % 5) ** 2 + 4.0 + len(codes[c]))) ** 0.5
        want = sorted((round(1 - cos(c), 9), c) for c in ids)[:6]
        assert [(round(r["near"], 9), r["hadm_id"]) for r in sorted((r for r in out if r["profile_id"] == q), key=lambda r: (r["near"], r["hadm_id"]))] == want
    assert _nearest_of_block(6)(block([], "profile_id", []), rows).num_rows == 0
