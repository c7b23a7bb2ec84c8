import json

from cohortlens.operators.cosine import complete_profile
from cohortlens.sources.io import PROFILE_SCHEMA


def test_profile_completion_against_vocabulary(spark, tmp_path):
    knn = spark.createDataFrame(
        [(1, "F", "X", ["I10", "E11"], ["10_I10", "10_E11"]), (2, "M", "Y", ["J18"], ["10_J18"])],
        "hadm_id long, gender string, race string, diagnoses_icd_list array<string>, "
        "diagnoses_3digit_list array<string>")
    path = tmp_path / "profiles.json"
    rows = [{"profile_id": 7, "age": 60, "gender": "F", "race": "Z", "diagnoses_icd_list": ["I10", "Q99", "I10"]},
            {"profile_id": 8, "gender": None, "diagnoses_icd_list": ["J18"], "diagnoses_3digit_list": ["10_J18"]}]
    path.write_text("\n".join(json.dumps(r) for r in rows))
    profiles = spark.read.schema(PROFILE_SCHEMA).json(str(path))
    got = {r.profile_id: r for r in complete_profile(profiles, knn).collect()}
    a = got[7]
    assert a.known_codes == ["I10"]                    # unknown code dropped
    assert sorted(a.diagnoses_3digit_list) == ["UNK_I10", "UNK_Q99"] and a.known_groups == []
    assert a.diagnosis_count == 2 and a.primary_diagnosis_icd in ("I10", "Q99")
    assert (a.gender_known, a.race_known) == (1, 0)   # unseen race gives the zero vector
    b = got[8]
    assert b.known_groups == ["10_J18"] and b.gender == "unknown" and b.gender_known == 0
