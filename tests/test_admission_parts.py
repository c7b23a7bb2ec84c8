from cohortlens.operators.treatments import _drug_features
from cohortlens.plans import features
from cohortlens.sources.tpch import raw_tables

SF = "/root/testdata/sf0.001"


def test_parts_of_admissions_grow_with_the_items(spark, monkeypatch):
    files = ["/a/lineitem.parquet/x:1:0.5:50000000:1.5", "/a/lineitem.parquet/y:50000000:1.5"]
    assert features.admission_parts(files) == 12 and features.admission_parts(files * 60) == 716
    asked, build = [], features.raw_tables
    monkeypatch.setattr(features, "PART_BYTES", 512)
    monkeypatch.setattr(features, "raw_tables", lambda s, d, parts=None: asked.append(parts) or build(s, d, parts))
    many = features.Features(spark, SF, materialize=False).tr
    assert asked[0] is None and asked[-1] > 37
    monkeypatch.undo()
    plain = features.Features(spark, SF, materialize=False).tr
    assert many.count() == plain.count() > 0 and many.exceptAll(plain).isEmpty()


def test_items_meet_and_are_grouped_in_these_parts(spark):
    plan = _drug_features(raw_tables(spark, SF, 37).prescriptions, False)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert dealt and all(", 37)" in x for x in dealt if "orderkey" in x or "hadm_id" in x)
