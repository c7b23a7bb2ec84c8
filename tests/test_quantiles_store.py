import random
import shutil
import statistics

from cohortlens.functions.quantiles import exact_medians
from cohortlens.operators.quality import table_profile
from cohortlens.plans import features
from cohortlens.plans.features import Features
from cohortlens.session import ensure_checkpoint_dir

DATA = "/root/testdata/sf0.001"


def test_exact_medians(spark):
    r = random.Random(3)
    for n in (1, 2, 501, 800):
        rows = [(r.gauss(0, 1), r.choice([1.0, 5.0, None]), r.lognormvariate(0, 4), None) for _ in range(n)]
        df = spark.createDataFrame(rows, "a double, b double, c double, d double")
        want = {k: (statistics.median(v) if (v := [x[i] for x in rows if x[i] is not None]) else None) for i, k in enumerate("abcd")}
        assert exact_medians(df, list("abcd")) == want
        assert exact_medians(df, list("abcd"), most=20, buckets=7) == want


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, None)], "a long, b string")
    got = {r.column_name: (r.row_count, r.null_count, r.distinct_count, r.data_type) for r in table_profile(df).collect()}
    assert got == {"a": (3, 0, 2, "bigint"), "b": (3, 2, 1, "string")}


def test_feature_store_follows_input_and_definition(spark, tmp_path, monkeypatch):
    for name in ("customer", "nation", "orders", "lineitem", "part"):
        shutil.copy(f"{DATA}/{name}.parquet", tmp_path / f"{name}.parquet")
    uri = f"file://{tmp_path}"
    first = Features(spark, uri).dx
    n = first.count()
    assert Features(spark, uri).dx.inputFiles()[0] == first.inputFiles()[0]  # reused
    half = spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_orderkey % 2 = 0")
    shutil.rmtree(tmp_path / "lineitem.parquet", ignore_errors=True)
    (tmp_path / "lineitem.parquet").unlink(missing_ok=True)
    half.coalesce(1).write.parquet(f"{uri}/lineitem.parquet")
    changed = Features(spark, uri).dx
    assert changed.count() < n and changed.inputFiles()[0] != first.inputFiles()[0]
    monkeypatch.setattr(features, "_definition", lambda: "another")
    assert Features(spark, uri).dx.inputFiles()[0] != changed.inputFiles()[0]


def test_checkpoint_folder_is_the_cluster_s(spark):
    assert ensure_checkpoint_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark))
