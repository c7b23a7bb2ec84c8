import os

import pytest

import corpus_pipeline as pipeline
from cohortlens.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "jaccard_join", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_stages_against_brute_force(spark):
    from test_jaccard_join import brute as groups
    from test_substring_dedup import brute as repeats

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = pipeline.stored(stage(spark, docs, DATA))
        after = {r.doc_id: r for r in docs.collect()}
        if name != "best_fit_packing":
            assert docs.columns == columns and docs.count() == len(after)
        if name == "language_id":
            assert set(after) == {i for i, r in before.items() if r.text and any(c.isalpha() for c in r.text)}
        if name == "jaccard_join":
            want = groups([(i, r.text) for i, r in before.items()])
            assert set(after) == {c for _, c in want.values()} and all(after[i] == before[i] for i in after)
        if name == "substring_dedup":
            want = repeats([(i, r.text) for i, r in before.items()], 50)
            for i, (n, gone, _) in want.items():
                if gone == 0:
                    assert after[i] == before[i]
                elif gone < n:
                    assert len(after[i].text.split()) == n - gone and after[i].n_chars == len(after[i].text)
                else:
                    assert i not in after
        if name == "benchmark_decontamination":
            flat = {i: " ".join(r.text.lower().split()) for i, r in before.items()}
            held = {i for i, t in flat.items() if any(" ".join(b.lower().split()) in t for b in bench)}
            assert held and held.isdisjoint(after) and len(after) >= len(before) - len(held) - 3
        if name == "best_fit_packing":
            assert docs.agg({"length": "sum"}).first()[0] == sum(len(r.text.encode()) for r in before.values())
            assert set(after) == set(before)


def test_whole_run_on_null_and_repeated_rows(spark, tmp_path):
    rows = [(1, "the words of a text in a language " * 9, "en", "s", 3), (1, "the words of a text in a language " * 9, "en", "s", 3),
            (2, None, None, None, None), (None, "words of the text", "en", None, 1), (3, "", "en", "s", 0), (4, "42", "de", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.doc_id or 0) for r in pipeline.run(spark, str(tmp_path)).collect()) == [0, 1]
    os.makedirs(f"{tmp_path}/e")
    df.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/e/benchmark.parquet")
    assert pipeline.run(spark, f"{tmp_path}/e").collect() == []


def test_stages_keep_columns_with_clashing_names(spark):
    names = ["_kept", "_of", "_own0", "_OWN1", "copy", "first", "gone", "h", "n", "k", "at", "size", "component_id", "lang_pred", "score", "bin_id"]
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"The opening number {i} of the text is its own. " * 3 + (passage if i < 3 else ""), "en", "s", 1, *["x"] * len(names)) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{n}` string" for n in names))
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.stored(stage(spark, docs, DATA))
        assert docs.columns[5:] == names, name
        assert all(list(r)[5:] == ["x"] * len(names) for r in docs.collect())
    assert {r.doc_id: passage in r.text for r in docs.collect()}.get(1, False) is False
    pipeline.STAGES[-1][1](spark, docs, DATA).collect()
