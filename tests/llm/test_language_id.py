import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm.language_id import (ORDER, SYMBOLS, accepted, code_lengths, code_table, fit, held_out, language_id, _folded,
                                        _grams)

DATA = "/root/testdata/sf0.01"


def plain_ppm(train, text):
    """Code length by walking the contexts one symbol at a time."""
    counts = defaultdict(Counter)
    for i in range(ORDER, len(train)):
        for k in range(ORDER + 1):
            counts[tuple(train[i - k:i])][train[i]] += 1
    bits = 0.0
    for i in range(ORDER, len(text)):
        p, k = 1.0, ORDER
        while k >= 0:
            c = counts.get(tuple(text[i - k:i]))
            if c:
                whole = sum(c.values()) + len(c)
                if text[i] in c:
                    p *= c[text[i]] / whole
                    break
                p *= len(c) / whole
            k -= 1
        else:
            p /= SYMBOLS
        bits -= math.log2(p)
    return bits


def test_tables_are_exact_code_lengths():
    r = np.random.default_rng(0)
    train = np.concatenate((np.zeros(ORDER, np.int32), r.integers(0, 9, 3000).astype(np.int32) % 7))
    grams, n = np.unique(_grams(train), return_counts=True)
    table = code_table(grams, n)[:, None]
    alphabet = np.arange(256, dtype=np.int32) % SYMBOLS
    rows = [bytes(r.integers(0, 9, k).astype(np.uint8)) for k in (0, 1, 5, 200)]
    got = code_lengths(rows, alphabet, table)[:, 0]
    for row, bits in zip(rows, got):
        assert bits == pytest.approx(plain_ppm(train.tolist(), alphabet[_folded([row])].tolist()), rel=1e-5, abs=1e-4)


def test_long_texts_in_blocks(monkeypatch):
    from cohortlens.llm import language_id as m

    r = np.random.default_rng(1)
    alphabet = (np.arange(256) % SYMBOLS).astype(np.int32)
    table = r.random((SYMBOLS ** (ORDER + 1), 2)).astype(np.float32)
    rows = [bytes(r.integers(97, 110, n).astype(np.uint8)) for n in (10, 5000, 3)]
    want = m.code_lengths(rows, alphabet, table)
    monkeypatch.setattr(m, "BLOCK", 64)
    assert np.allclose(m.code_lengths(rows, alphabet, table), want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = fit(docs, ~held_out())
    out = language_id(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out())
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right / n >= 0.97


def test_defined_cases(spark):
    rows = [(1, "the cat and the dog", "en", "s", 1), (2, "der hund und die katze", "de", "s", 1), (3, None, "en", "s", 1),
            (4, "", None, "s", 1), (5, "123 !?", "de", "s", 1), (6, "the dog", None, "s", 1), (6, "the dog", None, "s", 1),
            (None, "und der hund", "de", "s", 1), (8, "x" * 100_000, None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
    model = fit(df, F.lit(True))
    out = language_id(df, model).collect()
    assert len(out) == 9 and all(0 <= r.score <= 1 for r in out)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r.lang_pred)
    assert by[3] == by[4] == by[5] == ["und"] and by[6] == ["en", "en"] and by[None] == ["de"] and by[1] == ["en"]
    kept = accepted(df).collect()
    assert {3, 4, 5}.isdisjoint(r.doc_id for r in kept) and kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "score"}
    nothing = fit(df.limit(0), F.lit(True))
    assert nothing["langs"] == [] and {r.lang_pred for r in language_id(df, nothing).collect()} == {"und"}
    assert language_id(df.limit(0), model).collect() == []


def test_every_byte_has_its_own_code_length(monkeypatch):
    from cohortlens.llm import language_id as m

    r = np.random.default_rng(2)
    spread = (r.geometric(0.04, 4000) * 37 % 256).astype(np.uint8)  # far more byte values than SYMBOLS
    train, rows = bytes(spread[:3000]), [bytes(spread[3000:]), b"", bytes(r.integers(0, 256, 300).astype(np.uint8))]
    grams, n = np.unique(_grams(_folded([train]), 256), return_counts=True)
    alphabet = m._alphabet(np.bincount(_folded([train]), minlength=256))
    assert (np.bincount(spread, minlength=256) > 0).sum() > 2 * SYMBOLS
    table, levels = m._table({"name": "t", "alphabet": alphabet, "trees": [(grams, n)]})
    got = code_lengths(rows, alphabet, table, levels)[:, 0]
    monkeypatch.setitem(plain_ppm.__globals__, "SYMBOLS", 256)
    for row, bits in zip(rows, got):
        assert bits == pytest.approx(plain_ppm(_folded([train]).tolist(), _folded([row]).tolist()), rel=1e-4, abs=1e-3)
    monkeypatch.setattr(m, "BLOCK", 64)
    assert np.allclose(code_lengths(rows, alphabet, table, levels)[:, 0], got)


def test_languages_that_differ_in_rare_bytes_only(spark):
    common = "".join(chr(c) for c in range(33, 127)) * 20
    rows = [(i, common + w, lang) for i, (w, lang) in enumerate([(" b\u00e9te", "fr"), (" b\u00eate", "gr")] * 5)]
    df = spark.createDataFrame(rows + [(20, "b\u00eate", None), (21, "b\u00e9te", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id(df, fit(df, F.lit(True))).collect()}
    assert (got[20].lang_pred, got[21].lang_pred) == ("gr", "fr") and got[20].score > 0.5 < got[21].score
