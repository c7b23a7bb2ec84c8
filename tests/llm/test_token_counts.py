import random

import pytest

P = pytest.importorskip("public_tokenizers")

from cohortlens.llm.token_counts import Tokenizer, token_counts, tokenizer  # noqa: E402


def odd_texts():
    r = random.Random(3)
    fixed = ["", " ", "a" * 900, " " * 300, "x\n\n\n y" * 50, "é è " * 90 + "<s> </s> <unk>" * 20, " lead  two   three " * 30,
             "▁▁ ▁a ▁" * 30, "漢字" * 200, "a b" * 150 + " " * 90]
    return fixed + ["".join(r.choice(" ab\n▁é<s>漢") for _ in range(r.randrange(400))) for _ in range(400)]


@pytest.mark.parametrize("chunk, overlap", [(7, 2), (30, 4), (100, 16)])
def test_spliced_counts_are_the_library_s(chunk, overlap):
    tok = tokenizer(P.path("piece_bpe_32k.model"))
    rows = odd_texts()
    assert tok.counts(rows, chunk, overlap) == tok.encode(rows)


def test_json_vocabulary():
    tok = Tokenizer(P.path("byte_bpe_50k.json"))
    assert tok.counts(["hello world", ""], 4, 2) == tok.encode(["hello world", ""])


def test_rows(spark):
    rows = [(1, "hello world", 9), (1, "hello world", 9), (2, None, 9), (3, "", 9), (None, "x " * 6000, 9), (4, "é", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_counts(df, P.path("piece_bpe_32k.model"), chunk_chars=500, overlap_chars=16).collect()
    tok = tokenizer(P.path("piece_bpe_32k.model"))
    want = sorted((i or 0, len((t or "").encode()), n := tok.encode([t or ""])[0], n > 4096) for i, t, _ in rows)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in out) == want
    assert token_counts(df.limit(0), P.path("piece_bpe_32k.model")).collect() == []
