import hashlib
import random
from collections import Counter, defaultdict

import pytest

P = pytest.importorskip("public_tokenizers")

from cohortlens.llm.alignment import alignment, align_block, identity_map, vocabulary  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(rows):
    """Every token pair of every text compared by byte ranges, in plain Python."""
    import sentencepiece
    from tokenizers import Tokenizer

    hub = Tokenizer.from_file(A)
    hub.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    tokens_a, tokens_b = vocabulary(A).tokens, vocabulary(B).tokens

    def ranges(ids, tokens):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(tokens[i]), i))
            at += len(tokens[i])
        return out

    found, counts = [], Counter()
    for key, text in rows:
        if not text:
            found.append((key, None))
            continue
        a = hub.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        whole = (" " + text).encode()
        if b"".join(tokens_a[i] for i in a) != whole or b"".join(tokens_b[i] for i in b) != whole:
            found.append((key, None))
            continue
        ra, rb = ranges(a, tokens_a), ranges(b, tokens_b)
        links = [(x[2], y[2]) for x in ra for y in rb if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        ends = sorted({x[1] for x in ra} & {y[1] for y in rb})
        groups, begin = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, t, i in r if begin <= s and t <= e) for r in (ra, rb)))
            begin = e
        found.append((key, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = defaultdict(int)
    for (x, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for key, f in found:
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, digest = f
            out.append((key, n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=repr), counts, most


def sample():
    r = random.Random(5)
    fixed = ["", None, " ", "a", "  two  spaces ", "tab\tand\nline\r\n", "▁ is no space", "<|endoftext|> <s></s><unk>", "漢字 かな 🙂🙃", "é" * 30,
             "x" * 700, "aa aaa aaaa aaaaa", "The quick brown fox's tail isn't 12345 long", "ǅ ɐ ʘ Ω не", "\x00\x01 \x7f", " lead", "trail "]
    words = ["the", "tion", "Über", "naïve", "don't", "x1", "…", "--", "größe", "the", "the"]
    return fixed + [" ".join(r.choice(words) for _ in range(r.randrange(40))) for _ in range(60)]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_equals_brute_force(spark):
    rows = [(i % 70 if i else None, t) for i, t in enumerate(sample())]  # repeated and null ids
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, n_a int, block string").repartition(5)
    out = alignment(df, A, B)
    want, counts, most = brute(rows)
    assert result(out.documents) == want
    pairs = {(r.a, r.b): (r.n, r.best) for r in out.pairs.collect()}
    assert pairs == {k: (n, n == most[k[1]]) for k, n in counts.items()}


def test_long_texts_are_cut_at_proven_places():
    r = random.Random(2)
    texts = ["".join(r.choice("ab 1é\n.▁ ") for _ in range(900)).encode() for _ in range(30)] + [b"w" * 800, b"", None]
    whole, cut = align_block(texts, A, B), align_block(texts, A, B, segment=20)
    assert whole.docs["groups_sha256"] == cut.docs["groups_sha256"]
    assert any(len(vocabulary(A).segments(t.decode(), 20, vocabulary(B))) > 3 for t in texts if t)


def test_identity_map():
    same = identity_map(A, B)
    for i in (0, 50, 262, 1000):
        assert same[i] == -1 or vocabulary(A).tokens[i] == vocabulary(B).tokens[same[i]]
    assert (same >= 0).sum() > 5000


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = alignment(df, A, B)
    assert out.documents.collect() == [] and out.pairs.collect() == []


def test_parts_share_a_dictionary_and_little_memory():
    """Megabytes of text take a small multiple of a part, and come out as in one part."""
    import tracemalloc

    from cohortlens.llm import alignment as module

    texts = [f"naïve tokens {i} of plain texts, Größe {i * 7919} and 漢字 {i % 13}. ".encode() * 40 if i % 9 else (b"" if i % 2 else None)
             for i in range(1200)]
    align_block(texts[:3], A, B)  # the vocabularies stay
    tracemalloc.start()
    cut = align_block(texts, A, B)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * sum(len(x or b"") for x in texts)
    before = module.PART_BYTES, module.ENCODE_BYTES
    try:
        module.PART_BYTES = module.ENCODE_BYTES = 1 << 30
        whole = align_block(texts, A, B)
    finally:
        module.PART_BYTES, module.ENCODE_BYTES = before
    assert cut.names == whole.names and cut.counts.tolist() == whole.counts.tolist() and cut.regular.tolist() == whole.regular.tolist()
    for c, v in whole.docs.items():
        assert list(cut.docs[c]) == list(v), c
