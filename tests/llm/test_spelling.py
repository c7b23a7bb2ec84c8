import random
import re
import zlib
from collections import Counter

import pytest

from cohortlens.llm.grams import BEGIN, END, GramDictionary
from cohortlens.llm.spelling import forms, near_pairs, spelling_variants


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced character, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, min_chars=5, min_count=3):
    lower = {c: c + 32 for c in range(65, 91)}
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def brute_forms(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def made_words(seed, n, letters="abcé", low=5, high=9):
    r = random.Random(seed)
    out = {}
    while len(out) < n:
        w = "".join(r.choice(letters) for _ in range(r.randrange(low, high)))
        out[w] = r.randrange(3, 400)
        if r.random() < 0.5:  # a neighbour
            i = r.randrange(len(w))
            out[w[:i] + r.choice(["", w[i] + "a", "b"]) + w[i + 1 :]] = r.randrange(3, 40)
    return {w: c for w, c in out.items() if len(w) >= 5}


@pytest.mark.parametrize("frequent, longest", [(0, 3), (5, 3), (60, 3), (5, 5), (10**9, 3)])
def test_unaffected_grams_survive_every_edit(frequent, longest):
    words = list(made_words(1, 150))
    counts = Counter(f[p : p + q] for w in words for f in [BEGIN + w + END] for q in range(2, longest + 1) for p in range(len(f) - q + 1))
    d = GramDictionary(counts, frequent, 2, longest)

    def grams(w):
        f = BEGIN + w + END
        return [(f[p:e], p) for p, e in d.decompose(f)], d.affected(f, d.decompose(f))

    r = random.Random(3)
    for w in words[:60]:
        mine, lost = grams(w)
        edits = [w[:i] + c + w[j:] for i in range(len(w) + 1) for c in ("", "a", "b", "é", "z") for j in (i, i + 1) if j <= len(w)]
        for t in r.sample(edits, min(25, len(edits))):
            if t != w and abs(len(t) - len(w)) <= 1 and t:
                theirs, _ = grams(t)
                grow = len(t) - len(w)
                kept = sum((g, p) in theirs or (g, p + grow) in theirs for g, p in mine)
                assert kept >= len(mine) - lost, (w, t)


@pytest.mark.parametrize("frequent, longest", [(200, 3), (3, 3), (2, 5)])  # the last leaves many words without a bound
def test_near_pairs_equal_brute_force(spark, frequent, longest):
    words = made_words(7, 400)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted(tuple(sorted((r.word, r.other))) for r in near_pairs(df, frequent, longest).collect())
    names = sorted(words)
    assert got == sorted((a, b) for i, a in enumerate(names) for b in names[i + 1 :] if one_edit(a, b))


def test_long_lists_are_dealt(spark, monkeypatch):
    from cohortlens.llm import spelling

    joined = spelling._joined
    monkeypatch.setattr(spelling, "_joined", lambda *a, **k: joined(*a, **k, list_rows=3))
    monkeypatch.setattr(spelling, "PAIRS", 7)
    test_near_pairs_equal_brute_force(spark, 3, 3)


def test_one_edit():
    import numpy as np

    from cohortlens.llm.spelling import one_edit as fast

    r = random.Random(2)
    words = ["", "a", "ab", "ba", "aab", "aba", "abé", "abéz", "éab"] + ["".join(r.choice("aé") for _ in range(r.randrange(6))) for _ in range(40)]
    pairs = [(a, b) for a in words for b in words]
    got = fast(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert got.tolist() == [one_edit(a, b) for a, b in pairs]


def test_forms_ties_and_chains(spark):
    words = {"abcde": 100, "abcdf": 100, "abcdx": 50, "abcdxy": 25, "abcdxyz": 12, "abcdxyzz": 13, "zzzzz": 3, "zzzzzz": 3}
    got = sorted(tuple(r) for r in forms(spark.createDataFrame(list(words.items()), "word string, n long")).collect())
    assert got == brute_forms(words)
    assert dict((r[0], r[2]) for r in got)["abcdxyz"] == "abcde"


def test_variants_equal_brute_force(spark):
    r = random.Random(11)
    base = ["straße", "Gérard", "letter", "little", "gruene", "grueñe", "naïveté", "aaaaa", "aaaaaa", "ab", "xyzzy" * 40]
    rows = [(i % 300, " ".join(r.choice(base) for _ in range(60)) + r.choice([".", "\n", "9", "ÀÉÎ×÷ÿ"])) for i in range(400)]
    rows += [(None, "letter lettre straße"), (5, None), (6, ""), (7, "…  12")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, word string, n int")
    got = sorted(tuple(x) for x in spelling_variants(df).collect())
    assert got == brute_forms(brute_words(rows))
    assert any(x[1] for x in got)


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
