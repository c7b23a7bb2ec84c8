import random

import numpy as np

from cohortlens.llm.graph import components
from cohortlens.llm.words import BLOCK, shingles, window_hashes, word_hashes


def test_word_hashes_depend_on_the_word_only():
    rows = [b"a bc  a\tBC\n\x0bbc", None, b"", b" \r\n ", "\u00e9t\u00e9 \u00c9t\u00e9 a\u00a0b".encode(), b"x" * 50]
    got = list(word_hashes(rows))
    assert [len(x) for x in got] == [5, 0, 0, 0, 3, 1]  # a no-break space is part of a word
    assert got[0][0] == got[0][2] and got[0][1] == got[0][4] != got[0][3]
    low = list(word_hashes(rows, fold=True))
    assert low[0][3] == low[0][1] and low[4][0] != low[4][1]  # only A-Z is folded


def test_long_texts_are_the_same_in_blocks():
    r = random.Random(1)
    words = ["w%d" % r.randrange(500) for _ in range(BLOCK // 3)]
    text = " ".join(words).encode() + b" " + b"z" * (BLOCK + 10) + b" end"
    whole = next(word_hashes([text]))
    single = {w: next(word_hashes([w.encode()]))[0] for w in set(words)}
    assert len(whole) == len(words) + 2
    assert all(whole[i] == single[words[i]] for i in range(0, len(words), 97))


def test_shingles_and_windows():
    w = next(word_hashes([b"a b c d e a b c d e f"]))
    assert len(shingles(w)) == 6  # "a b c d e" twice
    assert len(shingles(w[:3])) == 1 and len(shingles(w[:0])) == 0
    assert shingles(w[:3])[0] != shingles(w[:2])[0]
    h = window_hashes(w, 5, 3)
    assert h[0] == h[5] and len(set(h.tolist())) == 6 and len(window_hashes(w, 12, 3)) == 0


def test_components_both_ways(spark):
    r = random.Random(4)
    edges = [(r.randrange(-40, 300), r.randrange(-40, 300)) for _ in range(260)] + [(5, 5), (7, None), (None, None)]
    edges += [(1000, 1001 + i) for i in range(50)] + [(2000 + i, 2001 + i) for i in range(30)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    want = {(x, root(x)) for x in list(parent)}
    df = spark.createDataFrame(edges, "a long, b long")
    for one_task in (0, 10_000):
        assert {tuple(x) for x in components(df, one_task=one_task).collect()} == want
        assert components(df.limit(0), one_task=one_task).collect() == []
    assert np.int64(0) == 0
