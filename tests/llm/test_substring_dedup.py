import hashlib
import random

import numpy as np
import pytest

from cohortlens.llm import substring_dedup as m
from cohortlens.llm.words import word_hashes


def brute(rows, size):
    first = {}
    words = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(words):
        w = words[i]
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k:k + size]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n, size):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(40)]
    passages = [[r.choice(vocab) for _ in range(r.randrange(size - 3, 4 * size))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(r.randrange(1, 4)):
            kind = r.random()
            if kind < 0.4:
                p = r.choice(passages)
                a = r.randrange(0, max(1, len(p) - size))
                w += p[a: a + r.randrange(size, 3 * size)]
            elif kind < 0.6:
                w += ["run"] * r.randrange(1, 3 * size)
            elif kind < 0.7:
                w += ["p", "q", "r"] * r.randrange(1, size)
            else:
                w += [r.choice(vocab) for _ in range(r.randrange(0, 2 * size))]
        rows.append((i + 1, " ".join(w)))
    rows += [(500, rows[3][1]), (501, rows[3][1] + "\n"), (502, "a b"), (503, "a b"), (504, None), (505, ""), (506, "\t \n")]
    return rows


@pytest.mark.parametrize("size", [4, 9, 50])
def test_against_brute_force(spark, size):
    rows = corpus(size, 80, size)
    df = spark.createDataFrame([(i, t, 3, "k") for i, t in rows], "doc_id long, text string, n_words int, keys string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in m.substring_dedup(df, size=size).collect()}
    assert got == brute(rows, size)


def test_equal_windows_have_equal_keys(monkeypatch):
    r = random.Random(2)
    docs = [" ".join(r.choice("ab" if r.random() < 0.7 else "cdefgh") for _ in range(300)).encode() for _ in range(6)]
    docs += [docs[0][40:400] + b" zz " + docs[1][100:300], b"a " * 200, b"a b " * 100]
    for segment in (1 << 18, 64):
        monkeypatch.setattr(m, "SEGMENT", segment)
        keys, count = {}, 0
        for words, row, offset in m._segments(docs, 12):
            start, key = m.window_keys(words, row * 2 + (offset // segment) % 2, 12)
            at = m._place(row, offset, start)
            for s, k, i, p in zip(start.tolist(), key.tolist(), row[start].tolist(), at.tolist()):
                window = tuple(words[s:s + 12].tolist())
                assert keys.setdefault(window, k) == k
                assert window == tuple(docs_hash(docs)[i][p:p + 12].tolist())
                count += 1
        assert count == sum(max(0, len(d.split()) - 11) for d in docs)


_HASHED = {}


def docs_hash(docs):
    key = id(docs)
    if key not in _HASHED:
        _HASHED[key] = list(word_hashes(docs))
    return _HASHED[key]


def test_symbols_know_what_decided_them():
    """A symbol whose deciding words are copied elsewhere occurs there too."""
    r = np.random.default_rng(5)
    words = r.integers(0, 5, 400).astype(np.uint64) + np.uint64(10)
    name, begin, low, high = m.recompress(words, np.zeros(400, np.int64))
    for a, b in ((50, 120), (200, 330)):
        other = np.concatenate((np.array([77, 78], np.uint64), words[a:b], np.array([79], np.uint64)))
        n2, b2, _, _ = m.recompress(other, np.zeros(len(other), np.int64))
        there = set(zip(n2.tolist(), (b2 - 2).tolist()))
        inside = [(x, y - a) for x, y, l, h in zip(name.tolist(), begin.tolist(), low, high) if l >= a and h <= b]
        assert inside and set(inside) <= there


def test_repeats_nulls_empty_and_layout(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = [(2, long), (2, long), (None, long), (3, "start\n" + long.replace(" ", "  ") + "\nend of it"), (4, long)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = sorted((r.doc_id or 0, r.n_removed) for r in m.substring_dedup(df, size=10).collect())
    assert got == [(0, 0), (2, 0), (2, 0), (3, 20), (4, 20)]
    left = {r.doc_id: (r.text, r.n_chars) for r in m.without_repeats(df, size=10).collect()}
    assert left[3] == ("start\nend of it", 15) and left[2] == (long, len(long)) and 4 not in left and left[None][0] == long
    assert m.substring_dedup(df.limit(0)).collect() == []
