import random
import re

import pytest

from cohortlens.llm.jaccard_join import jaccard_components, jaccard_links, link_counts, one_of_each


def sets_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    s = {i: sets_of(t) for i, t in rows}
    parent = {i: i for i in s}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(s)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s[i]), root(i)) for i in ids}


def corpus(seed, n=150):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    line = " ".join(r.choice(vocab) for _ in range(25))
    bases = [[r.choice(vocab) for _ in range(r.randrange(5, 120))] for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.randrange(0, 4)):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.3:
            w = line.split() + w
        rows.append((i * 3 + 1, (" " if r.random() < 0.5 else "\n").join(w)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "one two three"),
                   (906, "a b c d e"), (907, "a b c d e")]


@pytest.mark.parametrize("options", [
    {}, {"pivots": 2, "wide": 3, "depth": 3, "sample": 1}, {"pivots": 1, "wide": 0, "depth": 4, "sample": 10}])
def test_components_against_brute_force(spark, options):
    rows = corpus(len(options))
    df = spark.createDataFrame([(i, t, "node", 5) for i, t in rows], "doc_id long, text string, node string, component long")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, **options).collect()}
    assert got == brute(rows)


def test_a_dense_group_and_repeats(spark):
    r = random.Random(8)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(60):
        w = list(base)
        w[r.randrange(90)] = f"x{i}"
        rows.append((i + 1, " ".join(w)))
    df = spark.createDataFrame(rows + rows[:5] + [(None, "z z z")], "doc_id long, text string")
    out = jaccard_components(df, pivots=2, wide=2).collect()
    assert len(out) == 66
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == want
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    kept = sorted((x.doc_id or 0) for x in one_of_each(df, pivots=2, wide=2).collect())
    assert kept == sorted({c for _, c in want.values()} | {0})


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(df).collect() == []


@pytest.mark.parametrize("options", [{}, {"pivots": 2, "wide": 2}, {"pivots": 1, "wide": 0, "depth": 6, "sample": 10}])
def test_all_links_of_a_dense_group(spark, options):
    r = random.Random(9)
    rows = corpus(4, 60)
    for i in range(40):
        w = [f"b{j}" for j in range(90)]
        for _ in range(r.randrange(1, 3)):
            w[r.randrange(90)] = f"x{i}"
        rows.append((2000 + i, " ".join(w)))
    rows += [(3000 + i, " ".join("abcdefghi"[:8 + i % 2])) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    s = {i: sets_of(t) for i, t in rows}
    near = {(a, b) for a in s for b in s if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])}
    points, links = jaccard_links(df, **options)
    node = {x.doc_id: x.node for x in points.collect()}
    got = sorted((x.a, x.b) for x in links.collect())
    assert got == sorted({(a, b) for a, b in near if node[a] == a and node[b] == b and s[a] != s[b]})
    want = {i: sum(i in pair for pair in near) for i in s}
    assert {x.doc_id: x.n_links for x in link_counts(df, **options).collect()} == want
