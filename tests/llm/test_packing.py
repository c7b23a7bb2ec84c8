import random
from collections import defaultdict

from pyspark.sql import functions as F

from cohortlens.llm.packing import best_fit, pack


def plain(sizes, sources, clusters, capacity):
    """Tightest bin without a conflict, by looking at all bins."""
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] > 0 and b["left"] >= size
                and (s is None or s not in b["s"]) and (c is None or c not in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        b = bins[i]
        b["left"] -= size
        b["s"].add(s)
        b["c"].add(c)
        out.append(i)
    return out


def test_pack_is_best_fit():
    r = random.Random(5)
    for _ in range(20):
        n = 200
        sizes = sorted((r.randrange(0, 100) for _ in range(n)), reverse=True)
        sources = [r.choice([None, "a", "a", "a", "b", "c", "d", "e"]) for _ in range(n)]
        clusters = [r.choice([None, 1, 1, r.randrange(200)]) for _ in range(n)]
        assert pack(sizes, sources, clusters, 100) == plain(sizes, sources, clusters, 100)


def test_rows_stay_whole(spark):
    r = random.Random(6)
    rows = [(i, "abé "[: r.randrange(5)] * r.randrange(0, 60), r.choice(["s0", "s0", "s1", "s2", None]), 1, "z") for i in range(700)]
    rows += [(1000 + i, "copy of a text", "s%d" % i, 1, "z") for i in range(50)]
    rows += [(2000, "y" * 1005, "s0", 1, "z"), (2001, None, "s0", 1, "z"), (2002, "", None, 1, "z"), (None, "q", "s1", 1, "z"),
             (None, "q", "s1", 1, "z"), (5, "again", "s9", 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, piece int, shard string")
    out = best_fit(df, capacity=100, shard_rows=200).collect()
    by = defaultdict(list)
    for x in out:
        by[x.bin_id].append(x)
    total = sum(len((t or "").encode()) for _, t, *_ in rows)
    assert sum(x.length for x in out) == total
    assert len(out) == sum(max(1, -(-len((t or "").encode()) // 100)) for _, t, *_ in rows)
    assert [x.length for x in sorted((x for x in out if x.doc_id == 2000), key=lambda x: x.piece)] == [100] * 10 + [5]
    source = {i: s for i, _, s, *_ in rows if i not in (5, None)}
    for members in by.values():
        assert sum(x.length for x in members) == members[0].bin_used <= 100
        own = [source[x.doc_id] for x in members if source.get(x.doc_id)]
        assert len(own) == len(set(own))
        assert sum(1000 <= (x.doc_id or 0) < 1050 for x in members) <= 1
    assert best_fit(df.limit(0)).collect() == []
    again = best_fit(df, capacity=100, shard_rows=200, cluster=F.lit(1)).collect()
    assert len({x.bin_id for x in again}) == len(out)  # one cluster: a bin each


def test_one_id_is_dealt_like_any_other(spark):
    rows = [(7, "x" * (i % 90), None) for i in range(1200)] + [(2**53 + i, "y" * 40, None) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = best_fit(df, capacity=100, shard_rows=100, cluster=F.lit(None)).collect()
    per = defaultdict(int)
    for x in out:
        per[x.bin_id >> 32] += 1
    assert len(out) == 1204 and len(per) == 13 and max(per.values()) < 200
    one = {r.doc_id: r.bin_id for r in best_fit(df.where("doc_id > 7"), capacity=80, cluster=F.lit(None)).collect()}
    assert [one[2**53 + i] for i in range(4)] == [0, 0, 1, 1]  # in order of id
