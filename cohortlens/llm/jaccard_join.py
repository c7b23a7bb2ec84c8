"""Exact Jaccard join of word-shingle sets in their metric space.

A document is its set of distinct ``k``-word shingles; ``1 - Jaccard`` is a
metric, and two documents link at similarity ``percent / 100`` or more, that
is at distance ``r = 1 - percent / 100`` or less.

1. *Points.*  Documents with equal sets (fingerprints of 128 bits) are one
   point, kept by their smallest id.
2. *Pivots and regions.*  Nearly all documents are at distance 1 from any given
   document, so sampled documents alone would leave everything in one region.
   The outer pivots are therefore the one-shingle sets, in one global order:
   frequent shingles (of a bounded sample) last, otherwise by hash.  A point's
   nearest pivot, ties by order, is its first shingle: that is its Voronoi
   region.
3. *Windows.*  A point of ``n`` shingles that lacks its first ``t`` shingles in
   another point is further than ``r`` from it once ``t`` is above ``n`` minus
   the least overlap ``ceil(percent * n / 100)``.  So a point is replicated to
   the regions of its first ``n - ceil(percent * n / 100) + 1`` shingles, and
   two linked points meet in the region of their first common shingle.
   In the region of that shingle, at place ``i`` of the one and ``j`` of the
   other, they have at most the smaller of ``n - i`` and ``m - j`` in common;
   pairs for which this is too little are not paired there.
4. *Inside a region* the first ``PIVOTS`` points are document pivots, compared
   with every other point of the region; a region of no more points is thereby
   joined completely.  Sizes, places, and the L1 distance of class-count
   sketches (a lower bound of the symmetric difference), rule pairs out; the
   rest is compared exactly, each pair once.
5. *Recursion* for larger regions.  Points that by their place can link with
   no size that the region holds leave it, and points that pivots have connected
   need no comparison.  If at most ``WIDE`` points of a region are outside of its
   largest component, these are its next pivots, and by the triangle inequality
   each is compared only with points whose distance from the region's first
   pivot differs from its own by at most ``r``: then the region is joined
   completely.  Otherwise it is split into the regions of the next common
   shingle (the window of the first ``l`` common shingles is one longer for
   every level), and each joins as above.

Every step is exact: no region, partner or candidate is dropped.  Comparisons
grow with the replicated rows, not with the square of a region.

Null and empty texts, and texts without a word, have an empty set: they link
with nothing and are their own component.  Fewer than ``k`` words are one
shingle.  Repeated rows come back repeatedly and are equal points.  Rows with a
null id are kept with a null component.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship, small_enough, stored, texts
from .graph import ONE_TASK_EDGES, components
from .words import U, mix, set_key, shingles, word_hashes

PIVOTS = 4
WIDE = 256
DEPTH = 3
SAMPLE_DOCS = 32_768
FREQUENT = 262_144
#: Rows of a side that may be broadcast (two numbers each), checked before.
BROADCAST_ROWS = 500_000


def _least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _ordered(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The set in the global order: by hash, frequent shingles last."""
    if not len(frequent) or not len(s):
        return s
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    late = frequent[at] == s
    return np.concatenate((s[~late], s[late]))


def _sketch(s: np.ndarray) -> bytes:
    """Counts by hash class, about one class for eight shingles."""
    size = 32
    while size * 8 < len(s):
        size *= 2
    classes = (mix(s) >> U(20)).astype(np.int64) % size
    return np.minimum(np.bincount(classes, minlength=size), 65535).astype("<u2").tobytes()


def _sketch_apart(a: bytes, b: bytes) -> int:
    """At most the size of the symmetric difference."""
    x, y = np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<u2").astype(np.int64)
    if len(x) > len(y):
        x = x.reshape(-1, len(y)).sum(0)
    elif len(y) > len(x):
        y = y.reshape(-1, len(x)).sum(0)
    return int(np.abs(x - y).sum())


def frequent_shingles(docs: DataFrame, key: str, k: int, sample: int = SAMPLE_DOCS, most: int = FREQUENT) -> np.ndarray:
    """Shingles of three or more of about ``sample`` hash-drawn documents, the
    ``most`` frequent ones at most.  They only choose the order of pivots; any
    order gives the same links."""
    share = min(1.0, sample / max(docs.count(), 1))
    drawn = docs.where(F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def hashes(part: dict) -> dict:
        sets = [shingles(w, k) for w in word_hashes(part["text"], fold=True)]
        return {"s": np.concatenate(sets).view(np.int64) if sets else []}

    found = (map_batches(drawn, hashes, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
             .orderBy(F.desc("n"), "s").limit(most).toPandas())
    return np.sort(found["s"].to_numpy(np.int64).view(U))


def _points(docs: DataFrame, key: str, k: int, percent: int, frequent) -> DataFrame:
    def points(part: dict) -> dict:
        hot = frequent.value
        out: dict = {key: part[key], "n": [], "f1": [], "f2": [], "sketch": [], "window": []}
        for w in word_hashes(part["text"], fold=True):
            s = shingles(w, k)
            f1, f2 = set_key(s)
            n = len(s)
            out["n"].append(n)
            out["f1"].append(f1)
            out["f2"].append(f2)
            out["sketch"].append(_sketch(s))
            out["window"].append(_ordered(s, hot)[: n - _least_overlap(n, percent) + 1 if n else 0].view(np.int64))
        return out

    return map_batches(docs, points, f"`{key}` long, n long, f1 long, f2 long, sketch binary, window array<long>")


_REGION = "region long, last long, level int, a long, b long, na long, nb long, at long, many boolean"


def _possible(na, ia, nb, ib, level, percent: int):
    """Whether sets of ``na`` and ``nb`` items can link whose ``level``-th common
    item stands at places ``ia`` and ``ib`` (numbers, arrays or columns)."""
    least = F.least if hasattr(na, "cast") else np.minimum
    both = least(na - ia, nb - ib) + level - 1
    return 100 * both >= percent * (na + nb - both)


def _region_pairs(rows: DataFrame, percent: int, pivots: int) -> DataFrame:
    """Pairs of each region's first ``pivots`` points with its other points,
    and (``many``, b = a) the points of regions that have more points.

    ``rows`` (region, last, level, node, n, at) are dealt by region and sorted, so
    a region is a run of rows.  Only its first points are held in memory,
    whatever its size."""
    ship(rows.sparkSession)
    names = ["region", "last", "level", "node", "n", "at"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64) for _ in names]
        held_many = False
        for batch in batches:
            old = len(held[0])
            cols = [np.concatenate((h, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)))
                    for i, h in enumerate(held)]
            region, last, level, node, n, place = cols
            rows_n = len(region)
            if not rows_n:
                continue
            first = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1])))
            size = np.diff(np.append(first, rows_n))
            start = np.repeat(first, size)
            rank = np.arange(rows_n) - start
            fresh = np.arange(rows_n) >= old
            out: list[tuple] = []
            for p in range(min(pivots, int(size.max()) - 1)):
                i = np.flatnonzero((rank > p) & fresh)
                j = start[i] + p
                i, j = i[node[i] != node[j]], j[node[i] != node[j]]
                near = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                near &= _possible(n[i], place[i], n[j], place[j], level[i], percent)
                i, j = i[near], j[near]
                out.append((region[i], last[i], level[i], node[j], node[i], n[j], n[i], place[i], np.zeros(len(i), bool)))
            large = np.repeat(size, size) > pivots
            if held_many and old:
                large[:old] = False
            i = np.flatnonzero(large)
            out.append((region[i], last[i], level[i], node[i], node[i], n[i], n[i], place[i], np.ones(len(i), bool)))
            cols_out = [np.concatenate(x) for x in zip(*out)]
            if len(cols_out[0]):
                cols_out[2] = cols_out[2].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols_out],
                                                 names=["region", "last", "level", "a", "b", "na", "nb", "at", "many"])
            held_many = int(size[-1]) > pivots
            held = [x[first[-1] :][:pivots] for x in cols]

    dealt = rows.select(*names).repartition("region").sortWithinPartitions("region", "node")
    return dealt.mapInArrow(stream, _REGION)


def _sketch_filter(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches leave the similarity possible."""
    a = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))

    def near(part: dict) -> dict:
        # J >= p  <=>  difference <= (1 - p) * union, union = (na + nb + difference) / 2
        keep = [i for i, (x, y, na, nb) in enumerate(zip(part["sa"], part["sb"], part["na"], part["nb"]))
                if (100 + percent) * _sketch_apart(x, y) <= (100 - percent) * (na + nb)]
        return {c: [part[c][i] for i in keep] for c in ("a", "b", "na", "nb")}

    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb"), near,
                       "a long, b long, na long, nb long")


def _sets(docs: DataFrame, key: str, k: int, wanted: DataFrame) -> DataFrame:
    """(node, set) of the wanted points, from their texts."""
    ids = F.broadcast(wanted) if small_enough(wanted, BROADCAST_ROWS) else wanted
    own = docs.join(ids, docs[key] == ids["node"], "left_semi").dropDuplicates([key])

    def sets(part: dict) -> dict:
        return {"node": part[key], "items": [shingles(w, k).tobytes() for w in word_hashes(part["text"], fold=True)]}

    return map_batches(own, sets, "node long, items binary")


def _compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, key: str, k: int, percent: int) -> DataFrame:
    """(a, b, na, nb, both): exact overlap of every pair that can link."""
    near = stored(_sketch_filter(pairs, nodes, percent))
    wanted = stored(near.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    sets = stored(_sets(docs, key, k, wanted))
    a = sets.select(F.col("node").alias("a"), F.col("items").alias("xa"))
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("xb"))

    def overlap(part: dict) -> dict:
        both = [len(np.intersect1d(np.frombuffer(x, U), np.frombuffer(y, U), assume_unique=True))
                for x, y in zip(part["xa"], part["xb"])]
        return {"a": part["a"], "b": part["b"], "na": part["na"], "nb": part["nb"], "both": both}

    return stored(map_batches(near.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "xa", "xb"), overlap,
                              "a long, b long, na long, nb long, both long"))


def _distinct(pairs: DataFrame) -> DataFrame:
    return (pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .agg(F.min(F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb"))).alias("na"),
                 F.min(F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na"))).alias("nb")))


def jaccard_links(docs: DataFrame, key: str = "doc_id", k: int = 5, percent: int = 80, pivots: int = PIVOTS,
                  wide: int = WIDE, depth: int = DEPTH, sample: int = SAMPLE_DOCS, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """(points, links).  Points: (key, n, node) of every document, ``node`` the
    smallest id with an equal set.  Links: (a, b, na, nb, both) of all pairs of
    nodes, a < b, at the similarity or above.  Without ``exact`` only of enough
    pairs: with the points they connect exactly what all links connect."""
    spark = docs.sparkSession
    if exact:  # unequal sets at the similarity share so many shingles, which bounds the levels that all such pairs reach
        depth = min(depth, -(-percent // max(100 - percent, 1)))
    docs = texts(docs, key)
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, key, k, sample))
    every = stored(_points(docs, key, k, percent, frequent))
    firsts = stored(every.where("n > 0").groupBy("f1", "f2").agg(F.min(key).alias("node")))
    points = every.drop("sketch", "window").join(firsts, ["f1", "f2"], "left").select(
        key, "n", F.when(F.col("n") > 0, F.coalesce("node", key)).otherwise(F.col(key)).alias("node"))
    own = firsts.select(F.col("node").alias(key))
    nodes = stored(every.where("n > 0").join(own, key, "left_semi").dropDuplicates([key]).withColumnRenamed(key, "node"))
    rows = nodes.select(F.posexplode("window").alias("at", "region"), "node", "n").select(
        "region", F.col("region").alias("last"), F.lit(1).alias("level"), "node", "n", "at")
    sketches = nodes.select("node", "sketch")
    links = None
    while True:
        found = stored(_region_pairs(rows, percent, pivots))
        tests = _compared(_distinct(found.where("not many")), docs, sketches, key, k, percent)
        fresh = tests.where((100 * F.col("both")) >= percent * (F.col("na") + F.col("nb") - F.col("both")))
        links = stored(fresh if links is None else links.unionByName(fresh))
        many = found.where("many").select("region", "last", "level", F.col("a").alias("node"), F.col("na").alias("n"), "at")
        rows = None
        if not many.isEmpty():
            links, rows = _split(many, tests, links, docs, sketches, frequent, key, k, percent, wide, depth, exact)
        if rows is None:
            return points, links.dropDuplicates(["a", "b"]) if exact else links


def _split(many: DataFrame, tests: DataFrame, links: DataFrame, docs: DataFrame, sketches: DataFrame, frequent,
           key: str, k: int, percent: int, wide: int, depth: int, exact: bool) -> tuple[DataFrame, DataFrame | None]:
    """One recursion: finishes regions with few points outside of their largest
    component, and gives the rows of the next regions of the others.  ``exact``
    takes every point as a component of its own, so all pairs are compared."""
    comp = stored(components(links.limit(0) if exact else links, one_task=ONE_TASK_EDGES))
    least = many.groupBy("region").agg(F.min("n").alias("least"), F.min("node").alias("pivot"))
    best = F.greatest(F.col("n") - F.col("at") + F.col("level") - 1, F.col("least"))  # the size that suits the point best
    member = stored(many.join(least, "region").where(_possible(F.col("n"), F.col("at"), best, F.lit(0), F.col("level"), percent))
                    .join(comp, "node", "left")
                    .select("region", "last", "level", "node", "n", "at", "pivot", F.coalesce("component", "node").alias("component")))
    by_comp = member.groupBy("region", "component").agg(F.count(F.lit(1)).alias("size"))
    region = stored(by_comp.groupBy("region").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size"), F.max(F.struct("size", "component")).alias("top"))
        .where("parts > 1")
        .select("region", F.col("top.component").alias("top"), (F.col("size") - F.col("top.size")).alias("outside")))
    open_rows = member.join(region, "region")
    done = (F.col("outside") <= wide) | (F.col("level") >= depth)
    # Triangle inequality at the region's first pivot, where both distances are known.
    gap = tests.select(F.col("a").alias("pivot"), F.col("b").alias("node"),
                       (1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("d"))
    known = stored(open_rows.where(done).join(gap, ["pivot", "node"], "left"))
    z = known.where("component <> top").select("region", F.col("node").alias("a"), F.col("n").alias("na"), F.col("at").alias("ia"),
                                               F.col("component").alias("ca"), F.col("d").alias("da"), "level")
    y = known.select("region", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("at").alias("ib"),
                     F.col("component").alias("cb"), F.col("d").alias("db"))
    r = 1 - percent / 100 + 1e-9
    pairs = z.join(y, "region").where(
        (F.col("ca") != F.col("cb"))
        & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        & _possible(F.col("na"), F.col("ia"), F.col("nb"), F.col("ib"), F.col("level"), percent)
        & (F.col("da").isNull() | F.col("db").isNull() | (F.abs(F.col("da") - F.col("db")) <= r)))
    compared = _compared(_distinct(pairs.select("a", "b", "na", "nb")), docs, sketches, key, k, percent)
    fresh = compared.where((100 * F.col("both")) >= percent * (F.col("na") + F.col("nb") - F.col("both")))
    links = stored(links.unionByName(fresh))
    rest = stored(open_rows.where(~done).select("region", "last", "level", "node"))
    if rest.isEmpty():
        return links, None
    # The regions of a point are at most its window, so this is no unbounded list.
    wanted = stored(rest.groupBy("node").agg(F.collect_list(F.struct("region", "last", "level")).alias("regions")))
    own = docs.dropDuplicates([key]).join(wanted, docs[key] == wanted["node"]).select("node", "text", "regions")

    def deeper(part: dict) -> dict:
        out: dict = {c: [] for c in ("region", "last", "level", "node", "n", "at")}
        for node, regions, w in zip(part["node"], part["regions"], word_hashes(part["text"], fold=True)):
            s = _ordered(shingles(w, k), frequent.value)
            n = len(s)
            place = {int(x): i for i, x in enumerate(s.view(np.int64).tolist())}
            for one in regions:
                to = n - _least_overlap(n, percent) + 1 + one["level"]
                for i in range(place[one["last"]] + 1, min(to, n)):
                    x = s[i]
                    name = mix(np.array([one["region"]], np.int64).view(U) * U(3) + x)
                    out["region"].append(int(name.view(np.int64)[0]))
                    out["last"].append(int(x.astype(np.int64)))
                    out["level"].append(one["level"] + 1)
                    out["node"].append(node)
                    out["n"].append(n)
                    out["at"].append(i)
        return out

    return links, stored(map_batches(own, deeper, "region long, last long, level int, node long, n long, at long"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``."""
    points, links = jaccard_links(docs, key, exact=False, **options)
    comp = stored(components(links, one_task=ONE_TASK_EDGES)).withColumnRenamed("node", "of")
    points = stored(points)
    return points.join(comp, points["node"] == comp["of"], "left").select(
        key, F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))


def link_counts(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, n_links) of every row: other rows with a word whose set is equal or
    at the similarity or above."""
    points, links = jaccard_links(docs, key, **options)
    points = stored(points)
    own = stored(points.where("n > 0 and node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("rows")))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = both.join(own.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("rows").alias("far"))
    total = own.join(far, "node", "left").select("node", (F.col("rows") - 1 + F.coalesce("far", F.lit(0))).alias("links"))
    return points.join(total, "node", "left").select(key, F.coalesce("links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of every component, that of the smallest id; rows
    with a null id stay."""
    comp = jaccard_components(docs, key, **options)
    firsts = stored(comp.where(F.col(key) == F.col("component_id")).select(key).distinct())
    kept = docs.join(firsts, key, "left_semi").dropDuplicates([key])
    return kept.unionByName(docs.where(F.col(key).isNull())).select(*docs.columns)
