"""Overlap statistics of all pairs of a cohort without a list of pairs.

How many pairs of sets share exactly ``k`` items, by the sizes of both sets and
by the agreement of their outcomes, follows from counts of subsets: summed over
all subsets T of ``j`` items, the number of pairs that both hold T is the sum of
C(k, j) over the pairs, where k is a pair's overlap.  Taking the binomial sums
back gives the number of pairs of each k.

So the work is one row for each subset of each distinct (set, outcome), added
up with map-side combine: linear in the cohort, whatever share of it one code
has.  Sets of more than ``most_items`` items would have too many subsets; their
pairs (with sets of any size) are found through shared items instead, once, at
the smallest shared item, each distinct (set, outcome) with its count.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialize

#: Items of a set up to which its subsets are counted (4095 of 12 items).
MOST_ITEMS = 12
#: Tasks that share an item's list of long sets' partners.
SALTS = 16
_BIG = "decimal(38,0)"


def agreement(a: Column, b: Column, rate: float | None) -> Column:
    """1 where outcomes are equal, else 0; with a ``rate`` exp(-rate |a - b|)."""
    return F.exp(-rate * F.abs(a - b)) if rate is not None else (a == b).cast("double")


def signatures(df: DataFrame, set_col: str, outcome: str, group: Column) -> DataFrame:
    """(g, s, y, n): distinct sorted sets and outcomes of each group, counted."""
    items = F.array_sort(F.array_distinct(F.filter(F.coalesce(F.col(set_col), F.array().cast("array<string>")), lambda x: x.isNotNull())))
    return df.select(group.alias("g"), items.alias("s"), F.col(outcome).cast("double").alias("y")).groupBy("g", "s", "y").agg(
        F.count(F.lit(1)).alias("n"))


def shared_pairs(sigs: DataFrame, rate: float | None = None, most_items: int = MOST_ITEMS, salts: int = SALTS) -> DataFrame:
    """(a, b, k, pairs, agree): of all pairs of different rows of one group that
    share k >= 1 items, by the sizes a and b of their sets in either order: their
    number and the sum of their agreements.  Every pair counts in both orders."""
    short = F.size("s") <= most_items
    parts = [_from_subsets(sigs.where(short), rate, most_items)]
    long = sigs.where(~short)
    if not long.isEmpty():
        parts.append(_from_items(long, sigs, rate, most_items, salts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("a", "b", "k").agg(F.sum("pairs").alias("pairs"), F.sum("agree").alias("agree")).where(F.col("pairs") > 0)


def _from_subsets(sigs: DataFrame, rate: float | None, most_items: int) -> DataFrame:
    subsets = F.expr("transform(sequence(1, shiftleft(1, size(s)) - 1), m -> filter(s, (x, i) -> (shiftright(m, i) & 1) = 1))")
    held = sigs.where(F.size("s") > 0).select("g", F.explode(subsets).alias("t"), F.size("s").alias("a"), "y", "n")
    cells = held.groupBy("g", "t", "a", "y").agg(F.sum("n").alias("n"))
    # A subset's cells: sizes times distinct outcomes, not rows.
    met = (cells.groupBy("g", "t").agg(F.collect_list(F.struct("a", "y", "n")).alias("cells"), F.sum("n").alias("all"))
           .where(F.col("all") > 1))
    both = met.select(F.size("t").alias("j"), "cells", F.explode("cells").alias("p")).select("j", "p", F.explode("cells").alias("q"))
    p, q = F.col("p"), F.col("q")
    # Different rows only: a cell meets itself in all but its own rows.
    same = (p["a"] == q["a"]) & (p["y"] == q["y"])
    ways = p["n"].cast(_BIG) * q["n"].cast("decimal(18,0)") - F.when(same, p["n"]).otherwise(F.lit(0)).cast(_BIG)
    agree = ways.cast("double") * agreement(p["y"], q["y"], rate)
    sums = both.select("j", p["a"].alias("a"), q["a"].alias("b"), ways.cast(_BIG).alias("ways"), agree.alias("agree")).groupBy("j", "a", "b").agg(
        F.sum("ways").cast(_BIG).alias("ways"), F.sum("agree").alias("agree"))
    # At most most_items ** 3 rows; back from the sums of C(k, j) to the pairs of each k.
    signed = F.array(*[F.array(*[F.lit((-1) ** (j - k) * comb(j, k)) for k in range(1, j + 1)]) for j in range(1, most_items + 1)])
    terms = sums.select("a", "b", "ways", "agree", F.posexplode(F.element_at(signed, F.col("j"))).alias("at", "factor"))
    return terms.select("a", "b", (F.col("at") + 1).alias("k"), (F.col("ways") * F.col("factor")).cast(_BIG).alias("pairs"),
                        (F.col("agree") * F.col("factor")).alias("agree"))


def _from_items(long: DataFrame, sigs: DataFrame, rate: float | None, most_items: int, salts: int) -> DataFrame:
    """Pairs with a long set on either side, met at their smallest shared item;
    an item's list of partners is dealt to ``salts`` tasks."""
    salt = F.pmod(F.xxhash64("s", "y"), F.lit(salts))
    mine = long.select("g", "s", "y", "n", F.explode("s").alias("item"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")).alias("all")).select(
        "g", F.col("s").alias("s1"), F.col("y").alias("y1"), F.col("n").alias("n1"), "item", F.explode("all").alias("salt"))
    other = sigs.select("g", F.col("s").alias("s2"), F.col("y").alias("y2"), F.col("n").alias("n2"), F.explode("s").alias("item"), salt.alias("salt"))
    shared = F.array_intersect("s1", "s2")
    met = mine.join(other, ["g", "item", "salt"]).where(F.get(shared, F.lit(0)) == F.col("item"))
    same = (F.col("s1") == F.col("s2")) & (F.col("y1") == F.col("y2"))
    ways = F.col("n1").cast(_BIG) * F.col("n2").cast("decimal(18,0)") - F.when(same, F.col("n1")).otherwise(F.lit(0)).cast(_BIG)
    found = met.select(F.size("s1").alias("a"), F.size("s2").alias("b"), F.size(shared).alias("k"), ways.cast(_BIG).alias("pairs"),
                       (ways.cast("double") * agreement(F.col("y1"), F.col("y2"), rate)).alias("agree"))
    turned = F.explode(F.when(F.col("b") > most_items, F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    return found.select(turned.alias("ab"), "k", "pairs", "agree").select("ab.a", "ab.b", "k", "pairs", "agree")


def pair_totals(sigs: DataFrame, rate: float | None = None) -> DataFrame:
    """One row: N pairs of different rows of one group, the sum of their
    agreements Y and of their squares YY, from counts of outcomes only."""
    if rate is None:
        per = sigs.groupBy("g", "y").agg(F.sum("n").cast(_BIG).alias("c"))
        own = per.agg(F.sum((F.col("c") * (F.col("c") - 1)).cast("double") / 2).alias("Y"))
        all_pairs = per.groupBy("g").agg(F.sum("c").cast(_BIG).alias("c")).agg(F.sum((F.col("c") * (F.col("c") - 1)).cast("double") / 2).alias("N"))
        return all_pairs.crossJoin(own).select("N", "Y", F.col("Y").alias("YY"))  # single rows
    # Distinct outcomes of a group: pairs of outcomes, not of rows.
    per = materialize(sigs.groupBy("g", "y").agg(F.sum("n").alias("n")))
    p, q = per.alias("p"), per.alias("q")
    both = p.join(q, (F.col("p.g") == F.col("q.g")) & (F.col("p.y") <= F.col("q.y")))
    ways = F.when(F.col("p.y") == F.col("q.y"), F.col("p.n").cast("double") * (F.col("p.n") - 1) / 2).otherwise(
        F.col("p.n").cast("double") * F.col("q.n"))
    agree = agreement(F.col("p.y"), F.col("q.y"), rate)
    return both.agg(F.sum(ways).alias("N"), F.sum(ways * agree).alias("Y"), F.sum(ways * agree * agree).alias("YY"))
