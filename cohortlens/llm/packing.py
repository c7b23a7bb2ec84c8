"""Best-fit packing with source and duplicate conflicts.

Documents are packed into bins of ``capacity`` (bytes of UTF-8 here).  No bin
holds two documents of one source or of one duplicate cluster.  A document
above the capacity is cut: whole pieces of the capacity fill bins of their own,
the rest is packed like any other.

Pieces are dealt by a hash of their row number, so that no repeated id fills a
shard, into shards of about ``shard_rows`` and each shard is packed by one task, longest piece first (best-fit decreasing).  A shard's open
bins stand in order of their residual space and carry one bitmap of the sources
and clusters they hold; from the first bin that is large enough the search goes
on to its successors until a bin has none of the piece's bits: the tightest
compatible bin.  If there is none, a new bin is opened.  The search visits the
bins of its shard at most, so a source or cluster with a third of all rows
costs bins, as it must, but no unbounded task.

Nothing is dropped: each byte of each row is in exactly one bin.  Null or empty
text is a piece of length 0.  A null source or cluster has no conflict.
Repeated rows are packed each; a null id is packed too.  An empty table gives
an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

CAPACITY = 16_384
SHARD_ROWS = 8192


def duplicate_cluster(text: Column) -> Column:
    """Cluster of texts that are equal but for case and white space."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(F.length(plain) > 0, F.xxhash64(plain))


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin number of every piece; pieces come in the order of packing."""
    source_bit: dict = {}
    cluster_bit: dict = {}
    for s in sources:
        if s is not None:
            source_bit.setdefault(s, len(source_bit))
    shift = len(source_bit)
    seen: set = set()
    for c in clusters:  # a cluster of one piece needs no bit
        if c is not None:
            if c in seen:
                cluster_bit.setdefault(c, shift + len(cluster_bit))
            seen.add(c)
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    bits: list[int] = []
    out = []
    for size, s, c in zip(sizes, sources, clusters):
        own = (1 << source_bit[s] if s is not None else 0) | (1 << cluster_bit[c] if c in cluster_bit else 0)
        at = bisect_left(order, (size, -1))
        while at < len(order) and bits[order[at][1]] & own:
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
            bits[b] |= own
        else:
            residual, b = capacity, len(bits)
            bits.append(own)
        if residual > size:  # a full bin is closed
            insort(order, (residual - size, b))
        out.append(b)
    return out


def best_fit(docs: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS,
             text: str = "text", source: str = "source", cluster: Column | None = None) -> DataFrame:
    """(key, piece, start, length, bin_id, bin_used) of every piece."""
    spark = docs.sparkSession
    ship(spark)
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")
    rows = stored(docs.select(
        F.col(key).cast("long").alias(key), size.alias("size"), F.col(source).cast("string").alias("source"),
        (duplicate_cluster(F.col(text).cast("string")) if cluster is None else cluster.cast("long")).alias("cluster"),
        F.monotonically_increasing_id().alias("row")))
    pieces = rows.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("int"))).alias("piece"))
    pieces = pieces.select(key, "piece", (F.col("piece") * F.lit(capacity).cast("long")).alias("start"),
                           F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece") * F.lit(capacity)).alias("length"),
                           "source", "cluster", "row")
    n = rows.select(F.sum(F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)))).first()[0] or 0
    shards = max(1, -(-int(n) // shard_rows))
    # The row number is written with the rows, so a repeated task deals alike.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))

    def shard(keys, table):
        number = keys[0].as_py()
        ids, known = table[key].fill_null(0).to_numpy(), table[key].is_valid().to_numpy()
        length, piece = table["length"].to_numpy(), table["piece"].to_numpy()
        order = np.lexsort((table["row"].to_numpy(), piece, ids, known, -length))  # null ids first
        table = table.take(pa.array(order))
        sizes = table["length"].to_pylist()
        bins = np.array(pack(sizes, table["source"].to_pylist(), table["cluster"].to_pylist(), capacity), np.int64)
        used = np.bincount(bins, weights=np.array(sizes, np.float64)).astype(np.int64) if len(bins) else bins
        return pa.table({key: table[key], "piece": table["piece"], "start": table["start"], "length": table["length"],
                         "bin_id": (number << 32) + bins, "bin_used": used[bins]})

    return (dealt.select(key, "piece", "start", "length", "source", "cluster", "row", "shard").groupBy("shard")
            .applyInArrow(shard, f"`{key}` long, piece int, start long, length long, bin_id long, bin_used long"))
