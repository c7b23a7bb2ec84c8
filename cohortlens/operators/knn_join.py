"""Exact k nearest neighbours of many vectors among all rows of a table.

A metric-space join by a table of pivots:

1. ``PIVOTS`` vectors at most, drawn by hash, are the pivots; every row goes to
   the cell of its nearest one and keeps its distance to it.  A cell of more
   than ``CELL`` rows is dealt by hash into parts, so no task gets more rows,
   however many are alike.
2. Of each cell the radius and the ``k`` smallest distances to the pivot are
   known (bounded: pivots x k).  A query's distance to a pivot plus such a
   distance is at least the distance to that row, so the k-th smallest of these
   sums is an upper bound of the query's k-th neighbour.
3. A query visits the cells that the triangle inequality and the bisector of
   its own and the cell's pivot do not rule out.  Queries come in blocks, and a
   part meets a block once.
4. Each meeting returns the k best of each query; the final k are a rank limit,
   which Spark applies before the shuffle as well.

Bounds have a slack for rounding; the distances themselves come from the
differences of the components in double precision, so equal vectors have equal
distances and ties are broken by id.

Vectors that are null or hold null or non-finite components are in no result and
have none.  All others must have one length.  Rows with a null id are left out.
Query ids are unique; a repeated id of ``points`` counts once for each row, and
with ``exclude_same_id`` ids are unique there, too.  Fewer than ``k`` rows give
fewer neighbours; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialize

PIVOTS = 256
CELL = 4096
QUERIES = 2048
SLACK = 1e-7


def _usable(df: DataFrame, key: str, vector: Column | str) -> DataFrame:
    v = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    own = df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & (F.size("v") > 0))
    return own.where(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances by the product form: fast, right up to the slack."""
    sq = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _room(x: np.ndarray, size: float) -> np.ndarray:
    """Slack of each row's distances to vectors of at most ``size``."""
    return SLACK * (np.sqrt((x * x).sum(1)) + size)


def _nearest_pivot(points: DataFrame, pivots) -> DataFrame:
    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                d = _apart(x, pivots.value)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell]),
                     pa.array(np.sqrt((x * x).sum(1)))], names=["id", "v", "cell", "d", "size"])

    return points.mapInArrow(assign, "id long, v array<double>, cell int, d double, size double")


def _visits(queries: DataFrame, pivots, cells: list, near: list[list[float]], k: int) -> DataFrame:
    """(query_id, qv, cell) for the cells that a query cannot rule out."""
    cell = np.array([r["cell"] for r in cells], np.int32)
    reach, size = np.array([r["reach"] for r in cells]), max(r["size"] for r in cells)
    each = np.concatenate([np.full(len(n), i) for i, n in enumerate(near)]).astype(np.int64)
    least = np.concatenate([np.array(n) for n in near])

    def visit(batches):
        at = pivots.value[cell]
        between = _apart(at, at)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                x = _matrix(part.column(1))
                d, room = _apart(x, at), _room(x, size)
                sums = d[:, each] + least[None, :]
                bound = np.full(len(x), np.inf) if len(least) < k else np.partition(sums, k - 1, axis=1)[:, k - 1] + room
                open_ = d - reach[None, :] <= (bound + room)[:, None]
                own = d.argmin(1)
                gap, apart = d * d - (d[np.arange(len(x)), own] ** 2)[:, None], between[own]
                # The bisector's rounding grows with the distances over the gap between the pivots.
                with np.errstate(divide="ignore", invalid="ignore"):
                    beyond = np.where(apart > 0, gap / (2.0 * apart), 0.0)
                    wide = np.where(apart > 0, room[:, None] * (1.0 + 2.0 * d / apart), 0.0)
                open_ &= beyond <= bound[:, None] + wide
                row, to = np.nonzero(open_)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(cell[to])],
                                                 names=["query_id", "qv", "cell"])

    return queries.mapInArrow(visit, "query_id long, qv array<double>, cell int")


def _best(k: int, exclude_same_id: bool, zero: float, digits: int | None):
    def best(keys, queries: pa.Table, points: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and points.num_rows:
            q, x = _matrix(queries["qv"]), _matrix(points["v"])
            qid, ids = queries["query_id"].to_numpy(), points["id"].to_numpy()
            size = float(np.sqrt((x * x).sum(1)).max())
            for low in range(0, len(q), 256):
                part = q[low : low + 256]
                rough, room = _apart(part, x), _room(part, size)
                for i, far in enumerate(rough):
                    if exclude_same_id:
                        far[ids == qid[low + i]] = np.inf
                    kth = np.partition(far, k - 1)[k - 1] if len(far) > k else np.inf
                    at = np.flatnonzero((far <= max(kth, zero) + 2.0 * room[i]) & (far < np.inf))
                    diff = x[at] - part[i]
                    d = np.sqrt((diff * diff).sum(1))
                    d[d <= zero] = 0.0
                    d = d if digits is None else d.round(digits)
                    order = np.lexsort((ids[at], d))[:k]
                    out[0].append(np.full(len(order), qid[low + i]))
                    out[1].append(ids[at][order])
                    out[2].append(d[order])
        kinds = (np.int64, np.int64, np.float64)
        a, b, c = (np.concatenate(o).astype(t) if o else np.zeros(0, t) for o, t in zip(out, kinds))
        return pa.table({"query_id": a, "id": b, "distance": c})

    return best


def knn_join(queries: DataFrame, points: DataFrame, k: int, key: str = "hadm_id", vector: Column | str = "v",
             exclude_same_id: bool = True, pivots: int = PIVOTS, cell: int = CELL, block: int = QUERIES, zero: float = 0.0,
             digits: int | None = None) -> DataFrame:
    """(query_id, id, distance) of the k nearest ``points`` of every row of
    ``queries`` (Euclidean, ties by id).  Distances up to ``zero`` count as 0,
    and are ranked as rounded to ``digits`` decimals, if given."""
    spark = queries.sparkSession
    schema = "query_id long, id long, distance double"
    points = _usable(points, key, vector)
    # A bounded draw: the first of an order by hash.
    drawn = points.orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(int(pivots)).collect()
    if not drawn:
        return spark.createDataFrame([], schema)
    length = len(drawn[0]["v"])
    fits = F.when(F.size("v") == length, F.col("v")).otherwise(F.raise_error(F.lit(f"vectors of a length other than {length}")).cast("array<double>"))
    points, queries = points.withColumn("v", fits), _usable(queries, key, vector).withColumn("v", fits)
    shared = spark.sparkContext.broadcast(np.unique(np.array([r["v"] for r in drawn if len(r["v"]) == length], np.float64), axis=0))
    dealt = materialize(_nearest_pivot(points, shared))
    want = k + 1 if exclude_same_id else k
    # One row a cell, and k a cell: bounded by the pivots.
    cells = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("reach"), F.max("size").alias("size")).orderBy("cell").collect()
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("d"))
    least: dict[int, list[float]] = {}
    for r in dealt.select("cell", "d", rank.alias("rank")).where(F.col("rank") <= want).collect():
        least.setdefault(r["cell"], []).append(r["d"])
    visits = _visits(queries.select(F.col("id").alias("query_id"), F.col("v").alias("qv")), shared, cells, [least[r["cell"]] for r in cells], want)
    blocks = max(1, -(-queries.count() // block))
    visits = materialize(visits.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")))
    parts = F.create_map(*[F.lit(x) for r in cells for x in (r["cell"], -(-r["n"] // cell))])
    dealt = dealt.select("id", "v", "cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts[F.col("cell")]).cast("int").alias("part"))
    # A part is copied to the blocks that visit its cell, a query to the parts of the cell.
    met = visits.select("cell", F.col("block").alias("met")).distinct()
    left = visits.withColumn("part", F.explode(F.sequence(F.lit(0), parts[F.col("cell")] - 1)))
    right = dealt.join(met, "cell").select("id", "v", "cell", "part", F.col("met").alias("block"))
    found = left.groupBy("cell", "part", "block").cogroup(right.groupBy("cell", "part", "block")).applyInArrow(
        _best(k, exclude_same_id, zero, digits), schema)
    last = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return found.withColumn("rank", last).where(F.col("rank") <= k).drop("rank")
