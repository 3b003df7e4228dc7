"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Rows are dealt into shards of a bounded number of vectors and queries into blocks
of a bounded number of queries; a task holds one shard and one block. A task
builds a ball tree over its shard and walks it with the whole block at once,
children with the larger upper bound first, dropping the queries whose current
k-th score the node cannot beat. The shards are searched in waves, the first of one
shard and each later one larger; the k-th scores found so far are handed to the next
wave's shards as their starting bound.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

SHARD_ROWS = 16_384
QUERY_ROWS = 16_384
LEAF_ROWS = 256
_FOUND = "query_id long, vec_id long, score long"
WAVE_GROWTH = 16
_EXACT, _LONG = 2.0**53, 2.0**62
_LOWEST = -(2**63)


class BallTree:
    """Nodes as parallel lists; a node is (start, end, centre, radius, smallest id, children)."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(points))
        self.points, self.ids = points, ids
        self.nodes: list[tuple] = []
        self.root = self._grow(0, len(points), leaf_rows)
        self.points, self.ids = points[self.order], ids[self.order]

    def _grow(self, start: int, end: int, leaf_rows: int) -> int:
        rows = self.order[start:end]
        own = self.points[rows]
        centre = own.mean(axis=0) if len(own) else np.zeros(self.points.shape[1])
        radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())) if len(own) else 0.0
        children: tuple[int, ...] = ()
        if end - start > leaf_rows:
            low, high = own.min(axis=0), own.max(axis=0)
            along = own[:, int(np.argmax(high - low))]
            self.order[start:end] = rows[np.argsort(along, kind="stable")]
            middle = (start + end) // 2
            children = (self._grow(start, middle, leaf_rows), self._grow(middle, end, leaf_rows))
        smallest = int(self.ids[rows].min()) if len(rows) else 0
        self.nodes.append((start, end, centre, radius, smallest, children))
        return len(self.nodes) - 1


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.row = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.kth = floor.copy()
        self.kth_id = np.full(queries, np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, row))  # ~ turns the order round without overflow
        row, score, ids = row[order], score[order], ids[order]
        first = np.r_[True, row[1:] != row[:-1]]
        start = np.flatnonzero(first)
        place = np.arange(len(row)) - start[np.cumsum(first) - 1]
        keep = place < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]
        full = place == self.k - 1
        better = score[full] >= self.floor[row[full]]
        at = row[full][better]
        self.kth[at], self.kth_id[at] = score[full][better], ids[full][better]


def search_shard(points, ids, queries, query_ids, floor, k, leaf_rows=LEAF_ROWS):
    """The k best rows of one shard for each query, rows below ``floor`` left out.

    Components are whole numbers held as float64 and scores are 64-bit integers, exact at
    every size: products that could leave float64's exact range are made with integers. A
    score that doesn't fit is an error.
    """
    tree = BallTree(points, ids, leaf_rows)
    best = Best(len(queries), k, floor)
    norms = np.sqrt((queries**2).sum(axis=1))
    top = max(np.abs(points).max(initial=0.0) * np.abs(queries).max(initial=0.0) * points.shape[1], 1.0)
    slack = 1e-9 * top  # rounding of the bound itself
    if top >= _EXACT:
        kind = np.int64 if top < _LONG and max(np.abs(points).max(), np.abs(queries).max()) < _LONG else object
        whole = lambda x: x.astype(np.int64) if kind is np.int64 else np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
        whole_queries, whole_points = whole(queries), whole(tree.points)

    def scored(active, start, end):
        if top < _EXACT:
            return (queries[active] @ tree.points[start:end].T).astype(np.int64)
        found = whole_queries[active] @ whole_points[start:end].T
        if kind is object:
            if any(not -(2**63) <= v < 2**63 for v in found.ravel()):
                raise ValueError("an inner product does not fit 64 bits")
            found = found.astype(np.int64)
        return found

    def bound(node, active):
        _, _, centre, radius, _, _ = tree.nodes[node]
        return queries[active] @ centre + norms[active] * radius + slack

    def visit(node, active, upper):
        start, end, _, _, smallest, children = tree.nodes[node]
        kth, kth_id = best.kth[active].astype(np.float64), best.kth_id[active]
        alive = (upper > kth) | ((upper >= kth) & (smallest <= kth_id))
        active = active[alive]
        if not len(active):
            return
        if children:
            uppers = [bound(child, active) for child in children]
            first = int(uppers[1].mean() > uppers[0].mean())
            for child in (first, 1 - first):
                visit(children[child], active, uppers[child])
            return
        scores = scored(active, start, end)
        own = tree.ids[start:end]
        kth, kth_id = best.kth[active][:, None], best.kth_id[active][:, None]
        r, c = np.nonzero(((scores > kth) | ((scores == kth) & (own[None, :] <= kth_id))) & (own[None, :] != query_ids[active][:, None]))
        if len(r):
            best.add(active[r], scores[r, c], own[c])

    everyone = np.arange(len(queries))
    if len(queries) and len(points):
        visit(tree.root, everyone, bound(tree.root, everyone))
    return best


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = len(column[0]) if len(column) else 0
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(256.0 * flat).reshape(len(column), width)


def _searcher(k: int):
    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and asked.num_rows:
            query_ids = asked["q_vec_id"].to_numpy()
            best = search_shard(_matrix(rows["embedding"]), rows["vec_id"].to_numpy(), _matrix(asked["q_embedding"]), query_ids, asked["q_floor"].to_numpy(), k)
            found = [query_ids[best.row], best.id, best.score]
        else:
            found = [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))

    return search


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each query row.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all
    rows with another ``vec_id`` and as many components. Rows whose id or vector is
    null, and vectors that hold a null or non-finite component, take no part. A row
    that is repeated is a candidate each time; a repeated query id is asked once, with
    its smallest vector. Fewer than k candidates give fewer rows, an empty table none.
    Scores are exact; one that doesn't fit 64 bits fails the job.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    usable = usable.withColumn("width", F.size("embedding"))
    is_query = F.col("vec_id") % every == 0
    n_rows, n_queries = usable.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_queries // query_rows))

    # Of a row that is repeated, k copies are all that any answer can hold.
    dealt = usable.groupBy("vec_id", "embedding", "width").agg(F.count("*").alias("copies"))
    dealt = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int")))).drop("copies", "copy")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = usable.where(is_query).groupBy("vec_id").agg(F.min_by("embedding", F.struct("width", "embedding")).alias("embedding"))
    asked = asked.withColumn("width", F.size("embedding")).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    keys = ["shard", "block", "width"]
    search = _searcher(k)

    def searched(rows: DataFrame, queries: DataFrame) -> DataFrame:
        # Both sides come from one table; aliases tell their columns apart.
        queries = queries.select(*(F.col(c).alias(f"q_{c}") for c in ("vec_id", "embedding", "floor", *keys)))
        return rows.groupBy(*keys).cogroup(queries.groupBy(*(f"q_{c}" for c in keys))).applyInArrow(lambda a, b: search(a, b), _FOUND)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, low, high = None, 0, 1
    while low < shards:
        rest = asked.withColumn("floor", F.lit(_LOWEST))
        if found is not None:
            kth = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
            rest = asked.join(kth, "vec_id", "left").withColumn("floor", F.coalesce("kth", F.lit(_LOWEST)))
        rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(low), F.lit(high - 1)))).select("vec_id", "embedding", "floor", *keys)
        new = searched(dealt.where(F.col("shard").between(low, high - 1)), rest)
        both = new if found is None else found.unionByName(new)
        best = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        low, high = high, min(shards, high + (high - low) * WAVE_GROWTH)
        found = cut(best.drop("rank")) if low < shards else best
    return found.select("query_id", "rank", "vec_id", "score")
