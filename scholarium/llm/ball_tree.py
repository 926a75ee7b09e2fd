"""Exact top-k inner products by ball trees: branch and bound per shard, sharing each query's kth score.

Components become floor(scale * x), so scores are integers. Vectors go to the cell of the nearest of at most
MOST_PIVOTS pivots, a seeded sample; a cell of many rows is dealt into several shards by a hash, so a vector that a
third of all rows hold fills many shards of bounded size. Each shard's ball tree is built once and written: nodes with a
centre, a radius and the smallest id below. For a query q a node can't score above q.c + |q| r, so nodes are taken
best bound first and the search of a shard ends when the best bound left is below the kth score.

A query goes to shards in waves, best bound of their cell first: its own, the next WAVE ones, all others. The kth score of
all waves so far is the floor of the next one, and shards whose bound is below it aren't asked. Rows sent are the queries,
once a shard asked; a shard's tree is sent once for BLOCK_ROWS queries, which stream past it in batches.

Ties go to the smaller id. Rows whose vector is null, or holds a null or non-finite component, take no part;
queries only meet vectors of their own length; equal rows are all candidates, but those with the query's
own id; an id with several vectors is asked with each and has one list of the best of all. A query with no
candidates has no rows, and an empty table gives none.

Scores are exact at any size of components: where sums of products might pass 2^53, doubles only choose which rows of a leaf
could reach the kth score, with a margin above their rounding, and these are multiplied in whole numbers. Components
beyond a long's range are held at its limits, and so are scores, which tie there.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, settle

K, SCALE, QUERY_EVERY = 20, 64, 20
#: Rows of a shard and of a block of queries, in the mean; of a leaf, at most; and pivots, at most.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS, MOST_PIVOTS = 16_384, 65_536, 192, 1_024
#: Shards of a query's second wave, and bytes of a tree in one row.
WAVE, PART_BYTES = 4, 1 << 16
SEED = 17
#: A long's limit, and the double next to the lower one that isn't below it.
LONG, LOWEST = (1 << 63) - 1, -float((1 << 63) - 1024)


class BallTree:
    """A tree over integer vectors (as doubles) and their ids."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        self.nodes: list[tuple] = []  # smallest id, left, right, rows from, to
        centres, radii = [], []
        order = np.arange(len(ids))
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            rows = order[a:b]
            x = vectors[rows]
            centre = x.mean(0)
            distance = ((x - centre) ** 2).sum(1)
            number = len(self.nodes)
            self.nodes.append([int(ids[rows].min()), -1, -1, a, b])
            centres.append(centre)
            radii.append(float(np.sqrt(distance.max())))
            if parent >= 0:
                self.nodes[parent][1 + side] = number
            if b - a > leaf and distance.max() > 0:
                one = x[distance.argmax()]
                two = x[((x - one) ** 2).sum(1).argmax()]
                cut = np.argsort(x @ (two - one), kind="stable")
                order[a:b] = rows[cut]
                middle = (a + b) // 2
                stack += [(a, middle, number, 0), (middle, b, number, 1)]
        self.vectors, self.ids = np.ascontiguousarray(vectors[order]), ids[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.most = float(np.abs(vectors).max(initial=0))

    def pack(self) -> bytes:
        """The tree as bytes; components are whole numbers."""
        # a double that is a whole number and beyond 64 bits stays a double
        kind = np.int32 if self.most < 1 << 31 else np.int64 if self.most < 1 << 62 else np.float64
        return pickle.dumps((self.nodes, self.vectors.astype(kind), self.ids, self.centres, self.radii, self.most))

    @classmethod
    def unpack(cls, data: bytes) -> BallTree:
        out = cls.__new__(cls)
        out.nodes, vectors, out.ids, out.centres, out.radii, out.most = pickle.loads(data)
        out.vectors = vectors.astype(float)
        return out

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """What each node can score at most for each query."""
        return upper_bounds(queries, self.centres, self.radii)

    def top(self, query: np.ndarray, own: int, k: int, floor: float, bounds: np.ndarray | None = None) -> list[tuple[int, int]]:
        """The k best (score, -id) other than ``own`` with a score of ``floor`` or more, best first."""
        bounds = self.bounds(query[None])[0] if bounds is None else bounds
        most = float(np.abs(query).max(initial=0))
        # beyond this, sums in doubles are only near the scores
        exact = len(query) * self.most * most < 1 << 53
        margin = 0.0 if exact else len(query) * self.most * most * 1e-12
        whole = None if exact else [int(x) for x in query]
        bounds = bounds if exact else np.maximum(bounds, LOWEST)
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, number = heapq.heappop(queue)
            bound = -bound
            least, left, right, a, b = self.nodes[number]
            kth = best[0] if len(best) == k else (floor, -(1 << 63))
            if bound < kth[0]:
                break
            if bound == kth[0] and -least < kth[1]:
                continue
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= kth[0]:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            scores = self.vectors[a:b] @ query if exact else np.maximum(self.vectors[a:b] @ query, LOWEST)
            keep = np.flatnonzero((scores >= float(kth[0]) - margin) & (self.ids[a:b] != own))
            if exact:
                if len(keep) > k:
                    keep = keep[np.lexsort((self.ids[a:b][keep], -scores[keep]))[:k]]
                found = [int(x) for x in scores[keep]]
            else:
                found = [max(-LONG, min(LONG, sum(int(x) * y for x, y in zip(row, whole, strict=True)))) for row in self.vectors[a:b][keep].tolist()]
            for score, i in zip(found, keep, strict=True):
                row = (score, -int(self.ids[a + i]))
                if row < kth:
                    continue
                if len(best) < k:
                    heapq.heappush(best, row)
                elif row > best[0]:
                    heapq.heapreplace(best, row)
        return sorted(best, reverse=True)


def upper_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """q.c + |q| r for every query and ball, raised by what rounding may take off."""
    sizes, far = np.sqrt((queries**2).sum(1))[:, None], np.sqrt((centres**2).sum(1))[None]
    return queries @ centres.T + sizes * radii[None] + 1e-11 * sizes * (far + radii[None]) + 1e-9


def _matrix(column, rows: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _placed(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the cell, the nearest pivot of the row's own length, and the distance to it. Rows of a length without pivot have cell 0."""

    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            cell, far = np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                x, p = _matrix(batch.column(1).take(pa.array(own)), len(own)), pivots.get(int(d))
                p = np.zeros((1, int(d))) if p is None else p
                near = ((p**2).sum(1)[None] - 2 * x @ p.T).argmin(1)
                cell[own], far[own] = near, np.sqrt(((x - p[near]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["vec_id", "vector", "dim", "cell", "far"])

    return bound_batches(rows).mapInArrow(run, "vec_id long, vector array<double>, dim int, cell long, far double")


def _trees(placed: DataFrame) -> DataFrame:
    """(shard, part, tree): each shard's ball tree, cut into rows of PART_BYTES."""

    def build(group: pa.Table) -> pa.Table:
        tree = BallTree(_matrix(group.column("vector"), group.num_rows), group.column("vec_id").to_numpy()).pack()
        parts = [tree[at : at + PART_BYTES] for at in range(0, len(tree), PART_BYTES)]
        shard = group.column("shard")[0].as_py()
        return pa.table([pa.array([shard] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["shard", "part", "tree"])

    return placed.select("shard", "vec_id", "vector").groupBy("shard").applyInArrow(build, "shard string, part int, tree binary")


def _asked(queries: DataFrame, cells: dict, wave: int) -> DataFrame:
    """(shard, query_id, vector, floor): the shards of a wave that could hold a score of the floor or more.

    ``cells`` has for each length the pivots, radii and numbers of shards of its cells. Wave 0 is one shard of the own
    cell; then come the shards of all cells by bound.
    """

    def run(batches):
        for batch in batches:
            out: list[list] = [[], []]
            dims = batch.column(2).to_numpy()
            ids, floors = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                numbers, centres, radii, shards = cells[int(d)]
                x = _matrix(batch.column(1).take(pa.array(own)), len(own))
                bounds = upper_bounds(x, centres, radii)
                home = np.searchsorted(numbers, batch.column(3).to_numpy()[own])
                begins = np.cumsum(shards) - shards  # of each cell's shards
                cell = np.repeat(np.arange(len(shards)), shards)
                names = np.array([f"{d}/{numbers[c]}/{s - begins[c]}" for s, c in enumerate(cell)], object)
                for i, row in enumerate(own):
                    picked = begins[home[i]] + ids[row] // QUERY_EVERY % shards[home[i]]
                    if wave > 0:
                        ranked = np.argsort(-bounds[i, cell], kind="stable")
                        ranked = ranked[(ranked != picked) & (bounds[i, cell[ranked]] >= floors[row])]
                        picked = ranked[:WAVE] if wave == 1 else ranked[WAVE:]
                    chosen = names[np.atleast_1d(picked)]
                    out[0] += chosen.tolist()
                    out[1] += [int(row)] * len(chosen)
            at = pa.array(out[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *(batch.column(i).take(at) for i in (0, 1, 4))], names=["shard", "query_id", "vector", "floor"])

    return bound_batches(queries.select("query_id", "vector", "dim", "cell", "floor")).mapInArrow(run, "shard string, query_id long, vector array<double>, floor double")


def _found(asked: DataFrame, trees: DataFrame, k: int, block_rows: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each shard for each query that asks it; queries stream past the tree in blocks."""
    sizes = asked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    left = trees.join(sizes, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part", "tree")
    right = asked.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.col("blocks")).cast("int"))
    both = left.select("shard", "block", "part", "tree", F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("array<double>").alias("vector"), F.lit(None).cast("double").alias("floor"))
    both = both.unionByName(right.select("shard", "block", F.lit(1 << 30).alias("part"), F.lit(None).cast("binary").alias("tree"), "query_id", "vector", "floor"))

    def run(batches):
        unit, tree, parts = None, None, []
        for batch in batches:
            shard, block = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            is_part = batch.column(3).is_valid().to_pylist()
            out: list[list] = [[], [], []]
            at = 0
            while at < batch.num_rows:
                end = at
                while end < batch.num_rows and (shard[end], block[end], is_part[end]) == (shard[at], block[at], is_part[at]):
                    end += 1
                if (shard[at], block[at]) != unit:
                    unit, tree, parts = (shard[at], block[at]), None, []
                if is_part[at]:
                    parts += batch.column(3).slice(at, end - at).to_pylist()
                else:
                    if tree is None:
                        tree, parts = BallTree.unpack(b"".join(parts)), []
                    x = _matrix(batch.column(5).slice(at, end - at), end - at)
                    ids, floors = (batch.column(c).slice(at, end - at).to_numpy() for c in (4, 6))
                    for q, own, floor, bounds in zip(x, ids.tolist(), floors.tolist(), tree.bounds(x), strict=True):
                        for score, other in tree.top(q, own, k, floor, bounds):
                            for column, value in zip(out, (own, -other, score), strict=True):
                                column.append(value)
                at = end
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

    names = ("shard", "block", "part", "tree", "query_id", "vector", "floor")
    met = bound_batches(both.select(*names)).repartition("shard", "block").sortWithinPartitions("shard", "block", "part")
    return met.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = K, scale: int = SCALE, every: int = QUERY_EVERY, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, pivots: int = MOST_PIVOTS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row whose id ``every`` divides."""
    x = F.col("raw")
    sound = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("raw")).where("vec_id is not null").where(sound)
    rows = rows.select("vec_id", F.transform(x, lambda v: F.floor(v * scale).cast("double")).alias("vector"), F.size(x).alias("dim"))
    rows = settle(rows, "vectors")
    sizes = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(pivots).collect()}
    # the sample of each length is bounded by the pivots in all
    chosen: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        wanted = min(-(-n // shard_rows), max(1, pivots * n // sum(sizes.values())))
        if wanted > 1:
            picked = rows.where(F.col("dim") == dim).select("vector").distinct().orderBy(F.xxhash64("vector", F.lit(SEED)), "vector").limit(wanted)
            chosen[dim] = np.array([r.vector for r in picked.collect()])
    placed = settle(_placed(rows, chosen), "placed")
    counts = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).withColumn("shards", F.ceil(F.col("n") / shard_rows).cast("int"))
    cells: dict[int, tuple] = {}
    found = sorted(counts.select("dim", "cell", "far", "shards").collect())
    for dim in {r.dim for r in found}:
        own = [r for r in found if r.dim == dim]
        numbers, p = np.array([r.cell for r in own]), chosen.get(dim, np.zeros((1, dim)))
        cells[dim] = (numbers, p[numbers], np.array([r.far for r in own]), np.array([r.shards for r in own]))
    dealt = F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards"))
    named = F.concat_ws("/", F.col("dim").cast("string"), F.col("cell").cast("string"), dealt.cast("string"))
    trees = settle(_trees(placed.join(counts.select("dim", "cell", "shards"), ["dim", "cell"]).withColumn("shard", named)), "trees")

    queries = placed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector", "dim", "cell").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = None
    for wave in range(3 if any(c[3].sum() > 1 for c in cells.values()) else 1):
        floor = F.lit(float("-inf"))
        asking = queries.withColumn("floor", floor)
        if best is not None:
            # the kth score so far is a floor for all shards to come
            low = F.min("score").cast("double")
            # as a double it may be above the score itself
            kth = best.groupBy("query_id").agg((low - F.abs(low) * 1e-15).alias("low"), F.count(F.lit(1)).alias("n"))
            asking = queries.join(kth, "query_id", "left").withColumn("floor", F.when(F.col("n") == k, F.col("low")).otherwise(floor))
        new = _found(settle(_asked(asking, cells, wave), "asked"), trees, k, block_rows)
        new = new if best is None else best.select("query_id", "vec_id", "score").unionByName(new)
        best = settle(new.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
