"""Centroid clustering: rounds of nearest-centroid assignment by Orchard's search.

Each centroid has a list of all others, nearest first. A vector starts at some centroid and walks its list; a centroid that is
nearer (or as near, with a smaller number) becomes the current one at once and its own list is walked from the front. Centroids that
were met are marked and not measured again. A walk stops at the first one that lies strictly beyond twice the current distance: by the
triangle inequality neither it nor any later one can be as near. All vectors of a batch walk together, in steps. A vector starts at the
nearest of a few centroids, which are its first marks.

Components become floor(scale * x) and everything after that is exact: distances, sums, and floors of sums over counts. Batches whose squared
distances fit into 64 bits are computed so, others in Python's whole numbers. A distance or a sum of distances that doesn't fit into a long is null in the
result; it has counted in full.

A round is a map over the vectors, which gives each task's sums of its clusters, and two groupings of those: by cluster and lane, then by cluster.
What the driver gets is one row a centroid, and the centroids are what is sent to tasks; both are bounded by their number. Vectors are written once and
read in each round.

Vectors that are null, hold null or non-finite components or have another length take no part and are not returned. The first
centroids are the vectors with the smallest hashes of their ids (null ids last), ties by components; equal vectors can be several centroids, of
which the smaller number gets all. With fewer vectors than centroids there are as many centroids as vectors. Rows that repeat an id count and are
returned each for itself. An empty table gives no rows. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, discard, settle

K, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
#: Centroids a vector is measured against before it walks.
STARTS = 4
#: Groups that tasks' sums are first added in.
LANES = 64
LONG = 1 << 63


def _ints(values: list[list[int]]) -> np.ndarray:
    """A matrix of whole numbers: 64 bits wide if squared distances between its rows and like ones fit, else objects."""
    most = max((abs(x) for row in values for x in row), default=0)
    width = len(values[0]) if values else 1
    return np.array(values, np.int64 if width * (2 * most) ** 2 < LONG else object).reshape(len(values), -1)


class Orchard:
    """Centroids with their neighbour lists."""

    def __init__(self, centroids: list[list[int]], starts: int = STARTS):
        self.centroids = _ints(centroids)
        k = len(centroids)
        between = self._between(self.centroids, self.centroids)
        # nearest first, ties by number; a centroid's own place is dropped
        self.order = np.array([[j for j in sorted(range(k), key=lambda j: (between[i, j], j)) if j != i] for i in range(k)], np.int64).reshape(k, max(k - 1, 0))
        self.far = np.take_along_axis(between, self.order, 1)
        # starts that are far apart: each the farthest from those before
        self.starts = [0]
        near = between[0].copy()
        while len(self.starts) < min(starts, k):
            self.starts.append(max(range(k), key=lambda j: (near[j], -j)))
            near = np.minimum(near, between[self.starts[-1]])
        self.measured = 0

    @staticmethod
    def _between(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.stack([((x - row) ** 2).sum(1) for row in y], 1) if len(y) else np.zeros((len(x), 0), x.dtype)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each vector's nearest centroid and the squared distance."""
        if object in (vectors.dtype, self.centroids.dtype):
            vectors = vectors.astype(object)
        n, k = len(vectors), len(self.centroids)
        seen = np.zeros((n, k), bool)
        seen[:, self.starts] = True
        start = self._between(vectors, self.centroids[self.starts])
        self.measured += start.size
        rank = np.argsort(self.starts)
        best = rank[start[:, rank].argmin(1)]  # ties: the smaller number
        current, distance = np.array(self.starts)[best], start[np.arange(n), best]
        place = np.zeros(n, np.int64)
        rows = np.arange(n if k > 1 else 0)
        while len(rows):
            at = current[rows]
            going = self.far[at, place[rows]] <= 4 * distance[rows]  # squares of twice the distance
            rows, at = rows[going], at[going]
            other = self.order[at, place[rows]]
            place[rows] += 1
            new = ~seen[rows, other]
            met, to = rows[new], other[new]
            seen[met, to] = True
            self.measured += len(met)
            found = ((vectors[met] - self.centroids[to]) ** 2).sum(1)
            nearer = (found < distance[met]) | ((found == distance[met]) & (to < current[met]))
            jump = met[nearer]
            current[jump], distance[jump], place[jump] = to[nearer], found[nearer], 0
            rows = rows[place[rows] < k - 1]
        return current, distance


def _vectors(column: pa.Array) -> np.ndarray:
    """Vectors of whole numbers in doubles, as they are held exactly."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = len(flat) // len(column)
    if np.abs(flat).max() < float(1 << 28) / width**0.5:
        return flat.astype(np.int64).reshape(len(column), -1)
    return np.array([int(x) for x in flat], object).reshape(len(column), -1)


_SUMS = "cluster int, lane int, n long, sums array<string>"
_SUM_NAMES = ["cluster", "lane", "n", "sums"]


def _sums(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, n, sums) of every cluster that has vectors; sums are whole numbers in decimal."""

    def run(batches):
        from pyspark import TaskContext

        search = None
        n, sums = [0] * len(centroids), [None] * len(centroids)
        for batch in batches:
            if not batch.num_rows:
                continue
            search = search or Orchard(centroids)
            x = _vectors(batch.column(0))
            cluster, _ = search.nearest(x)
            for c in np.unique(cluster).tolist():
                own = x[cluster == c]
                n[c] += len(own)
                # sums of a batch fit where its distances did; sums of a task are Python's
                new = [int(v) for v in own.sum(0)]
                sums[c] = new if sums[c] is None else [a + b for a, b in zip(sums[c], new, strict=True)]
        held = [c for c, m in enumerate(n) if m]
        lane = TaskContext.get().partitionId() % LANES
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([lane] * len(held), pa.int32()), pa.array([n[c] for c in held], pa.int64()), pa.array([[str(v) for v in sums[c]] for c in held], pa.list_(pa.string()))], names=_SUM_NAMES)

    def add(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        sums = [str(sum(int(r["sums"][i]) for r in rows)) for i in range(len(rows[0]["sums"]))]
        return pa.table({"cluster": group["cluster"][:1], "lane": group["lane"][:1], "n": pa.array([sum(r["n"] for r in rows)], pa.int64()), "sums": pa.array([sums], pa.list_(pa.string()))})

    tasks = bound_batches(rows.select("vector")).mapInArrow(run, _SUMS)
    lanes = tasks.groupBy("cluster", "lane").applyInArrow(add, _SUMS)
    return lanes.groupBy("cluster").applyInArrow(add, _SUMS).select("cluster", "n", "sums")


def _assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance in decimal) of every vector."""

    def run(batches):
        search = None
        for batch in batches:
            if not batch.num_rows:
                continue
            search = search or Orchard(centroids)
            cluster, distance = search.nearest(_vectors(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array([str(d) for d in distance.tolist()])], names=["vec_id", "cluster", "distance"])

    return bound_batches(rows.select("vec_id", "vector")).mapInArrow(run, "vec_id long, cluster int, distance string")


def cluster_vectors(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 after ``rounds`` rounds."""
    x = F.col("raw")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("raw"))
    rows = rows.where(x.isNotNull() & (F.size(x) == dimensions) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    # SQL's floor gives longs; doubles beyond 2^53 are whole as they are
    whole = F.transform(x, lambda v: F.when(F.abs(v * scale) < float(1 << 53), F.floor(v * scale).cast("double")).otherwise(v * scale))
    rows = settle(rows.select("vec_id", whole.alias("vector")), "vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(hashed.asc_nulls_last(), "vector").limit(k).collect()
    centroids = [[int(v) for v in r.vector] for r in first]
    for _ in range(rounds if centroids else 0):
        for r in _sums(rows, centroids).collect():  # one row a centroid at most
            centroids[r.cluster] = [int(v) // r.n for v in r.sums]
    found = settle(_assigned(rows, centroids), "assigned")
    discard(rows)
    digests = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    of_cluster = found.groupBy("cluster").agg(F.try_sum(F.expr("try_cast(distance as decimal(38, 0))")).alias("far"), F.count_if(F.expr("try_cast(distance as decimal(38, 0)) is null")).alias("beyond"))
    far = F.when(F.col("beyond") == 0, F.col("far"))
    of_cluster = of_cluster.select("cluster", far.alias("far"))
    total = of_cluster.agg(F.when(F.count("far") == F.count(F.lit(1)), F.try_sum("far")).alias("all_far"))
    named = found.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # one row a centroid on the right side
    side = of_cluster.crossJoin(total).join(named, "cluster")
    return found.join(F.broadcast(side), "cluster").select(
        "vec_id",
        "cluster",
        F.expr("try_cast(distance as bigint)").alias("distance"),
        F.expr("try_cast(far as bigint)").alias("cluster_inertia"),
        F.expr("try_cast(all_far as bigint)").alias("inertia"),
        "centroid_sha256",
    )


def _oracle() -> str:
    """The same rounds as common table expressions, one after another."""
    assigned = """a{r} AS (
  SELECT v.vec_id, v.pos, v.w, arg_min(c.c, (list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.c)) AS c,
    min(list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
  FROM v, c{r} c GROUP BY ALL
)"""
    moved = """s{r} AS (
  SELECT c, i, sum(CAST(w[i] AS HUGEINT)) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY c, i
), m{r} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM s{r} GROUP BY c
), c{n} AS (
  SELECT c.c, coalesce(m.w, c.w) AS w FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c
)"""
    steps = [x.format(r=r, n=r + 1) for r in range(ROUNDS) for x in (assigned, moved)] + [assigned.format(r=ROUNDS)]
    between = ",\n".join(steps).replace("GROUP BY ALL", "GROUP BY v.vec_id, v.pos, v.w")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS pos, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), w) - 1 AS c, w FROM v QUALIFY c < {K}
), {between.replace(" AS (", " AS MATERIALIZED (")}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.w, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.c
"""


ORACLE = _oracle()
