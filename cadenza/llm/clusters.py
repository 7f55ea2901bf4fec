"""Centroid clustering with Yinyang bounds, in exact integers.

Vectors of whole numbers meet k centroids in rounds of assignment and floor-mean update. Centroids are
cut into groups once, by a few rounds of clustering of the centroids themselves. A vector carries an
upper bound of the distance to its own centroid and one lower bound per group of the distance to that
group's other centroids. A round moves the bounds by how far centroids moved and filters globally (own
bound below every group's bound: nothing to do), then by group (own distance below the group's bound:
the group can't win), and scans the groups that are left exactly. Bounds are floats moved outwards by
more than their rounding, and equal bounds never filter, so ties are decided by whole-number distances
and centroid numbers alone.

A round is one pass over a written table and one aggregation of k rows of sums; the driver holds the k
centroids only.

Defined results: vectors that are null, of another length or with a null or non-finite component are
left out; whole numbers beyond +-2^27, whose squared distances could leave 64 bits, count as +-2^27;
repeated rows are vectors of their own, and of equal vec_id the smaller vector comes first as a seed; a
vector without vec_id is clustered but never a seed; with fewer than k seeds there are as many
centroids as seeds, and with none no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, written

DIM, K, ROUNDS, SCALE, SEED = 64, 16, 3, 64, "1:"
LARGEST = 2**27
#: Bounds are widened by this share, far above what rounding of doubles can add up to in a few rounds.
SLACK = 1e-9
STATE = "vec_id long, vector array<int>, cluster int, upper double, lower array<double>"


def whole_vectors(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector array<int>): floor(scale * x) of every usable vector."""
    values = F.col("embedding").cast("array<double>")
    usable = (F.size(values) == dim) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(values, lambda x: F.greatest(F.least(F.floor(x * F.lit(float(scale))), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return embeddings.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"))


def seeds(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids: k rows, whatever the table."""
    name = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id is not null").select(name.alias("name"), "vector").orderBy("name", "vector").limit(k).collect()
    return np.array([r["vector"] for r in first], np.int64)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids, a centroid at a time."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = vectors - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def groups_of(centroids: np.ndarray, rounds: int = 5) -> list[np.ndarray]:
    """Centroid numbers cut into about k / 4 groups of near centroids."""
    k = len(centroids)
    t = max(1, -(-k // 4))
    centres = centroids[np.arange(t) * k // t].astype(float)
    nearest = np.zeros(k, np.int64)
    for _ in range(rounds):
        nearest = ((centroids[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        for g in range(t):
            if (nearest == g).any():
                centres[g] = centroids[nearest == g].mean(0)
    return [np.flatnonzero(nearest == g) for g in range(t) if (nearest == g).any()]


class Yinyang:
    """Assignment of a batch of vectors under bounds; the same centroids and groups for all batches of a round."""

    def __init__(self, centroids: np.ndarray, groups: list[np.ndarray]) -> None:
        self.centroids, self.groups = centroids, groups
        self.group_of = np.empty(len(centroids), np.int64)
        for g, members in enumerate(groups):
            self.group_of[members] = g

    def first(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cluster, upper, lower) of vectors without bounds."""
        far = squared(vectors, self.centroids)
        cluster = far.argmin(1)
        rows = np.arange(len(vectors))
        upper = np.sqrt(far[rows, cluster]) * (1 + SLACK)
        others = np.sqrt(far)
        others[rows, cluster] = np.inf
        lower = np.stack([others[:, members].min(1) for members in self.groups], 1) * (1 - SLACK)
        return cluster, upper, lower

    def moved(self, upper: np.ndarray, lower: np.ndarray, cluster: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds after centroids moved by ``drift``."""
        most = np.array([drift[members].max() for members in self.groups])
        return (upper + drift[cluster]) * (1 + SLACK), np.maximum(lower - most, 0) * (1 - SLACK)

    def again(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(cluster, upper, lower, distances computed) from moved bounds, which are changed in place."""
        open_rows = np.flatnonzero(upper >= lower.min(1))  # global filter
        if not len(open_rows):
            return cluster, upper, lower, 0
        mine = vectors[open_rows] - self.centroids[cluster[open_rows]]
        best = np.einsum("ij,ij->i", mine, mine)
        upper[open_rows] = np.sqrt(best) * (1 + SLACK)
        used = len(open_rows)
        still = upper[open_rows] >= lower[open_rows].min(1)  # the same filter with the tightened bound
        rows, best = open_rows[still], best[still]
        old, start = cluster[rows].copy(), np.sqrt(best)
        scans: list[tuple[int, np.ndarray, np.ndarray]] = []
        for g, members in enumerate(self.groups):
            picked = np.flatnonzero(start * (1 + SLACK) >= lower[rows, g])  # group filter
            if len(picked):
                scans.append((g, picked, squared(vectors[rows[picked]], self.centroids[members])))
                used += len(picked) * len(members)
        winner = old.copy()
        for g, picked, far in scans:
            members = self.groups[g]
            place = far.argmin(1)  # members ascend, so the first minimum has the smallest number
            near, number = far[np.arange(len(picked)), place], members[place]
            better = (near < best[picked]) | ((near == best[picked]) & (number < winner[picked]))
            best[picked[better]], winner[picked[better]] = near[better], number[better]
        # where the winner left its old group unscanned, the old centroid now bounds that group
        left = np.flatnonzero(winner != old)
        own = self.group_of[old[left]]
        lower[rows[left], own] = np.minimum(lower[rows[left], own], start[left] * (1 - SLACK))
        for g, picked, far in scans:
            members = self.groups[g]
            others = np.where(members[None, :] == winner[picked][:, None], np.inf, np.sqrt(far))
            lower[rows[picked], g] = others.min(1) * (1 - SLACK)
        cluster[rows], upper[rows] = winner, np.sqrt(best) * (1 + SLACK)
        return cluster, upper, lower, used


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1), kind))


def assigned(vectors: DataFrame, centroids: np.ndarray, groups: list[np.ndarray], drift: np.ndarray | None) -> DataFrame:
    """STATE rows after one assignment: of plain vectors if ``drift`` is None, else of STATE rows."""
    tool = Yinyang(centroids, groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"), np.int64)
            if drift is None:
                cluster, upper, lower = tool.first(x)
            else:
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                upper, lower = tool.moved(batch.column("upper").to_numpy(), _matrix(batch.column("lower"), float), cluster, drift)
                cluster, upper, lower, _ = tool.again(x, cluster, upper, lower)
            columns = [batch.column("vec_id"), batch.column("vector"), pa.array(cluster, pa.int32()), pa.array(upper), _lists(lower, pa.float64())]
            yield pa.record_batch(columns, names=["vec_id", "vector", "cluster", "upper", "lower"])

    return vectors.mapInArrow(run, STATE)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean per cluster; an empty one stays. k rows of sums reach the driver."""
    dim = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*(F.sum(F.col("vector")[i].cast("long")) for i in range(dim))).alias("sums"))
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    vectors = written(whole_vectors(embeddings, dim), "whole-vectors")
    centroids = seeds(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    groups = groups_of(centroids)
    state, drift = vectors, None
    for _ in range(rounds):
        state = written(assigned(state, centroids, groups, drift), "yinyang")
        after = means(state, centroids)
        drift = np.sqrt(((after - centroids).astype(float) ** 2).sum(1)) * (1 + SLACK)
        centroids = after
    known = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), c.tolist()) for j, c in enumerate(centroids)]
    named = F.broadcast(spark.createDataFrame(known, "cluster int, centroid_sha256 string, centre array<int>"))  # k rows
    final = assigned(state, centroids, groups, drift).select("vec_id", "vector", "cluster").join(named, "cluster")
    apart = F.aggregate(F.zip_with("vector", "centre", lambda a, b: (a.cast("long") - b) * (a.cast("long") - b)), F.lit(0).cast("long"), lambda s, x: s + x)
    found = written(final.select("vec_id", "cluster", apart.alias("distance"), "centroid_sha256"), "clustered")
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    whole = sum(r["cluster_inertia"] for r in by_cluster)
    sums = F.broadcast(spark.createDataFrame([(r["cluster"], r["cluster_inertia"], whole) for r in by_cluster] or [], "cluster int, cluster_inertia long, inertia long"))
    return found.join(sums, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """DuckDB: the same rounds with every distance computed."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
x{r} AS MATERIALIZED (SELECT row, (min({{'d': d, 'c': cluster}})).c AS cluster, min(d) AS distance FROM (
  SELECT v.row, c.cluster, list_sum(list_transform(range(1, {DIM} + 1), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT AS d FROM v, c{r} c) GROUP BY row)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (SELECT cluster, list(s ORDER BY i) AS q FROM (SELECT cluster, i, floor(sum(v.q[i]) / count(*))::BIGINT AS s FROM x{r} JOIN v USING (row), range(1, {DIM} + 1) t(i) GROUP BY cluster, i) GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{SEED}' || vec_id), q) - 1)::INT AS cluster, q FROM v WHERE vec_id IS NOT NULL ORDER BY sha256('{SEED}' || vec_id), q LIMIT {K}
), {",".join(steps)}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM x{ROUNDS} JOIN v USING (row) JOIN c{ROUNDS} c USING (cluster)
"""


ORACLE = _oracle()
