"""Centroid clustering with the threshold algorithm.

Vectors are integers (``floor(256 * x)``), so distances, sums and means are
exact and any partitioning gives the same clusters.  For every dimension the
centroids' values lie in a sorted list.  A vector walks the lists outward
from its own value, a group of dimensions at a time: each step reads the
nearer of the two frontier entries of a list and, the first time a centroid
turns up, computes its exact distance.  The squared gaps to the frontiers,
summed over all lists, bound every centroid that has not turned up yet from
below; the walk stops when that sum strictly exceeds the best exact
distance (strictly, so that a tie with a smaller number is still found), or
when all centroids have turned up.  All vectors of a slice walk together in
numpy arrays, those that have stopped leave.

Scale: vectors are staged once as integers.  A round is one scan without a
shuffle of vectors: each task sends one row of sums per centroid, and the
driver gets ``k`` rows of ``dim`` sums, whatever the number of vectors.  No
cluster is ever gathered, so one cluster may hold all rows.  A task holds a
slice of ``SLICE_CELLS`` cells.

Defined results: null vectors and those of another length or with null or
non-finite components take no part; with fewer than ``k`` vectors all of them
are centroids; repeated rows and null ids take part like any row, null ids
start a centroid only after all others, ties of an id are ordered by the
vector; an empty table gives no rows; further columns are ignored.  A
component beyond ``LARGEST`` in size raises an error, since squared distances
would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read, stage

DIM, K, ROUNDS, SEED, SCALE = 64, 40, 5, "2:", 256
#: 64 squared differences of twice this size fit a long.
LARGEST = 1 << 27
#: Cells (vectors x the larger of dimensions and centroids) walked at a time.
SLICE_CELLS = 1 << 20
#: Lists that are read between two looks at the threshold.
LISTS = 8
#: Above every gap.
_FAR = np.int64(2 * LARGEST + 1)


class CentroidLists:
    """Centroids (k x dim) with a sorted list of their values per dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, np.int64)
        self.k, self.dim = self.centroids.shape
        order = np.argsort(self.centroids, axis=0, kind="stable")
        self.number = order.T  # dim x k: the centroid at each place of a list
        edge = np.full((self.dim, 1), _FAR)
        values = np.take_along_axis(self.centroids, order, 0).T
        self.values = np.hstack([-2 * edge, values, 2 * edge])  # beyond both ends nothing is near

    def _gaps(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, dims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared gaps to the frontier entries below and above."""
        below = np.minimum(x - self.values[dims, low], _FAR)
        above = np.minimum(self.values[dims, high] - x, _FAR)
        return below * below, above * above

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and the squared distance of each row
        of ``x`` (n x dim), and how many exact distances were computed."""
        number, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        work, step = 0, max(1, SLICE_CELLS // max(self.k, self.dim))
        for lo in range(0, len(x), step):
            part = slice(lo, lo + step)
            number[part], distance[part], n = self._walk(x[part])
            work += n
        return number, distance, work

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        dims = np.arange(self.dim)
        # places in ``values``; ``low`` is the last entry below or at x, ``high`` the next
        high = np.stack([np.searchsorted(self.values[d], x[:, d], "right") for d in dims], 1)
        low = high - 1
        below, above = self._gaps(x, low, high, dims)
        frontier = np.minimum(below, above)
        bound = frontier.sum(1)
        exact = np.full((len(x), self.k), np.iinfo(np.int64).max)
        best = np.full(len(x), np.iinfo(np.int64).max)
        row = np.arange(len(x))
        number, distance, work = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), 0
        while len(row):
            for first in range(0, self.dim, LISTS):
                own = dims[first:first + LISTS]
                a, b = below[:, own], above[:, own]
                down = a <= b
                place = np.where(down, low[:, own], high[:, own]) - 1
                inside = (place >= 0) & (place < self.k)
                found = self.number[own, np.clip(place, 0, self.k - 1)]
                at, lane = np.nonzero(inside)
                hit = np.zeros((len(row), self.k), bool)
                hit[at, found[at, lane]] = True
                at, c = np.nonzero(hit & (exact == np.iinfo(np.int64).max))
                diff = x[at] - self.centroids[c]
                exact[at, c] = np.einsum("ij,ij->i", diff, diff)
                work += len(at)
                best = exact.min(1)
                low[:, own] -= down & (low[:, own] > 0)
                high[:, own] += ~down & (high[:, own] <= self.k)
                below[:, own], above[:, own] = self._gaps(x[:, own], low[:, own], high[:, own], own)
                moved = np.minimum(below[:, own], above[:, own])
                bound += moved.sum(1) - frontier[:, own].sum(1)
                frontier[:, own] = moved
                stop = (bound > best) | (exact != np.iinfo(np.int64).max).all(1)
                if stop.any():
                    number[row[stop]] = exact[stop].argmin(1)  # the first of equals
                    distance[row[stop]] = best[stop]
                    go = ~stop
                    x, row, exact, best, bound = x[go], row[go], exact[go], best[go], bound[go]
                    low, high, below, above, frontier = low[go], high[go], below[go], above[go], frontier[go]
                    if not len(row):
                        break
        return number, distance, work


def _matrix(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(column)).flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM,
                    scale: int = SCALE) -> DataFrame:
    """The vectors that take part, as integers: the id and ``v``."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))))
    fits = F.forall(whole, lambda e: F.abs(e) <= F.lit(LARGEST))
    return table.filter((F.size(x) == dim) & finite).select(
        id_col, F.when(fits, whole.cast("array<int>")).otherwise(
            F.raise_error(F.lit(f"a component beyond {LARGEST}: squared distances would not fit a long"))).alias("v"))


def first_centroids(vectors: DataFrame, id_col: str = "vec_id", k: int = K, seed: str = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest digest of seed and id."""
    key = F.sha2(F.concat(F.lit(seed), F.col(id_col).cast("string")).cast("binary"), 256)
    rows = vectors.select("v", key.alias("key")).orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per task and centroid: ``cluster``, ``n`` and the ``sums`` of
    the vectors nearest to it."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            x = _matrix(batch, "v", dim)
            number = lists.nearest(x)[0]
            n += np.bincount(number, minlength=k)
            np.add.at(sums, number, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(some, pa.int32()), "n": pa.array(n[some], pa.int64()),
            "sums": pa.array(sums[some].tolist(), pa.list_(pa.int64()))})

    return vectors.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")


def moved_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floored mean of each centroid's vectors; a centroid
    without vectors stays."""
    dim = centroids.shape[1]
    sums = cluster_sums(vectors, centroids).groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(dim)]).alias("sums")).collect()
    moved = centroids.copy()
    for r in sums:  # at most k rows
        moved[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return moved


def assign(vectors: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """The id, ``cluster`` and squared ``distance`` of every vector."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        for batch in batches:
            number, distance, _ = lists.nearest(_matrix(batch, "v", dim))
            ids = batch.column(batch.schema.get_field_index(id_col))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array(distance, pa.int64())], [id_col, "cluster", "distance"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(id_col, "v").mapInArrow(run, f"`{id_col}` {kind}, cluster int, distance long")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, id_col: str = "vec_id", k: int = K, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """Centroids (at most k x dim) after the rounds; ``vectors`` is read once
    per round, so it should be a stored table."""
    centroids = first_centroids(vectors, id_col, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved_centroids(vectors, centroids)
    return centroids


def cluster(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, k: int = K,
            rounds: int = ROUNDS, seed: str = SEED, scale: int = SCALE) -> DataFrame:
    """The id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` of every vector that takes part."""
    spark = table.sparkSession
    vectors = stage(integer_vectors(table, id_col, vec_col, dim, scale), "centroid-vectors")
    centroids = fit(vectors, id_col, k, rounds, seed)
    if not len(centroids):
        centroids = np.zeros((1, dim), np.int64)  # no vectors, so no rows to assign
    found = stage(assign(vectors, centroids, id_col), "centroid-clusters")
    parts = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most k rows
    total = sum(r["cluster_inertia"] for r in parts)
    facts = [(r["cluster"], r["cluster_inertia"], total, centroid_digest(centroids[r["cluster"]])) for r in parts]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _oracle(rounds: int = ROUNDS) -> str:
    """Rounds written out one after another; ``i`` numbers the rows, so that
    repeated ids stay apart."""

    def nearest(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (SELECT i, c, dist FROM
    (SELECT p.i, m.c, CAST(sum((p.x - m.x) * (p.x - m.x)) AS BIGINT) AS dist FROM parts p JOIN c{n} m ON p.d = m.d GROUP BY p.i, m.c)
    QUALIFY row_number() OVER (PARTITION BY i ORDER BY dist, c) = 1)"""

    def mean(n: int) -> str:
        return f"""s{n} AS MATERIALIZED (SELECT a.c, p.d, CAST(floor_div(sum(p.x), count(*)) AS BIGINT) AS x
    FROM a{n - 1} a JOIN parts p ON a.i = p.i GROUP BY a.c, p.d),
c{n} AS MATERIALIZED (SELECT m.c, m.d, coalesce(s.x, m.x) AS x FROM c{n - 1} m LEFT JOIN s{n} s ON m.c = s.c AND m.d = s.d)"""

    def floored(sql: str) -> str:  # exact floor of a quotient of whole numbers
        return sql.replace("floor_div(sum(p.x), count(*))",
                           "(sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*)")

    steps = [nearest(0)]
    for n in range(1, rounds + 1):
        steps += [floored(mean(n)), nearest(n)]
    every = ",\n".join(steps)
    return f"""WITH rows AS (SELECT row_number() OVER () AS i, vec_id, embedding FROM embeddings),
kept AS MATERIALIZED (SELECT i, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
    FROM rows WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIM}),
parts AS MATERIALIZED (SELECT i, unnest(v) AS x, unnest(range({DIM})) AS d FROM kept),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, unnest(range({DIM})) AS d FROM
    (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c FROM kept)
    WHERE c < {K}),
{every}
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, a.dist AS distance,
    CAST(sum(a.dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia,
    h.centroid_sha256
FROM a{rounds} a JOIN kept k ON a.i = k.i
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON a.c = h.c"""


ORACLE = _oracle()
