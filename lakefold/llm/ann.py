"""Nearest neighbours by a block matrix product of int8 codes.

Vectors are scaled to length 1, quantised to int8 with a scale of their own
and held in blocks.  The int8 product of a block of queries and a block of
vectors gives all cosines of the tile with an error bound from the two
quantisation residuals:

    |u.v - s t p.q|  <=  |u - s p| |t q| + |v - t q|      (u, v of length 1)

A pair survives if its upper bound reaches the k-th best score known for the
query; survivors are recomputed in double precision from the original vectors
and the k best kept, per task first and by query after one shuffle.  The
bounds hold for every pair, so the result equals brute force.

Scale: queries x rows work, in tiles of fixed size.  Vectors are not
shuffled: a task holds ``block`` of them at a time and reads the blocks of
queries past them from a shared folder, so what is written grows with the
queries and their results, not with queries x blocks.  In a large table a
part of the vectors meets the queries first: the k-th best score found there
bounds what the tasks of the whole table hand on.  ``vectors`` is read up to
three times and must give the same rows each time.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors meet only
vectors of their own length; ties go to the smaller id; of repeated rows
each is a candidate and a query of its own, and rows with the query's own id
are no candidates; fewer candidates than ``k`` give them all; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import read, scratch_path, stage
from .token_files import open_fs

#: Vectors that a task holds, and the components they have at most.
BLOCK, VALUES = 1 << 15, 1 << 22
QUERY_BLOCK = 512
#: Vectors of a tile; of the first one if a query has no bound yet.
TILE, FIRST = 1 << 10, 1 << 11
#: Survivors that are settled at once, and rescored at once.
PENDING, RESCORED = 1 << 16, 1 << 15
#: A table of so many blocks has bounds from a part of it first, this times
#: the root of a block's share of the table.
SEEDED, PART = 16, 0.25
#: Room for rounding in the double precision of the bounds themselves.
SLACK = 1e-9


def usable(vectors: pa.ListArray, kind: str, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, positions and components of the vectors without null or
    non-finite components that are not zero; up to ``most`` at once."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)  # null is NaN
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes[sizes > 0]).tolist():
        of_dim, step = np.flatnonzero(sizes == dim), min(most, max(1, (VALUES >> 2) // dim))
        for i in range(0, len(of_dim), step):
            at = of_dim[i:i + step]
            x = flat[starts[at][:, None] + np.arange(dim)]
            fine = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            if fine.any():
                yield dim, at[fine], x[fine]


def quantise(vectors: np.ndarray) -> dict[str, np.ndarray]:
    """int8 codes of the unit vectors, their scales, the lengths of the
    quantised vectors and of the residuals."""
    unit = vectors / np.max(np.abs(vectors), axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    scale = np.abs(unit).max(axis=1) / 127.0
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    back = code * scale[:, None]
    return {"code": code, "scale": scale, "length": np.sqrt((back * back).sum(axis=1)),
            "miss": np.sqrt(((unit - back) ** 2).sum(axis=1))}


def int8_products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: float32 holds sums of 1024 of them."""
    out = np.zeros((len(p), len(q)), np.float64)
    for i in range(0, p.shape[1], 1024):
        out += p[:, i:i + 1024].astype(np.float32) @ q[:, i:i + 1024].astype(np.float32).T
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, summed in order of the components."""
    dot = np.zeros(len(a))
    aa, bb = np.zeros(len(a)), np.zeros(len(a))
    for j in range(a.shape[1]):
        x, y = a[:, j], b[:, j]
        dot += x * y
        aa += x * x
        bb += y * y
    return dot / np.sqrt(aa * bb)


class Queries:
    """A row of ``pack_queries``."""

    def __init__(self, row: dict, kind: str):
        self.dim = row["dim"].as_py()
        self.ids, self.rows, self.floor_ids = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("ids", "rows", "floor_ids"))
        self.vectors = np.frombuffer(row["vectors"].as_buffer(), kind).reshape(-1, self.dim)
        self.code = np.frombuffer(row["codes"].as_buffer(), np.int8).reshape(-1, self.dim)
        self.scale, self.length, self.miss, self.floors = np.frombuffer(row["bounds"].as_buffer(), np.float64).reshape(4, -1)

    def wide(self, floors: np.ndarray) -> np.ndarray:
        """Codes and what the bounds add: a product with ``Held.wide`` is
        positive or 0 if an upper bound reaches the floor.  Products are summed
        in float32, so the floor is lowered by more than their rounding."""
        rounding = (self.dim + 16) * 2.0 ** -21
        least = np.maximum(floors, -4.0) - SLACK - rounding
        return np.column_stack([self.code, self.miss / self.scale, 1 / self.scale, -least / self.scale]).astype(np.float32)


class Held:
    """Vectors of one length that a task holds."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, dict]]):
        self.ids, self.vectors = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        self.code, self.scale, self.length, self.miss = (
            np.concatenate([p[2][c] for p in parts]) for c in ("code", "scale", "length", "miss"))
        self.wide = np.column_stack([self.code, self.length / self.scale, self.miss / self.scale, 1 / self.scale]).astype(np.float32)


PACKED = "dim int, ids binary, rows binary, vectors binary, codes binary, bounds binary, floor_ids binary"


def pack_queries(queries: DataFrame, kind: str, size: int) -> DataFrame:
    """``vec_id``, ``embedding``, ``row``, ``floor``, ``floor_id`` in blocks:
    a row has up to ``size`` queries of one length, as binary columns."""

    def packed(dim: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, rows, x, floors, floor_ids = (np.concatenate(c) for c in zip(*parts))
        q = quantise(x.astype(np.float64))
        bounds = np.stack([q["scale"], q["length"], q["miss"], floors])
        return pa.RecordBatch.from_pydict(
            {"dim": pa.array([dim], pa.int32())}
            | {c: pa.array([a.tobytes()], pa.binary()) for c, a in (
                ("ids", ids), ("rows", rows), ("vectors", x), ("codes", q["code"]), ("bounds", bounds), ("floor_ids", floor_ids))})

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            ids, rows, floors, floor_ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "row", "floor", "floor_id"))
            for dim, at, x in usable(batch.column("embedding"), kind, size):
                parts = held.setdefault(dim, [])
                if sum(len(p[0]) for p in parts) + len(at) > max(1, min(size, VALUES // dim)) and parts:
                    yield packed(dim, held.pop(dim))
                    parts = held.setdefault(dim, [])
                parts.append((ids[at].astype(np.int64), rows[at], x, floors[at], floor_ids[at]))
        for dim, parts in held.items():
            yield packed(dim, parts)

    return queries.mapInArrow(run, PACKED)


def read_queries(folder: str, kind: str) -> Iterator[Queries]:
    """The blocks of a folder, one at a time."""
    from pyarrow import fs

    filesystem, root = open_fs(folder)
    for info in filesystem.get_file_info(fs.FileSelector(root)):
        if info.is_file and info.base_name.endswith(".parquet"):
            with filesystem.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=1):
                    for i in range(batch.num_rows):
                        yield Queries({c: batch.column(c)[i] for c in batch.schema.names}, kind)


def reached(q: Queries, v: Held, k: int) -> np.ndarray:
    """Per query, a score that k pairs with the first vectors reach."""
    code, scale, length, miss, ids = (x[:FIRST] for x in (v.code, v.scale, v.length, v.miss, v.ids))
    if len(ids) < k:
        return np.full(len(q.ids), -np.inf)
    low = int8_products(q.code, code) * q.scale[:, None] * scale[None, :]
    low -= q.miss[:, None] * length[None, :] + miss[None, :] + SLACK
    low[q.ids[:, None] == ids[None, :]] = -np.inf
    return -np.partition(-low, k - 1, axis=1)[:, k - 1]


def first_of(k: int, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k best of each query, the smaller id first, and their ranks."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    nth = np.arange(len(query)) - np.searchsorted(query, query)
    return tuple(x[nth < k] for x in (query, ids, scores, nth))


def nearest_held(q: Queries, v: Held, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, ids and exact cosines of the pairs of two blocks that
    can be among the k nearest, up to k of a query."""
    floors = q.floors.copy()
    if np.isneginf(floors).any():
        floors = np.maximum(floors, reached(q, v, k))
    found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))

    def settle(qi: np.ndarray, vi: np.ndarray) -> None:
        nonlocal found
        for i in range(0, len(qi), RESCORED):
            a, b = qi[i:i + RESCORED], vi[i:i + RESCORED]
            other = q.ids[a] != v.ids[b]
            a, b = a[other], b[other]
            scores, ids = cosines(q.vectors[a].astype(np.float64), v.vectors[b].astype(np.float64)), v.ids[b]
            counts = (scores > q.floors[a]) | (scores == q.floors[a]) & (ids <= q.floor_ids[a])
            *found, nth = first_of(k, *(np.concatenate(x) for x in zip(found, (a[counts], ids[counts], scores[counts]))))
            last = nth == k - 1
            floors[found[0][last]] = np.maximum(floors[found[0][last]], found[2][last])

    n, left = len(q.ids), q.wide(floors)
    tile, pending, held = np.empty(n * TILE, np.float32), [], 0
    for i in range(0, len(v.ids), TILE):
        right = v.wide[i:i + TILE]
        upper = tile[:n * len(right)]
        np.matmul(left, right.T, out=upper.reshape(n, -1))
        qi, vi = np.divmod(np.flatnonzero(upper >= 0), len(right))
        pending.append((qi, vi + i))
        held += len(qi)
        if held >= PENDING or i + TILE >= len(v.ids):
            settle(*(np.concatenate(x) for x in zip(*pending)))
            left, pending, held = q.wide(floors), [], 0
    return found


FOUND = "row long, query_id long, rank int, vec_id long, score double"


def candidates(vectors: DataFrame, queries: DataFrame, kind: str, k: int, block: int, query_block: int) -> DataFrame:
    """The pairs that can be among the k nearest of a query, with ranks."""
    folder = scratch_path(vectors.sparkSession, "ann-queries")
    pack_queries(queries, kind, query_block).write.parquet(folder, compression="none")

    def meet(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        blocks = {dim: Held(parts) for dim, parts in held.items()}
        for q in read_queries(folder, kind) if blocks else ():
            if q.dim in blocks:
                qi, ids, scores = nearest_held(q, blocks[q.dim], k)
                if len(qi):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q.rows[qi], q.ids[qi], ids, scores)],
                                                     ["row", "query_id", "vec_id", "score"])

    def search(batches) -> Iterator[pa.RecordBatch]:
        held, rows, values = {}, 0, 0
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for dim, at, x in usable(batch.column("embedding"), kind, block):
                held.setdefault(dim, []).append((ids[at], x, quantise(x.astype(np.float64))))
                rows, values = rows + len(at), values + x.size
                if rows >= block or values >= VALUES:
                    yield from meet(held)
                    held, rows, values = {}, 0, 0
        yield from meet(held)

    found = vectors.mapInArrow(search, "row long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("row", "query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest of each query row of ``vec_id``, ``embedding``."""
    whole = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "f4" if whole else "f8"
    named = vectors.filter(F.col("vec_id").isNotNull())
    embedding = F.col("embedding") if whole else F.col("embedding").cast("array<double>")
    own = named.select("vec_id", embedding.alias("embedding"))
    queries = stage(named.filter(is_query).select("vec_id", embedding.alias("embedding"), F.monotonically_increasing_id().alias("row"),
                                                  F.lit(float("-inf")).alias("floor"), F.lit(0).cast("long").alias("floor_id")), "ann-query-rows")
    n = named.count()
    if n >= SEEDED * block:
        part = own.filter(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 20)) < int(sqrt(block / n) * PART * (1 << 20)))
        floors = (candidates(part.repartition(int(sqrt(n / block))), queries, kind, k, block, query_block).filter(F.col("rank") == k)
                  .select("row", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id")))
        queries = queries.drop("floor", "floor_id").join(floors, "row", "left").select(
            "vec_id", "embedding", "row", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"),
            F.coalesce("floor_id", F.lit(0)).cast("long").alias("floor_id"))
    return candidates(own, queries, kind, k, block, query_block)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda x, y: x + y)
         / sqrt(list_reduce(list_transform(q.e, lambda x: x * x), lambda x, y: x + y)
                * list_reduce(list_transform(c.e, lambda x: x * x), lambda x, y: x + y)) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
