import hashlib
import math
import random

import numpy as np
import pytest
from conftest import multiset, write_tables

from lakefold.llm import centroids
from lakefold.llm.centroids import CentroidLists, op11_centroids
from lakefold.llm.common import read


def brute(rows, dim=64, k=40, rounds=5):
    """The clustering by its definition, in Python's whole numbers."""
    def ok(v):
        return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if ok(v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(col) // len(own[n]) for col in zip(*own[n])] if n in own else c for n, c in enumerate(cents)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    per = {}
    for _, c, d in found:
        per[c] = per.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, c, d, per[c], sum(per.values()), digest[c]) for i, c, d in found]


def vectors(rng, n, dim=64):
    centers = [[rng.gauss(0, .3) for _ in range(dim)] for _ in range(12)]
    return [[x + rng.gauss(0, .1) for x in rng.choice(centers)] for _ in range(n)]


def edge_embeddings():
    rng = random.Random(3)
    vs = vectors(rng, 150)
    rows = [(i * 2, v, 1) for i, v in enumerate(vs)]
    rows += [rows[5]] * 60 + [(None, vs[9], 1), (None, vs[9], 1), (4, vs[70], 1)]  # repeated rows, null ids, a shared id
    bad = [None, [], vs[0][:63], vs[0] + [0.0], [None] + vs[0][1:], [float("nan")] + vs[0][1:], [float("inf")] + vs[0][1:]]
    rows += [(1000 + i, v, None) for i, v in enumerate(bad)]
    rows += [(2000 + i, [0.0] * 64, 0) for i in range(5)] + [(2100, [-0.001] * 64, 0)]
    return rows


def as_tuples(df):
    return multiset(tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


@pytest.mark.parametrize("rows", [edge_embeddings(), edge_embeddings()[:17]], ids=["more than k", "fewer than k"])
def test_query_equals_brute_force(spark, tmp_path, rows):
    sf = write_tables(spark, str(tmp_path), [], embeddings=rows)
    assert as_tuples(op11_centroids(spark, sf)) == multiset(brute(rows))


def test_any_partitioning_gives_the_same(spark, tmp_path):
    sf = write_tables(spark, str(tmp_path), [], embeddings=edge_embeddings())
    table = read(spark, sf, "embeddings", "vec_id", "embedding")
    one, many = (as_tuples(centroids.cluster(table.repartition(n), k=7, rounds=3)) for n in (1, 11))
    assert one == many


def test_empty_table(spark, empty_sf):
    out = op11_centroids(spark, empty_sf)
    assert out.count() == 0 and out.columns[0] == "vec_id"


def test_oversized_components_raise(spark, tmp_path):
    sf = write_tables(spark, str(tmp_path), [], embeddings=[(1, [1e9] * 64, 0)])
    with pytest.raises(Exception, match="would not fit"):
        op11_centroids(spark, sf).collect()


@pytest.mark.parametrize("dim,k,spread", [(64, 40, 60), (3, 200, 2000), (1, 5, 2), (8, 1, 9), (5, 33, centroids.LARGEST)])
def test_walk_finds_the_nearest_and_the_smaller_of_ties(dim, k, spread):
    rng = np.random.default_rng(k)
    cents, x = rng.integers(-spread, spread + 1, (k, dim)), rng.integers(-spread, spread + 1, (500, dim))
    number, distance, work = CentroidLists(cents).nearest(x)
    every = ((x[:, None, :] - cents[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert work <= every.size and (dim != 3 or work < every.size / 3)  # few dimensions: the bound stops the walk early


def test_tie_at_the_threshold_is_still_found():
    cents = np.array([[4, 0], [0, 4], [-4, 0], [0, -4], [9, 9]])
    assert CentroidLists(cents).nearest(np.array([[0, 0], [2, 2], [9, 9]]))[0].tolist() == [0, 0, 4]
    assert CentroidLists(np.array([[5], [1], [3], [3]])).nearest(np.array([[2], [3], [4]]))[0].tolist() == [1, 2, 0]
