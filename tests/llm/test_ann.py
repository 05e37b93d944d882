import math

import numpy as np
from conftest import write_tables
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakefold.llm import ann
from lakefold.llm.queries import QUERIES

op6 = QUERIES["op6_nearest"]


def brute(rows, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (q, x) in enumerate(ok):
        if q % 50:
            continue
        found = [(float(ann.cosines(x[None], y[None])[0]), i) for i, y in ok if i != q and len(y) == len(x)]
        found.sort(key=lambda f: (-f[0], f[1]))
        out += [(q, r, i, s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def test_whole_table(spark, small_sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op6(spark, small_sf).collect())) == brute(rows)


def test_edges(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(0)
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (50, [0.0, 0.0]), (100, [nan, 1.0]),
            (150, [inf, 1.0]), (200, [None, 1.0]), (250, [1.0, 2.0, 3.0]), (7, [3.0, 2.0, 1.0]), (None, [1.0, 1.0]),
            (300, [0.5, 0.5]), (8, [-1.0, 0.0]), (8, [-1.0, 0.0]), (350, [1e-30, 1e-30])]
    rows += [(1000 + i, [float(x) for x in rng.normal(size=2)]) for i in range(30)]
    rows += [(2000 + i, [1.0, 1.0]) for i in range(40)]  # one common vector, also a query's
    folder = write_tables(spark, str(tmp_path), [], embeddings=[(i, v, 0) for i, v in rows])
    stored = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted(map(tuple, op6(spark, folder).collect()))
    want = brute(stored)
    assert got == want
    assert [g[:3] for g in got if g[0] == 0][:2] == [(0, 1, 1), (0, 2, 2)]
    assert [g for g in got if g[0] == 250] == [(250, 1, 7, want[[w[0] for w in want].index(250)][3])]  # fewer than five


def test_empty(spark, empty_sf):
    assert op6(spark, empty_sf).collect() == []


def test_small_blocks_give_the_same(spark, small_sf):
    v = spark.read.parquet(f"{small_sf}/embeddings.parquet").select("vec_id", "embedding")
    a = ann.nearest(v, F.col("vec_id") % 25 == 0, k=3, block=37, query_block=4).drop("row").collect()
    b = ann.nearest(v, F.col("vec_id") % 25 == 0, k=3).drop("row").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_bounds_from_a_part_give_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ann, "PART", 1.0)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(400)]
    rows += [(1000 - i, [1.0, 2.0, 3.0]) for i in range(100)] + [(950, [1.0, 2.0, 3.0])] * 3  # ties, repeated ids
    rows += [(2000 + i, [1.0, float(i)]) for i in range(3)] + [(2100, None), (2150, [0.0, 0.0, 0.0])]  # fewer than k
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).write.parquet(str(tmp_path / "v"))
    v = spark.read.parquet(str(tmp_path / "v"))
    stored = [tuple(r) for r in v.collect()]
    found = ann.nearest(v, F.col("vec_id") % 50 == 0, k=4, block=16, query_block=5).drop("row").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute(stored, 4)


def test_vectors_are_not_multiplied_by_query_blocks(spark, small_sf):
    v = spark.read.parquet(f"{small_sf}/embeddings.parquet").select("vec_id", "embedding")
    plan = ann.nearest(v, F.col("vec_id") % 5 == 0, block=4, query_block=3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    assert plan.count("Exchange") == 1  # of what is found


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 2100), st.floats(1e-3, 1e3))
def test_no_pair_at_its_floor_is_passed_over(seed, dim, scale):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(4, dim)) * scale, rng.standard_t(2, size=(6, dim))
    x, y = np.vstack([x, y[:2] * 3]), np.vstack([y, x[:2], -x[:1]])
    q, v = ann.Queries.__new__(ann.Queries), ann.Held([(np.arange(len(y)), y, ann.quantise(y))])
    q.dim = dim
    q.code, q.scale, q.length, q.miss = (ann.quantise(x)[c] for c in ("code", "scale", "length", "miss"))
    for j in range(len(y)):
        floors = ann.cosines(x, np.repeat(y[j:j + 1], len(x), axis=0))
        assert (np.matmul(q.wide(floors), v.wide[j]) >= 0).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 70), st.floats(1e-3, 1e3))
def test_bounds_hold(seed, dim, scale):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(5, dim)) * scale, rng.standard_t(2, size=(7, dim))
    p, q = ann.quantise(x), ann.quantise(y)
    approx = ann.int8_products(p["code"], q["code"]) * p["scale"][:, None] * q["scale"][None]
    bound = p["miss"][:, None] * q["length"][None] + q["miss"][None] + ann.SLACK
    exact = np.array([[ann.cosines(a[None], b[None])[0] for b in y] for a in x])
    assert (np.abs(exact - approx) <= bound).all()
