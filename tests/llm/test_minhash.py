import random
import re

import numpy as np
from conftest import multiset, words
from hypothesis import given, settings, strategies as st

from lakefold.llm import minhash as mh
from lakefold.llm.components import connected_components
from lakefold.llm.queries import QUERIES

op10 = QUERIES["op10_minhash"]


def slow_set(text, n):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, n=2, percent=80):
    """Rows (id, text): set size and smallest reachable id of each row."""
    sets = [slow_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = d if least.get(r) is None else min(least[r], d) if d is not None else least[r]
    brute.groups = [least[r] for r in {root(i) for i, s in enumerate(sets) if s}]
    return [(d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def check(got, rows):
    assert multiset((r.doc_id, r.n_shingles, r.component_id) for r in got) == multiset(brute(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def near_copies(n, seed=0):
    """Chains and clouds around the threshold, copies, one large group."""
    rng = random.Random(seed)
    out = []
    for g in range(n):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 20, 60, 200]))]
        for _ in range(60 if g == 0 else rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 3000)}"
            out.append(" ".join(copy))
            if rng.random() < 0.3:
                base = copy  # a chain
    return out


def test_whole_table(spark, small_sf):
    check(op10(spark, small_sf).collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()])


def test_edges(spark, edge_sf, edge_rows):
    check(op10(spark, edge_sf).collect(), [r[:2] for r in edge_rows])


def test_empty(spark, empty_sf):
    assert op10(spark, empty_sf).collect() == []


def test_near_copies_against_all_pairs(spark):
    texts = near_copies(60)
    ids = random.Random(1).sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for n in (2, 5):
        got = mh.near_duplicates(df, n_words=n).collect()
        assert multiset((r.doc_id, r.n_shingles, r.component_id) for r in got) == multiset(brute(rows, n))


def test_deduplicated_keeps_one_of_each_group(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet")
    out = mh.deduplicated(docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, 5)
    kept = out.collect()
    assert sum(not slow_set(r.text, 5) for r in kept) == sum(n == 0 for _, n, _ in want)  # documents without words stay
    some = [r for r in kept if slow_set(r.text, 5)]
    assert multiset(r.doc_id for r in some) == multiset(brute.groups)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abAB \t\n\x0b\x1cé", max_size=30), min_size=1, max_size=6), st.integers(1, 5))
def test_shingle_sets(texts, n):
    sets = mh.shingle_sets(texts, n)
    slow = [slow_set(t, n) for t in texts]
    assert [len(sets.of(i)) for i in range(len(texts))] == [len(s) for s in slow]
    for i in range(len(texts)):
        assert (np.diff(sets.of(i).astype(object)) > 0).all()
        for j in range(i):
            assert len(np.intersect1d(sets.of(i), sets.of(j))) == len(slow[i] & slow[j])


def test_sketches_rule_out_no_pair_at_the_threshold():
    rng = np.random.default_rng(5)
    for size in (1, 3, 12, 60, 300, 3000, 30_000):
        errors, over = [], 0
        for _ in range(30):
            shared = int(np.ceil(size * 8 / 9))
            a = rng.integers(0, 2**64, size, dtype=np.uint64)
            b = np.r_[a[:shared], rng.integers(0, 2**64, size - shared, dtype=np.uint64)]
            sketch = mh.odd_sketches(mh.Sets(np.r_[a, b], np.array([0, size, 2 * size]))).view(np.uint64)
            bits = np.array([int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())])
            sizes = np.array([2 * size])
            errors.append(mh.similarity_estimate(bits, sizes)[0] - shared / (2 * size - shared))
            over += bool(bits[0] > mh.most_bits(sizes, 0.8)[0])
        assert not over
        if size <= 3000:
            assert max(map(abs, errors)) < 0.02
    far = mh.most_bits(np.array([600]), 0.8)[0]  # 300 and 300 shingles, 0.75 alike: ruled out
    assert far < 600 * 0.25 / 1.75


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(6)
    for size in (5, 40, 400, 4000):
        same = []
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            b = np.unique(np.r_[a[:int(size * 0.9)], rng.integers(0, 2**64, size - int(size * 0.9), dtype=np.uint64)])
            s = mh.samples(mh.Sets(np.r_[a, b], np.array([0, len(a), len(a) + len(b)])))
            same.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(same)) < 0.04


def test_connected_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(300, 340)] + [(7, 7)]
    rng.shuffle(edges)
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    assert {r.node: r.comp for r in got} == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
