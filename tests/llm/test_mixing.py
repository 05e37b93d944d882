import random
import re
from collections import defaultdict

import pytest
from conftest import multiset
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakefold.llm import mixing
from lakefold.llm.queries import QUERIES

op5 = QUERIES["op5_mixing"]


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The rule as it is told: share by weight, stop at the cap, share the
    excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out = {s: 0.0 for s in order}
    left, live = share * sum(sizes.values()), list(order)
    while live and left > 1e-9:
        total = sum(weight[s] for s in live)
        for s in live:
            out[s] += left * weight[s] / total
        left = sum(max(0.0, out[s] - most * sizes[s]) for s in live)
        for s in live:
            out[s] = min(out[s], most * sizes[s])
        live = [s for s in live if out[s] < most * sizes[s] - 1e-9]
    return out


def check(got, source):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert multiset((r.doc_id, r.size) for r in got) == multiset((d, size(t)) for d, _, t in source)
    by_source = defaultdict(int)
    for _, s, t in source:
        by_source[s] += size(t)
    want = targets(by_source)
    source_of = {(d, size(t)): s for d, s, t in source}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = source_of[r.doc_id, r.size]
        assert r.source_size == by_source[s] and r.target == pytest.approx(want[s], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in by_source:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_whole_table(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    got = op5(spark, small_sf).collect()
    check(got, [(r.doc_id, r.source, r.text) for r in docs.collect()])
    assert multiset(map(tuple, op5(spark, small_sf).collect())) == multiset(map(tuple, got))


def test_edges(spark, edge_sf, edge_rows):
    check(op5(spark, edge_sf).collect(), [(r[0], r[3], r[1]) for r in edge_rows])


def test_empty(spark, empty_sf):
    assert op5(spark, empty_sf).collect() == []


def test_tree_over_many_groups_does_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    rows = [(i, ["a", "b", "c", None][min(3, rng.randint(0, 9))], rng.randint(0, 50), rng.randint(0, 10**6)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, content long")
    one = mixing.mix(df.coalesce(1), group_rows=16).collect()
    two = mixing.mix(df.repartition(7), group_rows=16).collect()
    assert multiset(one) == multiset(two) and len(one) == 3000
    by_source = defaultdict(int)
    for _, s, n, _ in rows:
        by_source[s] += n
    want = targets(by_source)
    for s in by_source:
        taken = sum(r.size * (r.n * r.base + r.n_more) for r in one if r.source == s)
        assert abs(taken - want[s]) <= 50


def test_repeated_rows_share_their_copies(spark):
    df = spark.createDataFrame([(1, "a", 10, 5)] * 7 + [(2, "b", 30, 6)], "doc_id long, source string, size long, content long")
    out = {r.doc_id: r for r in mixing.mix(df).collect()}
    assert out[1].n == 7 and 0 <= out[1].n_more <= 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.floats(0, 1)), max_size=40), st.integers(0, 10**6))
def test_pivot_keeps_the_words(units, seed):
    out, held, f = mixing.pivot(units, random.Random(seed))
    before = sum(s * g for s, g in units if s and 0 < g < 1)
    after = sum(s * o for (s, g), o in zip(units, out) if o is not None and s and 0 < g < 1)
    after += units[held][0] * f if held is not None else 0
    assert after == pytest.approx(before, abs=1e-6)
    assert sum(o is None for o in out) == (held is not None)


def test_pivot_is_unbiased():
    units = [(5, 0.3), (9, 0.6), (2, 0.25), (14, 0.5)]
    taken = [0] * len(units)
    for seed in range(4000):
        rng = random.Random(seed)
        out, held, f = mixing.pivot(units, rng)
        if held is not None:
            out[held] = int(rng.random() < f)
        taken = [a + b for a, b in zip(taken, out)]
    assert [t / 4000 for t in taken] == pytest.approx([g for _, g in units], abs=0.04)


def test_mixed_documents_keep_rows_and_columns(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = out.select(F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    want = sum(r.taken for r in op5(spark, edge_sf).collect())
    assert taken == want
    assert out.exceptAll(docs.unionAll(docs)).isEmpty()  # nothing more than twice


def test_a_third_of_equal_rows(spark, monkeypatch):
    """Equal rows, and rows that differ in a further column only, appear as
    often as the mix takes their unit."""
    from collections import Counter

    monkeypatch.setattr(mixing, "RUN", 7)
    rows = [(5, "one two three", "a", "x")] * 200 + [(5, "one two three", "a", "y")] * 50
    rows += [(i, f"w{i} " * (1 + i % 9), "ab"[i % 2], "z") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string").repartition(6)
    out = Counter(map(tuple, mixing.mixed_documents(docs).collect()))
    units = {(u.doc_id, u.source, u.size): u for u in mixing.mix(mixing.stage(mixing.sized_documents(docs), "t5")).collect()}
    hot = units[5, "a", 3]
    assert (hot.n, out[rows[0]] + out[rows[200]]) == (250, 250 * hot.base + hot.n_more)
    for value, m in ((rows[0], 200), (rows[200], 50)):
        assert m * hot.base <= out[value] <= m * (hot.base + 1)
    for r in rows[250:]:
        u = units[r[0], r[2], len(r[1].split())]
        assert out[r] == u.base + u.n_more
    assert Counter(map(tuple, mixing.mixed_documents(docs.repartition(2)).collect())) == out
