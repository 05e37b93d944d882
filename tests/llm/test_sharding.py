import zlib
from collections import defaultdict

from conftest import multiset
from hypothesis import given, settings, strategies as st

from lakefold.llm import sharding
from lakefold.llm.queries import QUERIES

op1 = QUERIES["op1_sharding"]


def check(rows, source):
    want = sorted((repr(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in source)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and 0 <= r.shard < 8 and r.grown_shard is None
        held[r.shard].append(r)
    for own in held.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return [sum(r.size for r in held[s]) for s in range(8)]


def test_whole_table(spark, small_sf):
    source = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()]
    loads = check(op1(spark, small_sf).collect(), source)
    largest = max(len((t or "").encode()) for _, t in source)
    assert max(loads) - min(loads) <= max(0.02 * sum(loads) / 8, largest / 4)


def test_edges(spark, edge_sf, edge_rows):
    check(op1(spark, edge_sf).collect(), [r[:2] for r in edge_rows])


def test_a_third_of_equal_rows_is_spread(spark, tmp_path, monkeypatch):
    from conftest import write_tables

    monkeypatch.setattr(sharding, "COPIES", 1000)
    rows = [(7, "the same text " * 10, "en", "s", 1)] * 4000 + [(i, f"text {i} " * 12, "en", "s", 1) for i in range(8000)]
    loads = check(op1(spark, write_tables(spark, str(tmp_path), rows)).collect(), [r[:2] for r in rows])
    assert max(loads) - min(loads) < 0.01 * sum(loads) / 8


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame([(i // 3 % 5, f"t{i % 4}") for i in range(300)], "doc_id long, text string")
    one, many = (multiset(map(tuple, sharding.numbered_copies(df.repartition(n)).collect())) for n in (1, 9))
    assert one == many and len(one) == 300


def test_empty(spark, empty_sf):
    assert op1(spark, empty_sf).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(0, 63), st.integers(0, 1000)), st.integers(1, 7))
def test_rebalance_lowers_the_gap_and_moves_only_what_it_says(weights, n):
    before = sharding.even_map(64, n)
    after, moved = sharding.rebalance(before, weights, n)

    def gap(m):
        load = [sum(weights.get(s, 0) for s in range(64) if m[s] == k) for k in range(n)]
        return max(load) - min(load)

    assert gap(after) <= gap(before) and moved == sum(a != b for a, b in zip(before, after))
    assert all(before[s] == after[s] for s in range(64) if not weights.get(s))
    assert sharding.rebalance(after, weights, n)[1] == 0  # a balanced map stays


def test_map_versions(spark, tmp_path):
    m = sharding.SlotMap(spark, str(tmp_path / "map"), 16)
    m.write(0, sharding.even_map(16, 4))
    m.write(1, [0] * 16)
    assert m.shards(0) == [0, 1, 2, 3] * 4 and m.shards(1) == [0] * 16
