import itertools
import re
from collections import Counter

import duckdb
from conftest import multiset, write_tables

from lakefold.llm.filter_audit import ORACLE, op13_filter_audit, walk_orders

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(rows):
    """Letters that each row fails, by the definitions."""
    out = []
    for doc_id, text, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        if len(w) < 50:
            bad.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == t for o in rows):
            bad.add("E")
        out.append(frozenset(bad))
    return out


def brute(rows, labels):
    """Every order applied to every document, one filter after another."""
    good, toxic = ({i for i, *v in labels if i is not None and v[n] == 1} for n in (0, 1))
    docs = [(r[3] or "", bad, r[0] in good, r[0] in toxic) for r, bad in zip(rows, failures(rows))]
    out, shapley = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = own
            for step, f in enumerate(order, 1):
                fails = [d for d in own if f in d[1]]
                removed = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                shapley[part, f] += len(removed)
                out.append((part, order, step, len(alive), len(removed), len(fails) - len(removed),
                            sum(d[1] == {f} for d in own), sum(d[2] for d in removed), sum(d[3] for d in removed)))
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def as_tuples(df):
    return multiset(tuple(r) for r in df.select(*COLUMNS).collect())


def test_edge_documents_equal_brute_force(spark, edge_sf, edge_rows):
    labels = [(r[0], 0 if r[1] and "***" in r[1] else 1, 0) for r in edge_rows if r[0] is not None and r[1]]
    labels += [(3, None, 0), (None, 1, 0), (6, 1, 0), (6, 0, 0)]
    assert as_tuples(op13_filter_audit(spark, edge_sf)) == multiset(brute(edge_rows, labels))


def test_hot_text_and_repeated_rows(spark, tmp_path):
    hot = "THE same # text " * 30
    rows = [(i, hot, "en", "s1" if i % 3 else "s2", 1) for i in range(10, 90)]
    rows += [(10, hot, "en", "s2", 1)] * 7  # the first id, repeated and in another part: never a copy
    rows += [(i, f"only {i} " + " ".join(f"w{j}" for j in range(60)), "en", None, 1) for i in range(200, 240)]
    rows += [(None, hot, "en", "s1", 1), (None, None, "en", "", 1), (300, None, "en", "s3", 1), (301, "", "en", "s3", 1)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 320)] + [(12, 1, 1), (12, None, None), (None, 1, 1)]
    sf = write_tables(spark, str(tmp_path), rows, labels)
    assert as_tuples(op13_filter_audit(spark, sf)) == multiset(brute(rows, labels))


def test_rows_are_whole_and_typed(spark, small_sf):
    out = op13_filter_audit(spark, small_sf)
    parts = duckdb.sql(f"SELECT count(DISTINCT coalesce(source, '')) FROM '{small_sf}/documents.parquet'").fetchall()[0][0]
    assert out.count() == 600 * parts
    assert [t for _, t in out.dtypes] == ["string", "string", "int"] + ["bigint"] * 7


def test_sql_agrees_on_edges(spark, edge_sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{edge_sf}/{t}.parquet/*.parquet')")
    want = con.sql(ORACLE).to_arrow_table().select(COLUMNS).to_pylist()
    got = [dict(zip(COLUMNS, r)) for r in op13_filter_audit(spark, edge_sf).select(*COLUMNS).collect()]
    assert multiset(got) == multiset(want)


def test_walk_has_every_prefix_once_per_mask(spark):
    walk = walk_orders(spark, spark.createDataFrame([(0,), (21,)], "mask int")).collect()
    assert Counter(r.step for r in walk) == {1: 10, 2: 40, 3: 120, 4: 240, 5: 240}
    assert len({(r.prefix, r["mask"]) for r in walk}) == len(walk)


def test_empty_table(spark, empty_sf):
    out = op13_filter_audit(spark, empty_sf)
    assert out.count() == 0 and out.columns == COLUMNS
