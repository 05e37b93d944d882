"""Merge semantics (FIXTURES 8-18), properties, and plan shape."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakefold.operators import dedup
from lakefold.operators import merge as m
from lakefold.operators.hierarchy import label_hierarchy
from lakefold.session import stage
from test_skew import conf

KV = "k int, v string"


class Bag(list):
    """A list that compares equal to any ordering of the same rows."""

    def __eq__(self, other):
        return sorted(map(repr, self)) == sorted(map(repr, other))

    __hash__ = None


def rows(df, *cols):
    cols = cols or df.columns
    return Bag(tuple(r[c] for c in cols) for r in df.collect())


# -- hierarchy label ------------------------------------------------------------


def census(spark, data):
    return spark.createDataFrame(data, "PRD_DE date, C1 string, C1_NM string")


def test_hierarchy_label(spark):
    d = dt.date(2022, 11, 1)
    df = census(spark, [(d, "11", "Seoul"), (d, "11010", "Jongno"), (d, "2", "X"), (d, "26010", "Busan-gu")])
    out = label_hierarchy(df)
    assert out.columns == ["PRD_DE", "C1", "C1_NM", "C1_SIDO", "C1_NM_SIDO"]
    assert rows(out, "C1", "C1_NM_SIDO") == sorted(
        [("11", "Seoul"), ("11010", "Seoul"), ("2", None), ("26010", None)], key=repr
    )


def test_hierarchy_label_duplicate_top_fans_out(spark):
    d = dt.date(2022, 11, 1)
    df = census(spark, [(d, "11", "Seoul"), (d, "11", "Seoul-si"), (d, "11010", "Jongno")])
    out = label_hierarchy(df)
    assert out.filter(F.col("C1") == "11010").count() == 2
    assert out.count() == 6


def test_hierarchy_null_period_never_matches(spark):
    df = census(spark, [(None, "11", "Seoul"), (None, "11010", "Jongno")])
    assert rows(label_hierarchy(df), "C1", "C1_NM_SIDO") == [("11", None), ("11010", None)]


# -- merge ---------------------------------------------------------------------------


def test_update_insert(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    s = spark.createDataFrame([(2, "B", "Y"), (3, "c", "z")], "k int, v string, w string")
    out = m.update_insert(t, s, ["k"], update=["v"])
    assert rows(out) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "a")], KV)
    s = spark.createDataFrame([(None, "b")], KV)
    assert rows(m.update_insert(t, s, ["k"], update=["v"])) == [(None, "a"), (None, "b")]
    assert rows(m.merge(t, s, ["k"], update=["v"], null_keys="null_safe")) == [(None, "b")]
    assert rows(m.insert_only(t, s, ["k"], null_keys="drop")) == [(None, "a")]


def test_cardinality_error(spark):
    t = spark.createDataFrame([(2, "t")], KV)
    s = spark.createDataFrame([(2, "x"), (2, "y")], KV)
    out = m.update_insert(t, s, ["k"], update=["v"])
    with pytest.raises(m.MergeCardinalityError, match="k = 2"), m.cardinality_errors():
        out.collect()
    conflicts = m.merge_conflicts(t, s, ["k"])
    assert rows(conflicts) == [(2, 2)]


def test_cardinality_latest(spark):
    t = spark.createDataFrame([(2, "t", 0)], "k int, v string, o int")
    s = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "k int, v string, o int")
    out = m.merge(t, s, ["k"], update="all", on_conflict="latest", order_by=["o"])
    assert rows(out) == [(2, "y", 2)]


def test_unmatched_duplicates_all_inserted(spark):
    t = spark.createDataFrame([(1, "a")], KV)
    s = spark.createDataFrame([(9, "x"), (9, "y")], KV)
    assert rows(m.update_insert(t, s, ["k"], update=["v"])) == [(1, "a"), (9, "x"), (9, "y")]


def test_delete_matched(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], KV)
    s = spark.createDataFrame([(2, "z"), (None, "q")], KV)
    assert rows(m.delete_matched(t, s, ["k"])) == sorted([(None, "n"), (1, "a")], key=repr)


def test_when_newer_is_order_insensitive(spark):
    t = spark.createDataFrame([(1, "old", 5)], "k int, v string, o int")
    older = spark.createDataFrame([(1, "older", 3)], "k int, v string, o int")
    newer = spark.createDataFrame([(1, "new", 9)], "k int, v string, o int")
    kw = dict(update="all", insert="all", when_newer=["o"])
    a = m.merge(m.merge(t, older, ["k"], **kw), newer, ["k"], **kw)
    b = m.merge(m.merge(t, newer, ["k"], **kw), older, ["k"], **kw)
    assert rows(a) == rows(b) == [(1, "new", 9)]


def test_schema_evolution(spark):
    t = spark.createDataFrame([(1, "a")], KV)
    s = spark.createDataFrame([(2, "b", "x")], "k int, v string, extra string")
    out = m.insert_only(t, s, ["k"])
    assert out.columns == ["k", "v", "extra"]
    assert rows(out) == [(1, "a", None), (2, "b", "x")]
    with pytest.raises(ValueError):
        m.insert_only(t, s, ["k"], evolve=False)


def test_broadcast_path_equals_shuffle_path(spark):
    t = spark.range(0, 200).select((F.col("id") % 150).alias("k"), F.col("id").cast("string").alias("v"))
    s = spark.range(100, 260).select(F.col("id").alias("k"), F.lit("s").alias("v"))
    s = s.filter(F.col("k") % 3 != 0)
    kw = dict(update=["v"], insert="all", on_conflict="latest", order_by=["v"])
    a = rows(m.merge(t, s, ["k"], **kw))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        b = rows(m.merge(t, s, ["k"], **kw))
    assert a == b


def test_latest_keeps_null_keys_apart(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (1, "c", 1), (1, "d", None)], "k int, v string, o int")
    assert rows(m.latest_per_key(df, ["k"], ["o"])) == [(None, "a", 1), (None, "b", 2), (1, "c", 1)]
    assert rows(m.latest_per_key(df, ["k"], ["o"], group_nulls=True)) == [(None, "b", 2), (1, "c", 1)]


# -- purge (M5) and duplicates (W1) ------------------------------------------------------------


def test_purge_reference(spark):
    t = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "key string, v int")
    s = spark.createDataFrame([("k", 4)], "key string, v int")
    assert rows(dedup.purge_duplicates(t, s, ["key"])) == [("k", 4), ("m", 3)]


def test_purge_reference_key_absent_from_source(spark):
    t = spark.createDataFrame([("k", 1), ("k", 2)], "key string, v int")
    s = spark.createDataFrame([], "key string, v int")
    assert dedup.purge_duplicates(t, s, ["key"]).count() == 0


def test_purge_reference_of_wide_rows_settles_keys_first(spark):
    """With ``store``, rows are picked by stored keys and not shuffled whole;
    null key parts, repeated keys and repeated rows count as without."""
    t = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), (None, 1, "n"), (None, 1, "n"),
                               ("d", None, "n"), ("e", 2, "t")], "k string, l int, v string")
    s = spark.createDataFrame([("a", 1, "s"), ("a", 1, "s"), ("c", 1, "s"), ("c", 2, "s"), (None, 1, "s"), ("d", None, "s"), ("f", 1, "s")],
                              "k string, l int, v string")
    stored = []

    def store(df):
        stored.append(df.columns)
        return stage(df, "test-keys")

    for target, source in ((t, s), (t, t), (s.limit(0), s), (t, s.limit(0))):
        stored.clear()
        out = dedup.purge_duplicates(target, source, ["k", "l"], store=store)
        assert stored and not any("v" in columns for columns in stored)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("__mark") and all("__mark" not in line for line in plan.split("\n") if "SortMergeJoin" in line)
        plain = dedup.purge_duplicates(target, source, ["k", "l"])
        assert sorted(map(repr, out.collect())) == sorted(map(repr, plain.collect()))


def test_purge_keep_latest(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    t = spark.createDataFrame([("k", 1, d1), ("k", 2, d2)], "key string, v int, d date")
    s = spark.createDataFrame([("k", 4, d2)], "key string, v int, d date")
    out = dedup.purge_duplicates(t, s, ["key"], mode="keep_latest", order_by=["d"])
    assert rows(out) == [("k", 2, d2)]


def test_first_run_doubles_null_keys(spark):
    from lakefold.plans import datasets

    batch = spark.createDataFrame([("u1", "kw", 1), (None, "kw", 2)], "url string, keyword string, v int")
    out = m.insert_only(batch, batch, ["url", "keyword"])
    assert rows(out) == [(None, "kw", 2), (None, "kw", 2), ("u1", "kw", 1)]
    assert datasets.NEWS.merge_kind == "purge"


def test_duplicate_rows_matches_window(spark):
    data = [("a", 1, 5), ("a", 1, 5), ("a", 2, 4), ("b", 3, 1), ("c", 4, 2), ("c", 4, 2), (None, 5, 1), (None, 6, 2)]
    df = spark.createDataFrame(data, "key string, x int, o int")
    got = rows(dedup.duplicate_rows(df, ["key"], ["o"]))
    df.createOrReplaceTempView("dup_src")
    want = rows(spark.sql(
        "SELECT DISTINCT key, x, o FROM (SELECT *, row_number() OVER (PARTITION BY key "
        "ORDER BY o DESC, key DESC, x DESC) rn FROM dup_src) WHERE rn > 1"
    ))
    assert got == want == sorted([("a", 1, 5), ("a", 2, 4), ("c", 4, 2), (None, 5, 1)], key=repr)


# -- properties -------------------------------------------------------------------------------

keys = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 3)), max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def unique_by_key(pairs):
    seen = {}
    for k, v in pairs:
        seen.setdefault(k, v)
    return sorted(seen.items())


@SETTINGS
@given(t=keys, s=keys)
def test_merge_twice_equals_once(spark, t, s):
    tdf = spark.createDataFrame(unique_by_key(t), "k int, v int")
    sdf = spark.createDataFrame(unique_by_key(s), "k int, v int")
    once = m.update_insert(tdf, sdf, ["k"], update="all")
    twice = m.update_insert(once, sdf, ["k"], update="all")
    assert rows(once) == rows(twice)


@SETTINGS
@given(t=keys, s=keys)
def test_insert_only_keeps_target_and_counts(spark, t, s):
    tdf = spark.createDataFrame(unique_by_key(t), "k int, v int")
    sdf = spark.createDataFrame(s, "k int, v int")
    out = rows(m.insert_only(tdf, sdf, ["k"]))
    target_keys = {k for k, _ in unique_by_key(t)}
    unmatched = [r for r in s if r[0] not in target_keys]
    assert len(out) == len(unique_by_key(t)) + len(unmatched)
    for r in unique_by_key(t):
        assert r in out


@SETTINGS
@given(t=keys, s=keys)
def test_keep_latest_unique_keys(spark, t, s):
    tdf = spark.createDataFrame(t, "k int, v int")
    sdf = spark.createDataFrame(unique_by_key(s), "k int, v int")
    out = dedup.purge_duplicates(tdf, sdf, ["k"], mode="keep_latest", order_by=["v"])
    ks = [r["k"] for r in out.collect()]
    assert len(ks) == len(set(ks))


# -- plan shape ------------------------------------------------------------------------------------


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicate_rows_plan_has_no_window(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = plan_text(dedup.duplicate_rows(df, ["k"], ["v"]))
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_small_source_merge_does_not_shuffle_target(spark, tmp_dir):
    spark.range(5000).select(F.col("id").alias("k"), F.lit("t").alias("v")).write.parquet(tmp_dir + "/t")
    t = spark.read.parquet(tmp_dir + "/t")
    spark.createDataFrame([(1, "s"), (7000, "n")], "k long, v string").write.parquet(tmp_dir + "/s")
    s = spark.read.parquet(tmp_dir + "/s")  # as batches are staged: its size is known
    plan = plan_text(m.update_insert(t, s, ["k"], update=["v"]))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_column_order_preserved(spark):
    t = spark.createDataFrame([(1, "a", "k1"), (1, "b", "k1"), (2, "c", "k2")], "v int, w string, key string")
    s = spark.createDataFrame([(3, "d", "k1")], "v int, w string, key string")
    assert dedup.purge_duplicates(t, s, ["key"]).columns == ["v", "w", "key"]
    assert m.update_insert(t.filter("w != 'b'"), s, ["key"], update=["v"]).columns == ["v", "w", "key"]
    assert m.delete_matched(t, s, ["key"]).columns == ["v", "w", "key"]


def test_null_safe_duplicates_are_conflicts_or_reduced(spark):
    t = spark.createDataFrame([(None, "t", 0)], "k int, v string, o int")
    s = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "k int, v string, o int")
    with pytest.raises(Exception, match="several source rows .* k = null"):
        m.merge(t, s, ["k"], update=["v"], null_keys="null_safe").collect()
    out = m.merge(t, s, ["k"], update="all", null_keys="null_safe", on_conflict="latest", order_by=["o"])
    assert rows(out) == [(None, "y", 2)]


def test_guard_is_part_of_the_plan(spark):
    """No job runs while a guarded upsert is built, and its write is one job;
    a conflict still raises with its key, unmatched repeated keys do not."""
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    t = spark.createDataFrame([(i, f"t{i}") for i in range(50)], KV)
    s = spark.createDataFrame([(i, f"s{i}") for i in range(40, 60)] + [(77, "a"), (77, "b")], KV)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "-1")):
            spark.conf.set(k, v)
        sc.setJobGroup("guard-build", "")
        out = m.update_insert(t, s, ["k"], update=["v"])
        assert list(tracker.getJobIdsForGroup("guard-build")) == []
        sc.setJobGroup("guard-write", "")
        out.write.format("noop").mode("overwrite").save()
        assert len(tracker.getJobIdsForGroup("guard-write")) == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        sc._jsc.clearJobGroup()
    assert len(rows(out)) == 62 and (77, "a") in rows(out) and (45, "s45") in rows(out)
    with pytest.raises(Exception, match="several source rows match one target row for key k = 7"):
        m.update_insert(t, s.unionByName(s.selectExpr("7 AS k", "v")), ["k"], update=["v"]).collect()
