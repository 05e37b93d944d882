"""Every registered query of the library: no cartesian or nested-loop joins,
no Python evaluation, no round-robin shuffle and no size check through one
partition; a window over keys only behind a limit that cuts each task's rows
per key before the shuffle."""

import re

import pytest

from paths import SF_SMALL
from lakefold.operators import dedup
from lakefold.operators import merge as m
from lakefold.plans.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "RoundRobinPartitioning")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"
    assert plan.count("Window [") <= plan.count("WindowGroupLimit"), name
    # a global aggregate's partial results may meet in one partition, rows may not
    for line in plan.splitlines():
        assert "GlobalLimit" not in line, name


def two_tables(spark, tmp_dir):
    rows = [(None if i % 9 == 0 else i % 50, i, f"v{i}") for i in range(200)]
    for name, part in (("target", rows[:150]), ("source", rows[100:])):
        spark.createDataFrame(part, "k int, o int, v string").write.parquet(f"{tmp_dir}/{name}")
    return (spark.read.parquet(f"{tmp_dir}/{x}") for x in ("target", "source"))


MERGES = {
    "update_insert": lambda t, s: m.merge(t, s, ["k"], update=["v"], on_conflict="latest", order_by=["o"]),
    "insert_only": lambda t, s: m.insert_only(t, s, ["k"]),
    "delete": lambda t, s: m.delete_matched(t, s, ["k"]),
    "upsert": lambda t, s: m.upsert_latest(t, s, ["k"], order_by=["o"]),
    "conflicts": lambda t, s: m.merge_conflicts(t, s, ["k"]),
    "evolve": lambda t, s: m.merge(t, s.selectExpr("k", "o", "v", "o AS x"), ["k"], update="all", on_conflict="latest", order_by=["o"]),
    "purge": lambda t, s: dedup.purge_duplicates(t, s, ["k"]),
    "purge_latest": lambda t, s: dedup.purge_duplicates(t, s, ["k"], mode="keep_latest", order_by=["o"]),
}


@pytest.mark.parametrize("name", sorted(MERGES))
def test_merge_family_reads_each_input_three_times_at_most(spark, tmp_dir, name):
    t, s = two_tables(spark, tmp_dir)
    plan = plan_of(MERGES[name](t, s))
    for side in ("target", "source"):
        scans = len(re.findall(rf"FileScan parquet [^\n]*/{side}\b", plan))
        assert 1 <= scans <= 3, (name, side, scans)
    assert plan.count("Union") <= 1
