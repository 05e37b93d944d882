"""Hot keys: one key holding a third of the rows.

The merge's matched-update join must be one AQE can split (a left outer
join, not a full outer join), and dedup must not need a window over the
hot group.
"""

import contextlib

from pyspark.sql import functions as F

from lakefold.operators import dedup
from lakefold.operators import merge as m

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_table(spark, n=90_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("v"),
    )


def test_merge_hot_target_key_is_split(spark):
    t = hot_table(spark)
    s = spark.range(0, 60_000, 2).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("seq"),
                                         F.lit("s").alias("v")).filter("k != 7")
    with conf(spark, SKEW_CONF):
        out = m.update_insert(t, s, ["k"], update=["v"])
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert "FullOuter" not in plan
    hot = [r for r in rows if r.k == 7]
    assert len(hot) == 30_001 and all(r.v != "s" for r in hot)
    assert len(rows) == 90_000 + len([k for k in range(0, 60_000, 2) if k != 7 and not (k % 3 and k < 90_000)])


def test_dedup_with_hot_key(spark):
    df = hot_table(spark)
    dups = dedup.duplicate_rows(df, ["k"], ["seq"])
    plan = dups._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    # the hot key (30,001 rows, id 7 included) keeps all rows but its latest one
    assert dups.count() == 30_001 - 1
    latest = m.latest_per_key(df, ["k"], ["seq"])
    # before the shuffle, every task keeps one row of the hot key
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()
    assert latest.filter("k = 7").first().seq == 89_997
    assert latest.count() == 60_000


def test_null_keys_are_spread(spark):
    """A third of the target without key: the rows do not share a partition."""
    t = spark.range(30_000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    s = spark.range(100).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    with conf(spark, {**SKEW_CONF, "spark.sql.adaptive.enabled": "false"}):
        out = m.merge(t, s, ["k"], update=["v"], insert=None)
        sizes = [r["count"] for r in out.filter("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 2_500
