"""Offsets of a drained topic (S9, T3): what arrived, and what was lost.

Offsets of a (topic, partition) are kept as intervals.  The offsets of a
batch become intervals block by block, so a partition's messages never meet
in one task; only the intervals of its blocks do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets that are put together at a time.
BLOCK = 1 << 16
KEYS = ["topic", "partition"]


def offset_intervals(records: DataFrame) -> DataFrame:
    """``topic``, ``partition``, ``lo``, ``hi``: the runs of offsets among
    ``records`` (repeated offsets count once)."""
    blocks = (records.filter("offset IS NOT NULL").withColumn("__block", F.floor(F.col("offset") / BLOCK))
              .groupBy(*KEYS, "__block").agg(F.sort_array(F.collect_set("offset")).alias("o")))
    n = F.size("o")
    opens = F.filter("o", lambda x, i: (i == 0) | (x - F.get(F.col("o"), i - 1) > 1))
    closes = F.filter("o", lambda x, i: (i == n - 1) | (F.get(F.col("o"), i + 1) - x > 1))
    runs = blocks.select(*KEYS, F.explode(F.arrays_zip(opens.alias("lo"), closes.alias("hi"))).alias("r")).select(*KEYS, "r.lo", "r.hi")
    return merge_intervals(runs)


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals that touch or overlap as one."""
    order = Window.partitionBy(*KEYS).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("__new", (F.coalesce(F.col("lo") > reach + 1, F.lit(True))).cast("int"))
    numbered = marked.withColumn("__no", F.sum("__new").over(order))
    return numbered.groupBy(*KEYS, "__no").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__no")


def drain_report(intervals: DataFrame) -> DataFrame:
    """Per topic and partition: messages, first and last offset, how many
    offsets between them never came, and their ranges (``lo-hi``, in order,
    comma-joined)."""
    runs = intervals.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("r"))
    holes = F.filter(F.transform(F.sequence(F.lit(1), F.size("r") - 1), lambda i: F.struct(
        (F.get(F.col("r"), i - 1)["hi"] + 1).alias("lo"), (F.get(F.col("r"), i)["lo"] - 1).alias("hi"))), lambda h: h["lo"] <= h["hi"])
    lost = runs.select(*KEYS, "r", F.when(F.size("r") > 1, holes).otherwise(F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("l"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x["hi"] - x["lo"] + 1)
    return lost.select(
        *KEYS, total(F.col("r")).alias("n_messages"), F.element_at("r", 1)["lo"].alias("first_offset"),
        F.element_at("r", -1)["hi"].alias("last_offset"), total(F.col("l")).alias("n_lost"),
        F.array_join(F.transform("l", lambda h: F.concat(h["lo"].cast("string"), F.lit("-"), h["hi"].cast("string"))), ",").alias("lost_ranges"))
