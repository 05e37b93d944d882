"""Compaction of small files (K2).

Small files of a partition are packed into bins of a target size (first fit,
largest first) and each bin is written as one file; files above the limit
are neither read nor renamed.  Sizes come from the listing, the reader skips
large files by their size, and one task writes one bin.

New files are written aside; the table's state then names the exchange,
new files are moved in and the old ones deleted.  A job that dies in between
leaves the exchange in the state, and the table's next change (or
``recover``) completes it.  While files are exchanged a reader may see rows of both; there
is one writer at a time, as for every change of a Silver table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.session import plain_path, stage, staging
from lakefold.sources.silver import SilverTable

#: Fixed value: the target file size of the Silver tables.
TARGET_BYTES = 104_857_600
#: Files of a partition that are packed by one fold.
GROUP_FILES = 2048


def table_files(table: SilverTable) -> DataFrame:
    """``path``, ``folder`` (of the partition, below the table's) and
    ``bytes`` of every data file."""
    root = table.location()
    listed = table.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    below = F.substring_index("path", f"{root.rsplit('/', 1)[-1]}/", -1)
    return listed.select("path", F.regexp_extract(below, "^(.*)/[^/]*$", 1).alias("folder"), F.col("length").alias("bytes"))


def _first_fit(files: Column, target: int) -> Column:
    """Bins of (bytes, path), which come largest first."""
    empty = F.array().cast("array<struct<used:bigint,paths:array<string>>>")

    def put(bins: Column, f: Column) -> Column:
        at = F.array_position(F.transform(bins, lambda b: b["used"] + f["bytes"] <= target), True)
        grown = F.transform(bins, lambda b, i: F.when(i + 1 == at, F.struct(
            (b["used"] + f["bytes"]).alias("used"), F.array_append(b["paths"], f["path"]).alias("paths"))).otherwise(b))
        new = F.struct(f["bytes"].alias("used"), F.array(f["path"]).alias("paths"))
        return F.when(at > 0, grown).otherwise(F.array_append(bins, new)).cast("array<struct<used:bigint,paths:array<string>>>")

    return F.aggregate(files, empty, put)


def plan_bins(files: DataFrame, target_bytes: int, small_bytes: int) -> DataFrame:
    """``path`` and ``bin`` (from 0) of the files to rewrite: bins with at
    least two files."""
    small = files.filter(F.col("bytes") < small_bytes)
    counts = small.groupBy("folder").agg(F.count(F.lit(1)).alias("n"))
    grouped = small.join(counts, "folder").withColumn(
        "g", F.pmod(F.xxhash64("path"), F.ceil(F.col("n") / GROUP_FILES))).groupBy("folder", "g").agg(
        F.sort_array(F.collect_list(F.struct("bytes", "path")), asc=False).alias("f"))
    bins = (grouped.select("folder", "g", F.posexplode(_first_fit(F.col("f"), target_bytes)).alias("i", "b"))
            .filter(F.size("b.paths") > 1).select("folder", "g", "i", "b.paths"))
    numbered = bins.withColumn("bin", F.row_number().over(Window.orderBy("folder", "g", "i")) - 1)  # a row per new file
    return numbered.select(F.explode("paths").alias("path"), "bin")


def compact(table: SilverTable, target_bytes: int = TARGET_BYTES, small_bytes: int | None = None) -> DataFrame:
    """Rewrite the small files (below ``small_bytes``, default half the
    target) of every partition into files of about ``target_bytes``.  Returns,
    per partition folder, files and bytes before and after."""
    spark = table.spark
    small_bytes = target_bytes // 2 if small_bytes is None else small_bytes
    table.recover()
    before = stage(table_files(table), "compact-before", kept=True)
    swap = f"_compact-{uuid.uuid4().hex[:12]}"
    with staging(spark):
        plan = stage(plan_bins(before, target_bytes, small_bytes), "compact-plan")
        n_bins = (plan.agg(F.max("bin")).first()[0] + 1) if not plan.isEmpty() else 0
        if n_bins:
            plan.select("path").write.parquet(f"{table.path}/{swap}/plan")
            rows = table.read().filter(F.col("_metadata.file_size") < small_bytes).withColumn("__path", plain_path("_metadata.file_path"))
            moved = rows.join(plan.withColumnRenamed("path", "__path"), "__path").drop("__path").repartitionById(n_bins, F.col("bin")).drop("bin")
            writer = moved.write.partitionBy(*table.partition_by) if table.partition_by else moved.write
            writer.parquet(f"{table.path}/{swap}/data")
            table._save_state(table._state() | {"swap": swap})
            table.recover()
    count = lambda files, when: files.groupBy("folder").agg(
        F.count(F.lit(1)).alias(f"files_{when}"), F.sum("bytes").alias(f"bytes_{when}"))
    after = stage(table_files(table), "compact-after", kept=True)
    return count(before, "before").join(count(after, "after"), "folder", "full_outer")
