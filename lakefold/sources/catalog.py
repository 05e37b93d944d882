"""Table registration (R6): make Bronze and Silver folders queryable by SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME_RE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def register_table(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", partitioned: bool = True
) -> DataFrame:
    """Create (if absent) an external table over ``path`` and load its
    partitions.  Partition folders written after the table was created stay
    invisible until partitions are recovered, so that step always runs."""
    if not _NAME_RE.match(name):
        raise ValueError(f"invalid table name {name!r}")
    if fmt not in ("parquet", "json", "csv", "orc"):
        raise ValueError(f"unsupported table format {fmt!r}")
    escaped = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{escaped}'")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def register_silver(spark: SparkSession, name: str, table) -> DataFrame:
    """R6 for a Silver table: a session view over its current data (a view
    taken before a rewrite is to be registered again)."""
    if not _NAME_RE.match(name):
        raise ValueError(f"invalid table name {name!r}")
    table.read().createOrReplaceTempView(name)
    return spark.table(name)
