"""Merges handed to Delta Lake where it is installed (M1-M3 on a Delta path).

The semantics of ``operators.merge`` carry over: SQL equality on the keys,
listed columns updated, all columns inserted.  Delta itself commits the
merge and raises on several source rows for one matched row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def available(spark: SparkSession) -> bool:
    """Delta's Python package imports and its session extension is set."""
    try:
        import delta.tables  # noqa: F401
    except ImportError:
        return False
    return "DeltaSparkSessionExtension" in (spark.conf.get("spark.sql.extensions", "") or "")


def merge_into(spark: SparkSession, path: str, source: DataFrame, on: list[str], update: list[str] | None = None) -> None:
    """Update ``update`` where a key matches (None: leave matches), insert
    the other rows; the table is created from ``source`` if there is none."""
    from delta.tables import DeltaTable

    if not DeltaTable.isDeltaTable(spark, path):
        source.limit(0).write.format("delta").save(path)
    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in on)
    job = DeltaTable.forPath(spark, path).alias("t").merge(source.alias("s"), condition)
    if update:
        job = job.whenMatchedUpdate(set={c: f"s.`{c}`" for c in update})
    job.whenNotMatchedInsertAll().execute()
