"""Compaction by file sizes (K2)."""

import os

import pytest
from pyspark.sql import functions as F

from lakefold.sources import silver
from lakefold.sources.compaction import compact, plan_bins, table_files
from lakefold.sources.silver import SilverTable


def grown_table(spark, path, partition_by=("p",)):
    """Two partitions (one of them null) with a large and several small files each."""
    st = SilverTable(spark, path, list(partition_by))
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 2 == 0, F.lit("a b/c")).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    st.write(rows.filter("id < 50000"))
    for n in range(5):
        part = rows.filter(f"id >= {50_000 + 2000 * n} AND id < {52_000 + 2000 * n}").coalesce(1).write.mode("append")
        (part.partitionBy(*partition_by) if partition_by else part).parquet(st.location())
    return st, rows


def content(df):
    return sorted(map(tuple, df.select("id", "p", "v").collect()))


@pytest.mark.parametrize("partition_by", [("p",), ()])
def test_small_files_are_packed_and_large_ones_keep_their_names(spark, tmp_dir, partition_by):
    st, rows = grown_table(spark, f"{tmp_dir}/t", partition_by)
    files = {r.path: r.bytes for r in table_files(st).collect()}
    limit = 500_000
    large = {p for p, b in files.items() if b >= limit}
    report = compact(st, target_bytes=2 * limit).collect()
    after = {r.path: r.bytes for r in table_files(st).collect()}
    assert large and large <= set(after) and len(after) < len(files)
    assert content(st.read()) == content(rows)
    for r in report:
        own = [b for p, b in files.items() if f"/{r.folder}/" in p or not r.folder]
        assert (r.files_before, r.bytes_before) == (len(own), sum(own))
        assert r.files_after < r.files_before
    assert sum(r.files_after for r in report) == len(after)
    again = compact(st, target_bytes=2 * limit).collect()
    assert all(r.files_before == r.files_after for r in again) and {r.path for r in table_files(st).collect()} == set(after)


def test_bins_hold_the_target(spark):
    sizes = [70, 60, 50, 40, 30, 20, 10, 95, 5, 200]
    files = spark.createDataFrame([(f"f{i}", "x", b) for i, b in enumerate(sizes)] + [("lone", "y", 3)], "path string, folder string, bytes long")
    bins = {}
    for r in plan_bins(files, 100, 100).collect():
        bins.setdefault(r.bin, []).append(r.path)
    used = sorted(sorted(sizes[int(p[1:])] for p in own) for own in bins.values())
    assert used == [[5, 95], [10, 20, 50], [30, 70], [40, 60]]  # first fit, largest first
    assert "lone" not in sum(bins.values(), []) and "f9" not in sum(bins.values(), [])


def test_unfinished_exchange_is_completed(spark, tmp_dir, monkeypatch):
    st, rows = grown_table(spark, f"{tmp_dir}/t")
    real = silver.delete_path
    calls = []

    def dies(spark, path):
        calls.append(path)
        if len(calls) > 2:
            raise OSError("gone")
        real(spark, path)

    monkeypatch.setattr(silver, "delete_path", dies)
    with pytest.raises(OSError):
        compact(st, target_bytes=1_000_000)
    monkeypatch.setattr(silver, "delete_path", real)
    assert st._state()["swap"]
    compact(SilverTable(spark, f"{tmp_dir}/t", ["p"]), target_bytes=1_000_000)
    assert content(st.read()) == content(rows) and "swap" not in st._state()
    assert not [d for d in os.listdir(f"{tmp_dir}/t") if d.startswith("_compact")]
