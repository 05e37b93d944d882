"""Duplicate handling.

The reference finds duplicates with ``ROW_NUMBER() OVER (PARTITION BY key
ORDER BY ...) > 1``.  A window sends every row of a key to one task, so a
key holding a third of the table would be sorted by a single core.  The
operators here reach the same rows through grouped aggregates, which
combine map-side before the shuffle, plus equi-joins that AQE can split
when a key is skewed.
"""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.operators.joins import all_keys_present, key_join
from lakefold.operators.merge import latest_per_key

PURGE_MODES = ("reference", "keep_latest")


def distinct_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """A1/A2: whole-row distinct, optionally after projecting ``columns``.

    Project first when the caller allows it: a distinct over all columns
    keeps every column alive through the shuffle.
    """
    cols = list(columns) if columns else None
    return (df.select(*cols) if cols else df).distinct()


def duplicate_rows(df: DataFrame, keys: Iterable[str], order_by: Iterable[str]) -> DataFrame:
    """W1 + P7 + P5 + A2: the distinct rows whose row number within their key
    (ordered by ``order_by`` descending, then every other column descending)
    is greater than one.  Null key values form one group, as in a window.

    Equivalent to::

        SELECT DISTINCT * EXCEPT rn FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ... DESC) rn
          FROM df) WHERE rn > 1

    A narrow hash aggregate finds the repeated keys; only their rows are
    compared as a whole.  Every row of such a key qualifies except the top
    one, which qualifies only when it has an identical copy.
    """
    keys, order_by = list(keys), list(order_by)
    cols = df.columns
    rank_key = F.struct(*order_by, *[c for c in cols if c not in order_by])
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*keys)
    rows = key_join(df, repeated, keys, "left_semi", null_safe=True)
    copies = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
    top = copies.groupBy(*keys).agg(F.max(rank_key).alias("__top"))
    joined = key_join(copies, top, keys, "left", null_safe=True)
    return joined.filter((rank_key != F.col("__top")) | (F.col("__copies") > 1)).select(*cols)


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per non-null key (``__n``)."""
    return df.filter(all_keys_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def drop_duplicated_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Delete every row of a key that occurs more than once (M4 with the
    duplicate rows as source: the survivor of the window goes too).  Rows
    with a null key part never match a delete and stay."""
    keys = list(keys)
    return key_join(df, key_counts(df, keys).filter("__n > 1").select(*keys), keys, "left_anti")


def _rows_of(df: DataFrame, keys: DataFrame, on: list[str], store: Callable[[DataFrame], DataFrame], inside: bool) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys`` (``inside``), or is not.

    The keys' hashes, eight bytes each, are stored, so their size is known
    when the join is planned: while they fit a broadcast, only rows with a
    hash among them are shuffled, to be compared by the key itself."""
    columns = df.columns
    marks = store(keys.select(F.xxhash64(*on).alias("__mark")).distinct())
    marked = df.withColumn("__mark", F.xxhash64(*on))
    hits = marked.join(marks, "__mark", "left_semi").select(*columns)
    if inside:
        return key_join(hits, keys, on, "left_semi")
    others = marked.join(marks, "__mark", "left_anti").select(*columns)
    return others.unionByName(key_join(hits, keys, on, "left_anti"))


def purge_duplicates(
    target: DataFrame,
    source: DataFrame,
    on: Iterable[str],
    mode: str = "reference",
    order_by: Iterable[str] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """M5: clear duplicated keys from the target, then insert the source rows
    whose key is not (any longer) present.

    ``mode="reference"`` deletes every row of a duplicated key, so such a
    key is replaced by whatever source rows carry it.  ``mode="keep_latest"``
    keeps the latest row per key (by ``order_by``) instead.

    The target is read for its rows and for its keys; the one aggregate over
    the keys serves the delete and the insert (its shuffle is reused).

    ``store`` (reference mode), for wide rows: keys are settled first, on
    copies that it keeps, and rows are then picked by them (``_rows_of``).
    """
    on = list(on)
    if mode not in PURGE_MODES:
        raise ValueError(f"mode must be one of {PURGE_MODES}")
    if mode == "reference" and store is not None:
        counts = store(key_counts(target, on))
        repeated = store(counts.filter("__n > 1").select(*on))
        keyed = source.filter(all_keys_present(on))
        new = store(key_join(keyed.select(*on).distinct(), counts.filter("__n = 1").select(*on), on, "left_anti"))
        kept = _rows_of(target, repeated, on, store, inside=False)
        inserted = _rows_of(keyed, new, on, store, inside=True).unionByName(source.filter(~all_keys_present(on)))
        return kept.unionByName(inserted, allowMissingColumns=True)
    if mode == "reference":
        kept = drop_duplicated_keys(target, on)
        kept_keys = key_counts(target, on).filter("__n = 1").select(*on)
    else:
        if not order_by:
            raise ValueError("mode='keep_latest' needs order_by")
        kept = latest_per_key(target, on, order_by)
        kept_keys = target.select(*on)
    inserted = key_join(source, kept_keys, on, "left_anti")
    return kept.unionByName(inserted, allowMissingColumns=True)
