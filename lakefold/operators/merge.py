"""Keyed merge of a source batch into a target table.

``merge`` returns the new table as a DataFrame; storing it is the caller's
(or ``SilverTable``'s) job.  Keys use SQL equality, so by default a null key
part never matches, exactly as a ``MERGE ... ON t.k = s.k`` does.

Plan shape
----------
The full-outer join a merge suggests is split into joins whose skewed side
AQE can split:

* matched update: ``target LEFT JOIN source`` (target is the streamed side);
* matched delete: ``target LEFT ANTI JOIN source keys``;
* insert: ``source LEFT ANTI JOIN target keys``.

Each side is read once per join: twice for an upsert.  Rows with a null key
part stay in the joins and are spread by a salt (``joins.key_join``).  The
cardinality guard is part of the plan: the source of an update is reduced to
one row per key with its count, on the partitioning that the join needs
anyway, and a matched count above one raises while the merge runs.  Building
a merge starts no job.
"""

from __future__ import annotations

import contextlib
import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.operators.evolve import conform, conform_both, merge_schemas
from lakefold.operators.joins import all_keys_present, key_join

NULL_KEY_MODES = ("reinsert", "drop", "null_safe")
CONFLICT_MODES = ("error", "latest")


class MergeCardinalityError(ValueError):
    """Several source rows would update (or be matched to) one target row."""


# --------------------------------------------------------------------------
# building blocks
# --------------------------------------------------------------------------


def newest_first(df: DataFrame, order_by: list[str]) -> list[Column]:
    """Descending order: ``order_by`` first, then every other column as a
    tie-breaker, so that "the latest row" is unique up to identical copies
    (nulls last, as the smallest values)."""
    rest = [c for c in df.columns if c not in order_by]
    return [F.col(c).desc_nulls_last() for c in list(order_by) + rest]


def latest_per_key(
    df: DataFrame, keys: Iterable[str], order_by: Iterable[str], group_nulls: bool = False
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` (ties broken by
    the remaining columns).  Rows with a null key part are kept as they are,
    unless ``group_nulls`` (null-safe keys), where null is a key value too.

    Written as ``row_number() = 1``, which Spark limits to one row per key
    and task before the shuffle (``WindowGroupLimit``): a key that holds a
    large share of the rows reaches the final window as one row per task.
    """
    keys, order_by = list(keys), list(order_by)
    # each row with a null key part is a group of its own
    lone = F.lit(0) if group_nulls else F.when(all_keys_present(keys), F.lit(-1)).otherwise(F.monotonically_increasing_id())
    ranked = df.withColumn("__lone", lone.cast("long")).withColumn(
        "__rn", F.row_number().over(Window.partitionBy(*keys, "__lone").orderBy(*newest_first(df, order_by))))
    return ranked.filter("__rn = 1").select(*df.columns)


def repeated_keys(df: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Keys with more than one row, and ``n_source_rows``."""
    keyed = df if null_safe else df.filter(all_keys_present(on))
    return keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n_source_rows")).filter("n_source_rows > 1")


def merge_conflicts(target: DataFrame, source: DataFrame, on: Iterable[str], null_safe: bool = False) -> DataFrame:
    """M8: keys with more than one source row that also exist in the target.

    ``n_source_rows`` counts the source rows per key.  A merge that updates
    matched rows is ambiguous for every key listed here.
    """
    on = list(on)
    return key_join(repeated_keys(source, on, null_safe), target.select(*on), on, "left_semi", null_safe)


def check_cardinality(target: DataFrame, source: DataFrame, on: list[str], null_safe: bool = False) -> None:
    """Raise ``MergeCardinalityError`` if a target row has several source rows."""
    if repeated_keys(source, on, null_safe).isEmpty():
        return
    bad = merge_conflicts(target, source, on, null_safe).limit(5).collect()
    if bad:
        sample = ", ".join(str(tuple(r[k] for k in on)) for r in bad)
        raise MergeCardinalityError(
            f"several source rows match one target row for key(s) {on}: {sample}"
        )


_CONFLICT = "several source rows match one target row for key"


def _guarded_source(source: DataFrame, on: list[str], columns: list[str], null_safe: bool) -> DataFrame:
    """One row per key: ``__s_`` columns, and ``__n``, its rows."""
    keyed = source if null_safe else source.filter(all_keys_present(on))
    one = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*columns or [F.lit(True).alias("__row")])).alias("__s"))
    return one.select(*on, *[F.col(f"__s.{c}").alias(f"__s_{c}") for c in columns], "__n")


def _hit(on: list[str]) -> Column:
    """Whether a target row has a source row; raises where it has several."""
    key = F.concat_ws(", ", *[F.concat(F.lit(f"{k} = "), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in on])
    several = F.raise_error(F.concat(F.lit(f"{_CONFLICT} "), key)).cast("boolean")
    return F.when(F.col("__n") > 1, several).otherwise(F.col("__n").isNotNull())


@contextlib.contextmanager
def cardinality_errors():
    """Turn a guard's failure in a running merge into ``MergeCardinalityError``."""
    try:
        yield
    except Exception as e:
        found = re.search(rf"{_CONFLICT} [^\n]*", str(e))
        if found is None:
            raise
        raise MergeCardinalityError(found.group()) from e


def union_evolving(frames: list[DataFrame]) -> DataFrame:
    """M7: all rows in the merged schema (see ``operators.evolve``)."""
    schema = reduce(merge_schemas, [f.schema for f in frames])
    return reduce(lambda a, b: a.unionByName(b), [conform(f, schema) for f in frames])


# --------------------------------------------------------------------------
# merge
# --------------------------------------------------------------------------


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Iterable[str],
    update: None | str | list[str] | dict[str, str] = None,
    insert: str | None = "all",
    delete: bool = False,
    evolve: bool = True,
    null_keys: str = "reinsert",
    on_conflict: str = "error",
    order_by: Iterable[str] | None = None,
    when_newer: Iterable[str] | None = None,
) -> DataFrame:
    """Fold ``source`` into ``target`` by key and return the resulting table.

    update        None (leave matched rows), ``"all"`` (every source column),
                  a list of column names, or ``{target_col: source_col}``.
    insert        ``"all"`` inserts source rows without a match, None skips.
    delete        delete matched target rows (wins over ``update``).
    evolve        merge the schemas: source-only columns and nested fields are
                  added (old rows get null), types widen on both sides; with
                  ``False`` source-only columns raise ``ValueError``.
    null_keys     ``"reinsert"``: null keys never match and null-key source
                  rows are inserted on every run (the reference behaviour);
                  ``"drop"``: null-key source rows are discarded;
                  ``"null_safe"``: nulls match nulls (``<=>``).
    on_conflict   ``"error"``: several source rows for one matched target row
                  raise when the merge runs (only when updating; as
                  ``MergeCardinalityError`` inside ``cardinality_errors``);
                  ``"latest"``: the source is reduced to its latest row per
                  key by ``order_by`` first.
    when_newer    with ``update``: a matched row is replaced only when the
                  source's ``when_newer`` tuple is greater than the target's,
                  which makes repeated or reordered batches converge.
    """
    on = list(on)
    if null_keys not in NULL_KEY_MODES:
        raise ValueError(f"null_keys must be one of {NULL_KEY_MODES}")
    if on_conflict not in CONFLICT_MODES:
        raise ValueError(f"on_conflict must be one of {CONFLICT_MODES}")
    missing = [k for k in on if k not in target.columns or k not in source.columns]
    if missing:
        raise ValueError(f"merge keys missing from a side: {missing}")
    extra = [c for c in source.columns if c not in target.columns]
    if extra and not evolve:
        raise ValueError(f"source columns not in target and evolve=False: {extra}")
    null_safe = null_keys == "null_safe"
    if evolve:
        target, source = conform_both(target, source)

    if null_keys == "drop":
        source = source.filter(all_keys_present(on))
    if on_conflict == "latest":
        if not order_by:
            raise ValueError("on_conflict='latest' needs order_by")
        source = latest_per_key(source, on, order_by, group_nulls=null_safe)

    parts: list[DataFrame] = []

    # -- matched target rows ------------------------------------------------
    if delete:
        parts.append(key_join(target, source.select(*on), on, "left_anti", null_safe))
    elif update is not None:
        if update == "all":
            mapping = {c: c for c in source.columns if c not in on}
        elif isinstance(update, dict):
            mapping = dict(update)
        else:
            mapping = {c: c for c in update}
        newer = list(when_newer or [])
        s_cols = sorted(set(mapping.values()) | set(newer))
        if on_conflict == "error":
            s_upd = _guarded_source(source, on, s_cols, null_safe)
        else:
            s_upd = source.select(*on, *[F.col(c).alias(f"__s_{c}") for c in s_cols], F.lit(1).alias("__n"))
        joined = key_join(target, s_upd, on, "left", null_safe)
        hit = _hit(on)
        if newer:
            s_ord = F.struct(*[F.col(f"__s_{c}") for c in newer])
            t_ord = F.struct(*[F.col(c) for c in newer])
            hit = hit & (F.col(newer[0]).isNull() | (s_ord > t_ord))
        out_cols = []
        for c in target.columns:
            if c in mapping:
                out_cols.append(F.when(hit, F.col(f"__s_{mapping[c]}")).otherwise(F.col(c)).alias(c))
            else:
                out_cols.append(F.col(c))
        for c in extra:
            if c in mapping:
                out_cols.append(F.when(hit, F.col(f"__s_{mapping[c]}")).alias(c))
        parts.append(joined.select(*out_cols))
    else:
        parts.append(target)

    # -- inserts ------------------------------------------------------------
    if insert:
        parts.append(key_join(source, target.select(*on), on, "left_anti", null_safe))

    out = union_evolving(parts)
    return out.select(*target.columns, *[c for c in extra if c in out.columns])


def update_insert(target, source, on, update, **kw) -> DataFrame:
    """M1/M2: update the listed columns when matched, insert all when not."""
    return merge(target, source, on, update=update, insert="all", **kw)


def insert_only(target, source, on, **kw) -> DataFrame:
    """M3: insert source rows whose key is not in the target."""
    return merge(target, source, on, update=None, insert="all", **kw)


def delete_matched(target, source, on, **kw) -> DataFrame:
    """M4: delete target rows whose key occurs in the source."""
    return merge(target, source, on, delete=True, insert=None, **kw)


def upsert_latest(target, source, on, order_by, **kw) -> DataFrame:
    """M6: last write per key wins (source reduced to its latest row per key,
    then every column updated when matched, inserted when not)."""
    return merge(
        target, source, on, update="all", insert="all", on_conflict="latest", order_by=order_by, **kw
    )
