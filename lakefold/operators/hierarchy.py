"""Hierarchy labelling (J1): attach the top-level name to every code.

Rows whose code has ``width`` characters are the top level; every row is
left-joined to the top-level rows of the same period on its code prefix.
The join (not a grouped max) is deliberate: the top level is not unique by
contract, and a duplicated top-level row fans out to two labelled rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.functions.clean import code_length, code_prefix


def label_hierarchy(
    df: DataFrame,
    code: str = "C1",
    name: str = "C1_NM",
    period: str = "PRD_DE",
    prefix_col: str = "C1_SIDO",
    label_col: str = "C1_NM_SIDO",
    width: int = 2,
    top: DataFrame | None = None,
) -> DataFrame:
    """Add ``prefix_col`` (the code's first ``width`` characters) and
    ``label_col`` (the name of the top-level row with that prefix in the same
    period).  Column order is kept, the new columns come last.  A null
    period never matches.

    ``top`` gives top-level rows to look up beside those of ``df`` (default:
    only its own).  ``df`` is read once per join side: pass a stored frame.
    Spark chooses the join from file statistics and measured sizes.
    """
    with_prefix = df.withColumn(prefix_col, code_prefix(code, width)) if prefix_col not in df.columns else df
    wanted = [F.col(period).alias("__p"), code_prefix(code, width).alias("__k"), F.col(name).alias(label_col)]
    own = with_prefix.filter(code_length(code) == width).select(*wanted)
    if top is not None:
        own = own.unionByName(top.select(*wanted))
    cond = (with_prefix[period] == own["__p"]) & (with_prefix[prefix_col] == own["__k"])
    return with_prefix.join(own, cond, "left").select(*with_prefix.columns, label_col)


def relabel(
    stored: DataFrame,
    batch: DataFrame,
    code: str = "C1",
    name: str = "C1_NM",
    period: str = "PRD_DE",
    prefix_col: str = "C1_SIDO",
    label_col: str = "C1_NM_SIDO",
    width: int = 2,
) -> DataFrame:
    """Labels kept up to date: ``stored`` with the labels that the top-level
    rows of ``batch`` now give, whenever their codes arrived.

    The (period, prefix) pairs whose top-level row the batch brings find the
    stored codes below them; all other rows keep their label.  Where the
    batch has several top-level rows of a pair, the greatest name counts, as
    in a batch that holds one row per key.  A pair's rows all have its
    period, so they lie in the partitions that the batch touches anyway."""
    tops = (batch.filter((code_length(code) == width) & F.col(period).isNotNull())
            .groupBy(F.col(period).alias("__p"), code_prefix(code, width).alias("__k")).agg(F.max(name).alias("__name")))
    joined = stored.join(tops, (stored[period] == tops["__p"]) & (stored[prefix_col] == tops["__k"]), "left")
    new = F.when(F.col("__k").isNotNull(), F.col("__name")).otherwise(F.col(label_col)).alias(label_col)
    return joined.select(*[new if c == label_col else F.col(c) for c in stored.columns])
