"""Extraction windows and allow-lists.

The reference date ``ref`` is an argument (not "today") so that a run is
reproducible.  The predicates compare the raw column with constants of the
same type, so on a timestamp column they reach the parquet scan as pushed
range filters (and partition filters on a date partition column).
"""

from __future__ import annotations

import datetime as dt
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bound(df: DataFrame, col: str, day: Column) -> Column:
    """``day`` (a date) in the type of ``col``: midnight for timestamps."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return day.cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return day.cast("timestamp")
    return day


def _ref(ref: str | dt.date | Column) -> Column:
    return ref if isinstance(ref, Column) else F.lit(str(ref)).cast("date")


def last_days(df: DataFrame, col: str, ref: str | dt.date | Column, days: int = 3) -> DataFrame:
    """Rows whose day is one of the ``days`` days before ``ref`` (``ref``
    itself excluded): ``ref - days <= day(col) <= ref - 1``."""
    r = _ref(ref)
    c = F.col(col)
    return df.filter((c >= _bound(df, col, F.date_sub(r, days))) & (c < _bound(df, col, r)))


def last_months(df: DataFrame, col: str, ref: str | dt.date | Column, months: int = 3) -> DataFrame:
    """Rows of the ``months`` whole calendar months before ``ref``'s month."""
    month0 = F.trunc(_ref(ref), "MM")
    c = F.col(col)
    return df.filter(
        (c >= _bound(df, col, F.add_months(month0, -months))) & (c < _bound(df, col, month0))
    )


def allow_list(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Keep rows whose ``col`` is one of ``values`` (pushed as ``In``)."""
    return df.filter(F.col(col).isin(list(values)))
