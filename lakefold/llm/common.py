"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakefold.session import scratch_path, stage, staging

__all__ = ["WORD", "in_memory_cache", "read", "released", "row_order", "scratch_path", "stage", "staging", "text_of"]

#: A word: a run of anything but space, tab, line feed, vertical tab, form
#: feed and carriage return (what ``bytes.split()`` splits at).
WORD = r"[^\x20\x09-\x0D]+"

_CACHE: dict = {}


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a given table; other columns, also ones whose
    names clash with an operator's output, are never read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def text_of(column: Column | str) -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def row_order(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """A total order of records up to equal rows: id (null first), then text."""
    return [F.col(id_col).asc_nulls_first(), F.sha2(text_of(text_col).cast("binary"), 256)]


def in_memory_cache(kind: str, key: str, make):
    """One object per Python worker (tokenizer files, merge tables)."""
    name = (kind, hashlib.sha256(key.encode()).hexdigest())
    if name not in _CACHE:
        _CACHE[name] = make()
    return _CACHE[name]


def released(run, *kinds: str):
    """``run``, a function for ``mapInArrow``, in a worker that holds on to
    little memory: objects of other kinds than ``kinds`` go before it begins,
    and what it has freed goes back to the system at its end.  Workers outlive
    the stage that they worked for, and their memory counts as the executor's."""

    def whole(batches):
        keep_only(kinds)
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def keep_only(kinds: tuple[str, ...]) -> None:
    """Objects of other kinds go from this worker."""
    for name in [n for n in _CACHE if n[0] not in kinds]:
        del _CACHE[name]


def give_back() -> None:
    """Free memory that the allocators keep goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
