"""Join helpers for keys that may be null.

Which side is broadcast is left to Spark: file statistics at planning time,
measured shuffle sizes at run time (AQE).  Joins are written so that their
streamed side can be split by AQE's skew handling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shuffle buckets over which rows with a null key part are spread.
NULL_SALTS = 1024
_SALT = "__null_salt"


def all_keys_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _hashable(t: T.DataType) -> bool:
    """Spark hashes anything but maps."""
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return not isinstance(t, T.MapType) and (not isinstance(t, T.ArrayType) or _hashable(t.elementType))


def key_join(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool = False) -> DataFrame:
    """Equi-join (``left``, ``left_semi`` or ``left_anti``) on same-named
    keys.  Keeps the left key columns only and the left side's column order.

    Under SQL equality a left row with a null key part matches nothing, yet
    hashed on its keys it would share one partition with all other such
    rows.  A salt column, 0 where the keys are present, spreads them: they
    stay in the join (no separate branch, one read of the left side) and
    still match nothing.  Right rows with a null key part are left out.
    """
    semi = how in ("left_semi", "left_anti")
    rest = [c for c in right.columns if c not in on]
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    if null_safe:
        cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in on])
    else:
        hashed = [f.name for f in left.schema.fields if _hashable(f.dataType)]
        salt = F.when(all_keys_present(on), 0).otherwise(F.pmod(F.xxhash64(*hashed), F.lit(NULL_SALTS)) + 1)
        columns, left = left.columns, left.withColumn(_SALT, salt)
        # 0 too, but not a literal: that would be folded into a condition on the left side and no longer hashed
        zero = F.pmod(F.xxhash64(*[f"__r_{k}" for k in on]), F.lit(1).cast("long"))
        renamed = renamed.filter(all_keys_present([f"__r_{k}" for k in on])).withColumn(f"__r{_SALT}", zero)
        cond = reduce(lambda a, b: a & b, [left[k] == renamed[f"__r_{k}"] for k in on]) & (
            left[_SALT] == renamed[f"__r{_SALT}"])
        return left.join(renamed, cond, how).select(*columns, *([] if semi else rest))
    return left.join(renamed, cond, how).select(*left.columns, *([] if semi else rest))
