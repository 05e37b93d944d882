"""Merge against a plain-Python model, with null keys and duplicate keys."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakefold.operators import dedup
from lakefold.operators import merge as m

key = st.one_of(st.none(), st.integers(0, 6))
rows_st = st.lists(st.tuples(key, st.integers(0, 9)), max_size=20)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k int, v int"


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(frame):
    return Counter(tuple(r) for r in frame.collect())


def model_insert_only(t, s):
    tkeys = {k for k, _ in t if k is not None}
    return Counter(t + [r for r in s if r[0] is None or r[0] not in tkeys])


def model_delete(t, s):
    skeys = {k for k, _ in s if k is not None}
    return Counter([r for r in t if r[0] is None or r[0] not in skeys])


def model_upsert_latest(t, s):
    """Source reduced to its max ``v`` per non-null key, then update-all / insert."""
    latest = {}
    for k, v in s:
        if k is not None:
            latest[k] = max(v, latest.get(k, v))
    out = [(k, latest[k]) if k is not None and k in latest else (k, v) for k, v in t]
    tkeys = {k for k, _ in t if k is not None}
    out += [(k, v) for k, v in latest.items() if k not in tkeys]
    out += [r for r in s if r[0] is None]
    return Counter(out)


def model_purge_reference(t, s):
    counts = Counter(k for k, _ in t if k is not None)
    kept = [r for r in t if r[0] is None or counts[r[0]] == 1]
    return model_insert_only(kept, s)


@SETTINGS
@given(t=rows_st, s=rows_st)
def test_insert_only_and_delete(spark, t, s):
    assert bag(m.insert_only(df(spark, t), df(spark, s), ["k"])) == model_insert_only(t, s)
    assert bag(m.delete_matched(df(spark, t), df(spark, s), ["k"])) == model_delete(t, s)


@SETTINGS
@given(t=rows_st, s=rows_st)
def test_upsert_latest(spark, t, s):
    out = m.merge(df(spark, t), df(spark, s), ["k"], update="all", on_conflict="latest", order_by=["v"])
    assert bag(out) == model_upsert_latest(t, s)


@SETTINGS
@given(t=rows_st, s=rows_st)
def test_purge_reference(spark, t, s):
    assert bag(dedup.purge_duplicates(df(spark, t), df(spark, s), ["k"])) == model_purge_reference(t, s)
