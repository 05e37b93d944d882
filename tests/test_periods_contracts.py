"""Extraction windows (P8, P9), Bronze contracts, topic records (K7)."""

import datetime as dt


from lakefold import schemas
from lakefold.operators import periods
from lakefold.sinks.kafka import to_records


def test_last_days_and_months_on_timestamps(spark):
    days = [dt.datetime(2024, 1, d, 12) for d in range(1, 32)] + [dt.datetime(2023, 10, 31, 23, 59)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    got = sorted(r.ts.day for r in periods.last_days(df, "ts", "2024-01-10").collect())
    assert got == [7, 8, 9]
    months = periods.last_months(df, "ts", "2024-02-15", 3).count()
    assert months == 31  # November and December are empty, all of January counts
    plan = periods.last_days(df, "ts", "2024-01-10")._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-07" in plan


def test_last_days_on_dates_and_allow_list(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), "a" if d % 2 else "b") for d in range(1, 11)], "d date, k string")
    assert periods.last_days(df, "d", dt.date(2024, 1, 5), 2).count() == 2
    assert periods.allow_list(df, "k", ["a"]).count() == 5


def test_contract_schemas():
    assert schemas.NEWS.schema["url"].nullable is False
    assert schemas.NEWS.schema["publisher"].nullable is True
    assert len(schemas.AIR.fields) == 23 and len(schemas.CENSUS.fields) == 16


def test_topic_records(spark):
    df = spark.createDataFrame([("Kim", "k@x"), (None, "n@x")], "name string, email string")
    records, rejected = to_records(df, schemas.TEST, strict=False)
    rows = records.collect()
    assert len(rows) == 1 and rows[0].value == '{"name":"Kim","email":"k@x"}' and len(rows[0].key) == 36
    assert rejected.first().contract_errors == ["missing:name"]
