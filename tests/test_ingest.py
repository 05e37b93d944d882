"""Ingestion operators (FIXTURES 23-25) and request planning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.operators import ingest

ITEM = T.StructType([T.StructField("k", T.LongType())])


def test_listing_zip_cut_to_shortest(spark):
    html = "<h2>T1</h2><h2>T2</h2><h2>T3</h2><span>P1</span><span> <b>P2</b> </span>"
    df = spark.createDataFrame([(1, html), (2, "<h2>only</h2>")], "page_id int, html string")
    out = ingest.listing_extract(
        df, "html", {"title": "<h2>(.*?)</h2>", "publisher": "<span>(.*?)</span>"},
        keep=["page_id"], text_fields=["publisher"],
    ).orderBy("page_id", "item_no").collect()
    assert [(r.page_id, r.item_no, r.title, r.publisher) for r in out] == [(1, 1, "T1", "P1"), (1, 2, "T2", "P2")]


def test_envelope(spark):
    ok = '{"response":{"header":{"resultCode":"00"},"body":{"items":[{"k":1},{"k":2}]}}}'
    bad = '{"response":{"header":{"resultCode":"22"},"body":{"items":[]}}}'
    df = spark.createDataFrame([(1, ok), (2, bad)], "id int, raw string")
    items = ingest.envelope_items(df, "raw", ITEM, keep=["id"]).collect()
    assert sorted((r.id, r.item_no, r.k) for r in items) == [(1, 1, 1), (1, 2, 2)]
    assert [r.result_code for r in ingest.envelope_errors(df, "raw", ITEM).collect()] == ["22"]
    with pytest.raises(ValueError):
        ingest.envelope_items(df, "raw", ITEM, strict=True)


def test_api_result(spark):
    df = spark.createDataFrame(
        [(1, '{"err":"30"}'), (2, '{"err":"20"}'), (3, '[{"k":1},{"k":2},{"k":3}]')], "id int, raw string"
    )
    out = sorted(((r.id, r.status, r.item_no, r.k) for r in ingest.api_result(df, "raw", ITEM, keep=["id"]).collect()),
                 key=repr)
    assert out == sorted([(2, "error", None, None), (3, "ok", 1, 1), (3, "ok", 2, 2), (3, "ok", 3, 3)], key=repr)
    with pytest.raises(ValueError):
        ingest.api_result(df, "raw", ITEM, keep=["id"], strict=True)


def test_api_result_cut_off_list_is_an_error(spark):
    df = spark.createDataFrame([(1, '[{"k":1},{"k":'), (2, '[{"k":1}]'), (3, "[]"), (4, None)], "id int, raw string")
    out = sorted(((r.id, r.status, r.k) for r in ingest.api_result(df, "raw", ITEM, keep=["id"]).collect()), key=repr)
    assert out == [(1, "error", None), (2, "ok", 1), (4, "error", None)]
    with pytest.raises(ValueError):
        ingest.api_result(df.filter("id = 1"), "raw", ITEM, keep=["id"], strict=True)


def test_listing_items_take_fields_from_their_own_block(spark):
    html = ('<li><a class="t" href="u1">one\nline</a><i>p1</i></li><li><a href="u2" class="t">two</a></li>'
            '<li><a href="u3">three</a><i>p3</i></li>')
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id int, html string")
    out = ingest.listing_items(df, "html", "(?s)<li>.*?</li>", {
        "url": 'href="([^"]*)"', "title": "(?s)<a [^>]*>(.*?)</a>", "publisher": "<i>(.*?)</i>", "description": "<p>(.*?)</p>"},
        keep=["page_id"], text_fields=["title"]).collect()
    assert [(r.item_no, r.url, r.title, r.publisher, r.description) for r in sorted(out, key=lambda r: r.item_no)] == [
        (1, "u1", "one\nline", "p1", None), (2, "u2", "two", None, None), (3, "u3", "three", "p3", None)]


def test_records_keep_null_fields(spark):
    from lakefold.schemas import Contract
    from lakefold.sinks.kafka import to_records

    df = spark.createDataFrame([("n", None)], "name string, note string")
    records, _ = to_records(df, Contract("c", ("name", "note", "absent"), ("name",)))
    assert records.first().value == '{"name":"n","note":null,"absent":null}'


def test_request_plan(spark):
    kw = spark.createDataFrame([("a b",)], "kw string")
    out = ingest.request_plan(
        kw, "kw", F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 2)), "https://x/s", "day", pages=2
    ).orderBy("period", "page").collect()
    assert len(out) == 4
    assert out[1].keyword == '"a b"'
    assert out[1].url == "https://x/s?where=news&query=%22a+b%22&sort=1&pd=3&ds=2024.01.01&de=2024.01.01&start=11"
    monthly = ingest.request_plan(kw, "kw", F.lit(dt.date(2024, 1, 15)), F.lit(dt.date(2024, 3, 2)), "u", "month")
    assert sorted(r.period for r in monthly.collect()) == ["202401", "202402", "202403"]


def test_arrival_report(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)], "d date")
    out = sorted(tuple(r) for r in ingest.arrival_report(df, "d", pad_days=1).collect())
    assert out == [
        (dt.date(2023, 12, 31), 0, False), (dt.date(2024, 1, 1), 2, True),
        (dt.date(2024, 1, 2), 0, False), (dt.date(2024, 1, 3), 1, True), (dt.date(2024, 1, 4), 0, False),
    ]


def test_contract(spark):
    df = spark.createDataFrame([("n", "e"), (None, "e"), ("n", None)], "name string, email string")
    valid, rejected = ingest.split_contract(df, ["name", "email"])
    assert valid.count() == 1
    assert sorted(r.contract_errors[0] for r in rejected.collect()) == ["missing:email", "missing:name"]
    valid, _ = ingest.split_contract(df, ["name", "email"], strict=True)  # no job yet
    with pytest.raises(Exception, match="violate the contract: missing:"):
        valid.collect()
    typed = spark.createDataFrame([(1,)], "n int")
    assert ingest.contract_errors(typed, [], coerce=False).first().contract_errors == ["type:n"]
    assert ingest.contract_errors(typed, []).schema["n"].dataType == T.StringType()


def test_message_key_unique(spark):
    keyed = ingest.with_message_key(spark.range(1000))
    stats = keyed.agg(F.count("*").alias("n"), F.countDistinct("message_key").alias("d")).first()
    assert stats.n == stats.d == 1000
