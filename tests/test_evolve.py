"""Recursive schema merge (M7, K1)."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.operators.evolve import SchemaMergeError, conform, merge_schemas, merge_types, readable_as, same_type
from lakefold.operators.merge import merge, union_evolving
from lakefold.sources.silver import SilverTable


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def kind(ddl):
    return schema(f"c {ddl}").fields[0].dataType


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("int", "float", "double"), ("bigint", "double", "double"),
    ("float", "double", "double"), ("int", "string", "string"), ("boolean", "int", "string"), ("date", "timestamp", "timestamp"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp", "string", "string"), ("decimal(10,2)", "int", "decimal(12,2)"),
    ("decimal(10,2)", "decimal(5,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,30)", "double"), ("decimal(5,1)", "double", "double"),
    ("void", "array<int>", "array<int>"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("map<int,float>", "map<bigint,string>", "map<bigint,string>"),
    ("struct<a:int,b:struct<x:int>>", "struct<b:struct<y:string,x:double>,c:date>", "struct<a:int,b:struct<x:double,y:string>,c:date>"),
    ("array<struct<A:int>>", "array<struct<a:bigint,n:array<int>>>", "array<struct<A:bigint,n:array<int>>>"),
])
def test_types_meet_from_both_sides(a, b, want):
    assert merge_types(kind(a), kind(b)).simpleString() == want
    assert same_type(merge_types(kind(a), kind(a)), kind(a))
    if "struct" not in a:  # the order of fields follows the left side
        assert merge_types(kind(b), kind(a)).simpleString() == want


@pytest.mark.parametrize("a,b", [("struct<a:int>", "int"), ("array<int>", "string"), ("map<string,int>", "struct<a:int>")])
def test_nested_and_flat_do_not_meet(a, b):
    with pytest.raises(SchemaMergeError, match="x.c"):
        merge_schemas(schema(f"x struct<c:{a}>"), schema(f"x struct<c:{b}>"))


def test_conform_casts_nested_values(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('a', 1, 'l', array(named_struct('p', 1), null)) AS s, map(1, 1.5F) AS m, null AS n
        UNION ALL SELECT 2, null, null, null""")
    want = schema("id bigint, s struct<a:string,l:array<struct<p:bigint,q:date>>,z:int>, m map<bigint,double>, n string, extra boolean")
    rows = conform(df, want).orderBy("id").collect()
    assert rows[0].asDict(True) == {"id": 1, "s": {"a": "1", "l": [{"p": 1, "q": None}, None], "z": None}, "m": {1: 1.5}, "n": None, "extra": None}
    assert rows[1].asDict(True) == {"id": 2, "s": None, "m": None, "n": None, "extra": None}
    assert conform(df, df.schema) is df


def test_merge_widens_both_sides(spark):
    t = spark.sql("SELECT 1 AS k, 5 AS v, named_struct('a', 1) AS s UNION ALL SELECT 2, 6, named_struct('a', 2)")
    b = spark.sql("SELECT 2L AS k, 10000000000L AS v, named_struct('a', 1.5D, 'b', 'new') AS s UNION ALL SELECT 30000000000L, 7L, null")
    out = merge(t, b, ["k"], update=["s"], insert="all")
    assert out.schema.simpleString() == "struct<k:bigint,v:bigint,s:struct<a:double,b:string>>"
    assert sorted((r.k, r.v, tuple(r.s) if r.s else None) for r in out.collect()) == [
        (1, 5, (1.0, None)), (2, 6, (1.5, "new")), (30000000000, 7, None)]


def test_union_of_three(spark):
    frames = [spark.sql("SELECT 1 AS a"), spark.sql("SELECT 'x' AS b"), spark.sql("SELECT 2.5D AS a, array(1) AS c")]
    out = union_evolving(frames)
    assert out.schema.simpleString() == "struct<a:double,b:string,c:array<int>>"
    assert sorted(map(str, out.collect())) == sorted(["Row(a=1.0, b=None, c=None)", "Row(a=None, b='x', c=None)", "Row(a=2.5, b=None, c=[1])"])


def files(spark, table, value):
    return sorted(r[0] for r in table.read().filter(F.col("p") == value).select("_metadata.file_name").distinct().collect())


def test_stored_files_are_read_in_the_wider_schema(spark, tmp_dir):
    st = SilverTable(spark, f"{tmp_dir}/t", ["p"])
    st.write(spark.sql("""SELECT p, id AS k, CAST(id AS INT) AS v, CAST(0.5 AS FLOAT) AS f, named_struct('a', CAST(id AS INT)) AS s,
        array(CAST(id AS INT)) AS l, map('x', CAST(id AS INT)) AS m FROM range(6) JOIN (SELECT explode(array(0, 1)) AS p)"""))
    before = files(spark, st, 1)
    new = spark.sql("""SELECT 0 AS p, 9L AS k, 10000000000L AS v, 0.25D AS f, named_struct('a', 10000000000L, 'b', 'x') AS s,
        array(10000000000L) AS l, map('x', 10000000000L) AS m, current_date() AS extra""")
    st.replace(new, [(0,)])
    assert files(spark, st, 1) == before  # untouched files stay
    assert st.read().schema.simpleString() == ("struct<p:int,k:bigint,v:bigint,f:double,s:struct<a:bigint,b:string>,l:array<bigint>,"
                                               "m:map<string,bigint>,extra:date>")
    old = st.read().filter("p = 1 AND k = 5").first()
    assert (old.v, old.f, tuple(old.s), old.l, old.m, old.extra) == (5, 0.5, (5, None), [5], {"x": 5}, None)
    assert st.read().filter("p = 0").first().v == 10000000000


def test_types_that_files_cannot_be_read_as_are_rewritten(spark, tmp_dir):
    st = SilverTable(spark, f"{tmp_dir}/t", ["p"])
    st.write(spark.sql("SELECT CAST(id % 2 AS INT) AS p, id AS k, id AS v FROM range(6) UNION ALL SELECT null, 7, 7"))
    st.replace(spark.sql("SELECT 0 AS p, 1L AS k, 'text' AS v"), [(0,)])
    assert sorted((str(r.p), r.k, r.v) for r in st.read().collect()) == [
        ("0", 1, "text"), ("1", 1, "1"), ("1", 3, "3"), ("1", 5, "5"), ("None", 7, "7")]
    assert not readable_as(kind("bigint"), kind("string")) and readable_as(kind("struct<a:int>"), kind("struct<b:int,a:bigint>"))


def test_state_survives_a_writer_that_dies(spark, tmp_dir, monkeypatch):
    st = SilverTable(spark, f"{tmp_dir}/t")
    for n in range(4):
        st.write(spark.range(n), ("w", n))
    assert st.read().count() == 3 and st.applied("w") == 3 and len(st._state_files()) == 2
    with open(f"{tmp_dir}/t/_state/new-dead", "w") as f:
        f.write('{"folder": ')  # died while writing
    again = SilverTable(spark, f"{tmp_dir}/t")
    assert again.read().count() == 3 and again.applied("w") == 3


def test_decimals_and_dates(spark):
    a = spark.createDataFrame([(1, decimal.Decimal("1.25"), dt.date(2024, 1, 1))], "k int, d decimal(10,2), t date")
    b = spark.createDataFrame([(2, 3, dt.datetime(2024, 1, 2, 3))], "k int, d int, t timestamp_ntz")
    rows = sorted(map(tuple, union_evolving([a, b]).collect()))
    assert rows == [(1, decimal.Decimal("1.25"), dt.datetime(2024, 1, 1)), (2, decimal.Decimal("3.00"), dt.datetime(2024, 1, 2, 3))]
