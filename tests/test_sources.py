"""Readers, Bronze landing, Silver store, registration (FIXTURES 26-28)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.sinks.bronze import land_bronze, land_json_lines, landing_day
from lakefold.sources.catalog import register_table
from lakefold.sources.files import all_string_schema, read_source, split_corrupt
from lakefold.sources.silver import SilverTable


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_malformed_dropped(spark, tmp_dir):
    write(f"{tmp_dir}/csv/a.csv", "a,b\n1,2\n3\n4,5,6\n")
    df = read_source(spark, f"{tmp_dir}/csv", "csv", schema=all_string_schema(["a", "b"]))
    assert [tuple(r) for r in df.collect()] == [("1", "2")]


def test_json_corrupt_kept(spark, tmp_dir):
    write(f"{tmp_dir}/json/a.json", '{"a":1}\n{bad\n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    rows = read_source(spark, f"{tmp_dir}/json", "json", schema=schema).collect()
    assert sorted(((r.a, r._corrupt_record) for r in rows), key=repr) == sorted([(1, None), (None, "{bad")], key=repr)


def test_text_and_unknown_format(spark, tmp_dir):
    write(f"{tmp_dir}/txt/a.txt", "x\ny\n")
    assert read_source(spark, f"{tmp_dir}/txt", "txt").count() == 2
    with pytest.raises(ValueError):
        read_source(spark, f"{tmp_dir}/txt", "xml")


def test_avro_if_available(spark, tmp_dir):
    try:
        spark.range(3).write.format("avro").save(f"{tmp_dir}/avro")
    except Exception:
        pytest.skip("spark-avro module not on the classpath")
    assert read_source(spark, f"{tmp_dir}/avro", "avro").count() == 3


def test_seoul_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 15, 0),)], "ts timestamp_ntz")
    assert df.select(landing_day(F.col("ts"), "Asia/Seoul", source_tz="UTC")).first()[0] == dt.date(2024, 1, 2)


def test_land_bronze_partitions_and_file_size(spark, tmp_dir):
    df = spark.range(2500).select(F.col("id"), F.lit(dt.datetime(2024, 1, 1, 15, 0)).cast("timestamp_ntz").alias("ts"))
    land_bronze(df, f"{tmp_dir}/bronze", ts_col="ts", source_tz="UTC", max_records_per_file=1000)
    land_bronze(df, f"{tmp_dir}/bronze_big", ts_col="ts", source_tz="UTC")
    assert len(spark.read.parquet(f"{tmp_dir}/bronze_big").inputFiles()) == 1
    back = spark.read.parquet(f"{tmp_dir}/bronze")
    assert [tuple(r) for r in back.groupBy("ingest_date").count().collect()] == [(dt.date(2024, 1, 2), 2500)]
    assert back.filter(F.col("ingest_date") == dt.date(2024, 1, 2)).count() == 2500
    assert len(back.inputFiles()) >= 3


def test_json_lines_by_day(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 5, 1, 0))], "id int, ts timestamp_ntz")
    land_json_lines(df, f"{tmp_dir}/jl", "ts")
    assert os.path.isdir(f"{tmp_dir}/jl/year=2024/month=3/day=5")


def test_register_table(spark, tmp_dir):
    spark.range(6).select("id", (F.col("id") % 2).alias("p")).write.partitionBy("p").parquet(f"{tmp_dir}/reg")
    df = register_table(spark, "reg_test_tbl", f"{tmp_dir}/reg")
    assert df.count() == 6
    spark.range(6, 8).select("id", F.lit(5).cast("long").alias("p")).write.mode("append").partitionBy("p").parquet(f"{tmp_dir}/reg")
    assert register_table(spark, "reg_test_tbl", f"{tmp_dir}/reg").count() == 8
    with pytest.raises(ValueError):
        register_table(spark, "bad name;", f"{tmp_dir}/reg")


def data_files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_csv_rows_dropped_do_not_depend_on_the_columns_read(spark, tmp_dir):
    write(f"{tmp_dir}/csv/a.csv", "a,b\n1,2\n3\n4,5,6\n")
    df = read_source(spark, f"{tmp_dir}/csv", "csv", schema=all_string_schema(["a", "b"]))
    assert [r.a for r in df.select("a").collect()] == ["1"] and df.count() == 1


def test_split_corrupt(spark, tmp_dir):
    write(f"{tmp_dir}/json/a.json", '{"a":1}\n{bad\n{"a":2}\n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    good, bad = split_corrupt(read_source(spark, f"{tmp_dir}/json", "json", schema=schema))
    assert sorted(r.a for r in good.collect()) == [1, 2] and good.columns == ["a"]
    assert [r[0] for r in bad.collect()] == ["{bad"]
    good, bad = split_corrupt(spark.range(2))
    assert good.count() == 2 and bad.count() == 0


def test_silver_flat(spark, tmp_dir):
    st = SilverTable(spark, f"{tmp_dir}/silver")
    assert not st.exists()
    assert st.open_or_create(spark.range(10)).count() == 10
    assert st.open_or_create(spark.range(3)).count() == 10
    st.write(st.read().filter("id < 5"), ("w", 7))
    assert st.read().count() == 5 and st.applied("w") == 7 and st.applied("other") is None
    os.makedirs(f"{tmp_dir}/silver/v=crashed")  # an uncommitted write
    st.write(st.read().withColumn("x", F.lit(1)))
    assert st.read().columns == ["id", "x"] and st.read().count() == 5
    assert st.applied("w") == 7  # carried over


def test_silver_replaces_only_touched_partitions(spark, tmp_dir):
    st = SilverTable(spark, f"{tmp_dir}/silver", partition_by=["d"])
    schema = "k int, v string, d date"
    st.write(spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2)), (3, "n", None)], schema), ("w", 1))
    before = data_files(f"{tmp_dir}/silver")
    touched = [(dt.date(2024, 1, 2),), (dt.date(2024, 1, 3),)]
    new = [(2, "B", dt.date(2024, 1, 2)), (4, "c", dt.date(2024, 1, 3))]
    st.replace(spark.createDataFrame(new, schema), touched)
    assert sorted((r.k, r.v) for r in st.read().collect()) == [(1, "a"), (2, "B"), (3, "n"), (4, "c")]
    after = data_files(f"{tmp_dir}/silver")
    kept = {f for f in before if "d=2024-01-02" not in f}
    assert len(kept) == 2 and all(after[f] == before[f] for f in kept)
    assert sorted(r.k for r in st.read(touched).collect()) == [2, 4]
    assert sorted(r.k for r in st.read([(None,)]).collect()) == [3]
    plan = st.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [d#" in plan
    # an emptied partition goes; the result may read the table; columns may be added
    st.replace(st.read(touched).filter("k = 2").withColumn("x", F.lit("new")), touched)
    assert sorted((r.k, r.x) for r in st.read().collect()) == [(1, None), (2, "new"), (3, None)]
    assert st.applied("w") == 1
    with pytest.raises(ValueError):
        st.replace(spark.createDataFrame(new, schema), [(dt.date(2024, 1, 2),)])


def test_silver_boolean_partition(spark, tmp_dir):
    st = SilverTable(spark, f"{tmp_dir}/silver", partition_by=["b"])
    st.write(spark.createDataFrame([(1, True), (2, False)], "k int, b boolean"))
    assert [r.k for r in st.read([(True,)]).collect()] == [1]
    st.replace(spark.createDataFrame([(3, True)], "k int, b boolean"), [(True,)])
    assert sorted(r.k for r in st.read().collect()) == [2, 3]


def test_one_key_batch_leaves_other_news_buckets(spark, tmp_dir):
    from lakefold.plans import datasets, derived

    bronze, _ = derived.news_runs(spark, "/root/testdata/sf0.001")
    st = datasets.silver_table(spark, datasets.NEWS, f"{tmp_dir}/news")
    datasets.run(datasets.NEWS, bronze, st)
    before = data_files(f"{tmp_dir}/news")
    one = bronze.limit(1).withColumn("url", F.lit("https://news.example.com/one"))
    datasets.run(datasets.NEWS, one, st)
    after = data_files(f"{tmp_dir}/news")
    assert len(set(before) - set(after)) <= 1 and len(set(before) & set(after)) > 10
    assert st.read().filter("url = 'https://news.example.com/one'").count() == 1


def test_dataset_run_partitioned_matches_unpartitioned(spark, tmp_dir):
    from lakefold.plans import datasets, derived

    first, second = derived.air_runs(spark, "/root/testdata/sf0.001")
    part = datasets.silver_table(spark, datasets.AIR, f"{tmp_dir}/air_p")
    flat = SilverTable(spark, f"{tmp_dir}/air_f")
    for st in (part, flat):
        datasets.run(datasets.AIR, first, st, datasets.REFERENCE)
        datasets.run(datasets.AIR, second, st, datasets.REFERENCE)
    cols = datasets.AIR_COLUMNS
    a = sorted(map(repr, part.read().select(*cols).collect()))
    b = sorted(map(repr, flat.read().select(*cols).collect()))
    assert a == b and len(a) > 0


def test_register_silver(spark, tmp_dir):
    from lakefold.sources.catalog import register_silver

    st = SilverTable(spark, f"{tmp_dir}/reg_silver", partition_by=["p"])
    st.write(spark.range(6).selectExpr("id", "id % 2 AS p"))
    assert register_silver(spark, "silver_reg_test", st).count() == 6
    st.replace(spark.range(1).selectExpr("id", "id AS p"), [(0,)])
    assert register_silver(spark, "silver_reg_test", st).count() == 4
    spark.catalog.dropTempView("silver_reg_test")


def test_cli_runs_a_dataset(spark, tmp_dir, capsys):
    from lakefold.__main__ import main
    from lakefold.plans import datasets, derived

    first, second = derived.air_runs(spark, "/root/testdata/sf0.001")
    bronze = f"{tmp_dir}/bronze"
    for day, df in (("2024-02-01", first), ("2024-02-02", second)):
        df.write.parquet(f"{bronze}/ingest_date={day}")
        # Bronze is cumulative: the second run reads two revisions of a key
        assert main(["run", "air_quality", "--bronze", bronze, "--silver", f"{tmp_dir}/silver"]) == 0
    st = datasets.silver_table(spark, datasets.AIR, f"{tmp_dir}/silver")
    assert st.read().count() > 0
    with pytest.raises(ValueError):
        main(["run", "air_quality", "--bronze", bronze, "--silver", f"{tmp_dir}/silver_e", "--on-conflict", "error"])
    main(["run", "air_quality", "--bronze", bronze, "--silver", f"{tmp_dir}/silver_w", "--ref", "2024-02-02", "--days", "1"])
    window = datasets.silver_table(spark, datasets.AIR, f"{tmp_dir}/silver_w").read()
    assert window.count() < st.read().count()
    pruned = datasets.landed_between(spark.read.parquet(bronze), "2024-02-02", 1)
    assert "PartitionFilters: [isnotnull(ingest_date" in pruned._jdf.queryExecution().executedPlan().toString()
    # corrupt JSON lines are counted, not merged
    write(f"{tmp_dir}/json/a.json", '{"dataTime":"2024-01-01 01:00","sidoName":"s","cityName":"c"}\n{bad\n')
    main(["run", "air_quality", "--bronze", f"{tmp_dir}/json", "--silver", f"{tmp_dir}/silver_j", "--format", "json"])
    assert "corrupt lines left out: 1" in capsys.readouterr().out
    assert datasets.silver_table(spark, datasets.AIR, f"{tmp_dir}/silver_j").read().count() == 1


def test_runs_leave_no_staged_copies(spark, tmp_dir):
    from lakefold.plans import datasets, derived
    from lakefold.session import ensure_checkpoint_dir

    scratch = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "lakefold")
    bronze = derived.census_bronze(spark, "/root/testdata/sf0.001", "DT_1")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    datasets.run(datasets.CENSUS, bronze, datasets.silver_table(spark, datasets.CENSUS, f"{tmp_dir}/census"))
    datasets.run(datasets.CENSUS, bronze, datasets.silver_table(spark, datasets.CENSUS, f"{tmp_dir}/census"))
    assert set(os.listdir(scratch)) == before


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from lakefold.session import ensure_checkpoint_dir

    def session(master, folder=None):
        seen = {"dir": folder}
        context = SimpleNamespace(
            master=master, getCheckpointDir=lambda: seen["dir"], setCheckpointDir=lambda d: seen.update(dir=d),
            getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))

    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(session(master))
    assert ensure_checkpoint_dir(session("yarn", "hdfs:///ckpt")) == "hdfs:///ckpt"
    assert ensure_checkpoint_dir(session("local[4]"))


def test_delta_merge_is_handed_over(monkeypatch):
    """With Delta's package and extension present, its own merge is called."""
    import sys
    from types import ModuleType, SimpleNamespace

    from lakefold.sources import delta

    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: "io.delta.sql.DeltaSparkSessionExtension"))
    monkeypatch.setitem(sys.modules, "delta", None)
    assert not delta.available(spark)
    calls = []

    class Builder:
        def __getattr__(self, name):
            return lambda *a, **k: calls.append((name, a, k)) or self

    tables = ModuleType("delta.tables")
    tables.DeltaTable = SimpleNamespace(isDeltaTable=lambda s, p: True, forPath=lambda s, p: Builder())
    monkeypatch.setitem(sys.modules, "delta", ModuleType("delta"))
    monkeypatch.setitem(sys.modules, "delta.tables", tables)
    assert delta.available(spark)
    delta.merge_into(spark, "/t", SimpleNamespace(alias=lambda n: n), ["a", "b"], ["v"])
    assert [c[0] for c in calls] == ["alias", "merge", "whenMatchedUpdate", "whenNotMatchedInsertAll", "execute"]
    assert calls[1][1] == ("s", "t.`a` = s.`a` AND t.`b` = s.`b`") and calls[2][2] == {"set": {"v": "s.`v`"}}
