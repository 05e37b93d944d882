"""Structured Streaming jobs: run-once append, replay safety, per-batch merge."""

import datetime as dt

from pyspark.sql import functions as F

from lakefold.operators import merge as m
from lakefold.sources.silver import SilverTable
from lakefold.streaming import jobs


def records(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("timestamp"),
        F.encode(F.concat(F.lit("[h] 24/01/01 00:00:00 INFO A: "), F.col("id").cast("string")), "UTF-8").alias("value"),
    )


def test_append_twice_adds_nothing(spark, tmp_dir):
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    records(spark, 50).repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for _ in range(2):
        jobs.log_append_job(spark.readStream.schema(schema).parquet(src), sink, ckpt)
    assert spark.read.parquet(sink).count() == 50
    records(spark, 5, 100).write.mode("append").parquet(src)
    jobs.log_append_job(spark.readStream.schema(schema).parquet(src), sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == 55 and dict(out.dtypes)["value"] == "string"


def test_stream_equals_batch_parse(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    records(spark, 20).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = jobs.parse_log_stream(jobs.decode_messages(spark.readStream.schema(schema).parquet(src)))
    jobs.append_job(stream.drop("log_ts"), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", partition_by=["year", "month", "day"])
    batch = jobs.parse_log_stream(jobs.decode_messages(spark.read.parquet(src))).drop("log_ts")
    got = spark.read.parquet(f"{tmp_dir}/sink").select(*batch.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_merge_stream_and_replay(spark, tmp_dir):
    src = f"{tmp_dir}/events"
    data = [(i % 7, i, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(data, "user_id long, seq long, v string")
    df.repartition(6).write.parquet(src)
    st = SilverTable(spark, f"{tmp_dir}/silver")

    def fold(target, batch):
        return m.merge(target, batch, ["user_id"], update="all", insert="all",
                       on_conflict="latest", order_by=["seq"], when_newer=["seq"])

    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(src)
    jobs.merge_stream_job(stream, st, f"{tmp_dir}/ckpt", fold)
    expected = sorted((u, max(s for uu, s, _ in data if uu == u)) for u in range(7))
    assert sorted((r.user_id, r.seq) for r in st.read().collect()) == expected
    # a rerun on the same checkpoint finds nothing new
    before = st.location()
    jobs.merge_stream_job(spark.readStream.schema(df.schema).parquet(src), st, f"{tmp_dir}/ckpt", fold)
    assert st.location() == before


def count_all(target, batch):
    """Not repeatable: a batch applied twice shows."""
    return target.unionByName(batch)


def test_two_sources_and_a_fresh_checkpoint_lose_nothing(spark, tmp_dir):
    st = SilverTable(spark, f"{tmp_dir}/silver")

    def feed(name, n, ckpt):
        spark.range(n).withColumn("src", F.lit(name)).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
        stream = spark.readStream.schema("id long, src string").parquet(f"{tmp_dir}/{name}")
        jobs.merge_stream_job(stream, st, f"{tmp_dir}/{ckpt}", count_all)

    feed("a", 1, "ckpt_a")
    feed("b", 2, "ckpt_b")  # batch ids start at 0 again
    assert st.read().count() == 3
    feed("a", 3, "ckpt_a")
    st.write(st.read())  # a rewrite in between keeps the marks
    feed("b", 1, "ckpt_b")
    assert st.read().count() == 7
    feed("c", 5, "ckpt_c")
    feed("c", 0, "ckpt_c2")  # a fresh checkpoint reads the source again
    assert st.read().filter("src = 'c'").count() == 10


def test_replayed_batch_is_skipped(spark, tmp_dir):
    """The same batch id applied twice, as after a crash between the table
    write and the checkpoint's commit."""
    import glob
    import os

    src, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/ckpt"
    st = SilverTable(spark, f"{tmp_dir}/silver")
    spark.range(4).coalesce(1).write.parquet(src)

    def job():
        jobs.merge_stream_job(spark.readStream.schema("id long").parquet(src), st, ckpt, count_all)

    job()
    for f in glob.glob(f"{ckpt}/commits/*") + glob.glob(f"{ckpt}/commits/.*.crc"):
        os.remove(f)  # the batch is planned, not committed: it runs again
    before = st.location()
    job()
    assert st.read().count() == 4 and st.location() == before


def test_merge_stream_partitioned(spark, tmp_dir):
    src = f"{tmp_dir}/events"
    data = [(i % 5, i, i % 3) for i in range(30)]
    df = spark.createDataFrame(data, "user_id long, seq long, bucket long")
    df = df.withColumn("part", F.col("user_id") % 2)
    df.repartition(5).write.parquet(src)
    st = SilverTable(spark, f"{tmp_dir}/silver", partition_by=["part"])

    def fold(target, batch):
        return m.merge(target, batch, ["user_id"], update="all", insert="all",
                       on_conflict="latest", order_by=["seq"], when_newer=["seq"])

    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    jobs.merge_stream_job(stream, st, f"{tmp_dir}/ckpt", fold)
    expected = sorted((u, max(s for uu, s, _ in data if uu == u)) for u in range(5))
    assert sorted((r.user_id, r.seq) for r in st.read().collect()) == expected


def test_landing_stream_job(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    records(spark, 30).repartition(2).write.parquet(src)
    schema = spark.read.parquet(src).schema
    jobs.landing_stream_job(spark.readStream.schema(schema).parquet(src), f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt",
                            max_records_per_file=10)
    landed = spark.read.parquet(f"{tmp_dir}/bronze")
    assert landed.count() == 30 and "ingest_date" in landed.columns
    assert len(landed.inputFiles()) >= 3


def test_kafka_source_and_sink_if_available(spark):
    import pytest

    from lakefold.sinks.kafka import publish

    try:
        stream = jobs.kafka_stream(spark, "localhost:1", "t")
    except Exception:
        pytest.skip("Kafka connector not on the classpath")
    assert stream.isStreaming and "value" in stream.columns
    assert callable(publish)


def write_log(path, n, extra=""):
    with open(path, "w") as fh:
        fh.write(f"22/11/14 10:11:1{n} INFO A: start {n}\n\tat x\n22/11/14 10:11:2{n} WARN B: next {n}\n{extra}")


def test_log_file_job_assembles_per_file_and_rejects_growth(spark, tmp_dir):
    import os

    import pytest

    os.makedirs(f"{tmp_dir}/logs")
    for n in range(3):
        write_log(f"{tmp_dir}/logs/app.log.{n}", n)
    args = (spark, f"{tmp_dir}/logs/app.log.*", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    jobs.log_file_job(*args)
    jobs.log_file_job(*args)
    out = spark.read.parquet(f"{tmp_dir}/sink").collect()
    assert len(out) == 6
    assert all(r.n_lines == 2 and r.event.endswith("at x") for r in out if r.event_no == 1)
    write_log(f"{tmp_dir}/logs/app.log.3", 3)
    jobs.log_file_job(*args)
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == 8
    write_log(f"{tmp_dir}/logs/app.log.1", 1, "22/11/14 10:11:30 INFO C: late\n")  # it was not rotated yet
    with pytest.raises(jobs.GrownFileError, match="app.log.1"):
        jobs.log_file_job(*args)


def test_dataset_stream_run_equals_batch_run(spark, tmp_dir):
    from lakefold.plans import datasets, derived

    bronze = derived.census_bronze(spark, "/root/testdata/sf0.001", "DT_S")
    # one file per set of months: a code and its top level arrive together
    bronze.repartition(4, "PRD_DE").write.parquet(f"{tmp_dir}/bronze")
    stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/bronze")
    streamed = datasets.silver_table(spark, datasets.CENSUS, f"{tmp_dir}/silver_s")
    datasets.stream_run(datasets.CENSUS, stream, streamed, f"{tmp_dir}/ckpt")
    batched = datasets.silver_table(spark, datasets.CENSUS, f"{tmp_dir}/silver_b")
    datasets.run(datasets.CENSUS, spark.read.parquet(f"{tmp_dir}/bronze"), batched)
    cols = batched.read().columns
    a = sorted(map(repr, streamed.read().select(*cols).collect()))
    b = sorted(map(repr, batched.read().select(*cols).collect()))
    assert a == b and len(a) > 0


def test_child_only_batch_keeps_labels(spark, tmp_dir):
    """A later micro-batch that brings only a revised code takes its label
    from the table's top-level row."""
    from lakefold.plans import datasets

    schema = "PRD_DE string, C1 string, C1_NM string, C1_NM_ENG string, TBL_ID string, DT string"
    src = f"{tmp_dir}/bronze"
    spark.createDataFrame([("202401", "11", "Seoul", "seoul", "T", "9"), ("202401", "11010", "Jongno", "jongno", "T", "5")],
                          schema).coalesce(1).write.parquet(src)
    st = datasets.silver_table(spark, datasets.CENSUS, f"{tmp_dir}/silver")

    def job():
        datasets.stream_run(datasets.CENSUS, spark.readStream.schema(schema).parquet(src), st, f"{tmp_dir}/ckpt")

    job()
    spark.createDataFrame([("202401", "11010", "Jongno", "jongno", "T", "6")], schema).coalesce(1).write.mode("append").parquet(src)
    job()
    assert sorted((r.C1, r.DT, r.C1_NM_SIDO) for r in st.read().collect()) == [("11", 9, "Seoul"), ("11010", 6, "Seoul")]


def test_labels_do_not_depend_on_the_order_of_arrival(spark, tmp_dir):
    """Top-level rows first, last, between their codes, and renamed later:
    the labels are those of one batch over the final rows."""
    from lakefold.plans import datasets

    schema = "PRD_DE string, C1 string, C1_NM string, C1_NM_ENG string, TBL_ID string, DT string"
    row = lambda p, c, n: (p, c, n, n.lower(), "T", "1")
    tops = [row("202401", "11", "Seoul"), row("202402", "11", "Seoul"), row("202401", "26", "Busan")]
    codes = [row(p, c, f"N{c}") for p in ("202401", "202402", "202403") for c in ("11010", "11020", "26010", "99010")]
    renamed = [row("202401", "11", "Seoul City")]
    want = {(p, c): {"11": {"202401": "Seoul City", "202402": "Seoul"}, "26": {"202401": "Busan"}}.get(c[:2], {}).get(p)
            for p, c, *_ in tops + codes}
    orders = {"tops first": [tops, codes, renamed], "codes first": [codes, tops, renamed],
              "between": [codes[:5], tops[:2] + renamed, codes[5:], tops[2:]]}
    for name, steps in orders.items():
        folder = f"{tmp_dir}/{name.replace(' ', '_')}"
        st = datasets.silver_table(spark, datasets.CENSUS, f"{folder}/silver")
        runs = datasets.silver_table(spark, datasets.CENSUS, f"{folder}/runs")
        for step in steps:
            df = spark.createDataFrame(step, schema).coalesce(1)
            df.write.mode("append").parquet(f"{folder}/bronze")
            datasets.stream_run(datasets.CENSUS, spark.readStream.schema(schema).parquet(f"{folder}/bronze"), st, f"{folder}/ckpt")
            if name != "between":  # there the batch of the rename holds two rows of a key
                datasets.run(datasets.CENSUS, df, runs)
        for table in (st, runs) if name != "between" else (st,):
            got = {(r.PRD_DE.strftime("%Y%m"), r.C1): r.C1_NM_SIDO for r in table.read().collect()}
            if name == "between":
                got = {k: "Seoul City" if v == "Seoul" and k[0] == "202401" else v for k, v in got.items()}
            assert got == want, name
