"""Multi-line assembly and log parsing (FIXTURES 19-22)."""

import datetime as dt


from lakefold.functions import logtext
from lakefold.operators.multiline import assemble_events, read_log_files


def test_multiline_two_events(spark):
    text = "22/11/14 10:11:12 INFO A: start\n\tat x.y(Z.java:1)\n22/11/14 10:11:13 WARN B: next"
    df = spark.createDataFrame([(1, text)], "id int, text string")
    out = assemble_events(df, "text").orderBy("event_no").collect()
    assert [(r.event_no, r.first_line, r.n_lines) for r in out] == [(1, 1, 2), (2, 3, 1)]
    assert out[0].event == "22/11/14 10:11:12 INFO A: start\n\tat x.y(Z.java:1)"


def test_multiline_leading_continuation_is_own_event(spark):
    df = spark.createDataFrame([(1, "orphan\n22/11/14 10:11:12 INFO A: x"), (2, None)], "id int, text string")
    out = assemble_events(df, "text").collect()
    assert sorted((r.id, r.event) for r in out) == [(1, "22/11/14 10:11:12 INFO A: x"), (1, "orphan")]


def test_read_log_files_keeps_line_order(spark, tmp_dir):
    lines = []
    for i in range(300):
        lines.append(f"22/11/14 10:{i // 60:02d}:{i % 60:02d} INFO App: event {i}")
        if i % 3 == 0:
            lines.append(f"\tcontinuation of {i}")
    with open(f"{tmp_dir}/app.log", "w") as fh:
        fh.write("\n".join(lines))
    out = read_log_files(spark, f"{tmp_dir}/*.log").orderBy("event_no").collect()
    assert len(out) == 300
    assert out[3].event == "22/11/14 10:00:03 INFO App: event 3\n\tcontinuation of 3"


def parse(spark, msg):
    df = spark.createDataFrame([(msg,)], "m string")
    return df.select(*[c.alias(n) for n, c in logtext.parse_columns("m").items()]).first()


def test_clean_message(spark):
    df = spark.createDataFrame([("a\x00b\nc\\d\te",)], "m string")
    assert df.select(logtext.clean_message("m")).first()[0] == "abcd\te"


def test_parse_fields(spark):
    r = parse(spark, "[w1] 22/11/14 10:11:12 INFO X: m")
    assert (r.log_level, r.host_name, r.spark_datestamp) == ("INFO", "w1", "22/11/14 10:11:12")
    assert r.log_ts == dt.datetime(2022, 11, 14, 10, 11, 12)


def test_parse_no_match(spark):
    r = parse(spark, "no level")
    assert (r.log_level, r.host_name, r.spark_datestamp, r.log_ts) == (None, "no", None, None)


def test_datestamp_eu_shift(spark):
    r = parse(spark, "[h] 33/11/14 10:11:12 ERROR X: m")
    assert r.spark_datestamp == "3/11/14 10:11:12"
    assert r.log_level == "ERROR"


def test_datestamp_not_followed_by_digit(spark):
    r = parse(spark, "[h] 12/11/14 10:11:123 x")
    assert r.spark_datestamp is None or not r.spark_datestamp.endswith("12")


def test_with_host(spark):
    df = spark.createDataFrame([("w1", "msg")], "h string, m string")
    assert df.select(logtext.with_host("h", "m")).first()[0] == "[w1] msg"


def test_read_text_lines(spark, tmp_dir):
    from lakefold.sources.files import preview, read_text_lines

    with open(f"{tmp_dir}/a.log", "w") as fh:
        fh.write("one\ntwo\n")
    lines = read_text_lines(spark, f"{tmp_dir}/*.log")
    assert sorted(r.line for r in lines.collect()) == ["one", "two"]
    assert all(r.file_path.endswith("a.log") for r in lines.collect())
    assert preview(lines, 1).count() == 1


def test_multiline_crlf(spark):
    df = spark.createDataFrame([(1, "22/11/14 10:11:12 INFO A: x\r\n\tmore\r\n22/11/14 10:11:13 INFO B: y")], "id int, text string")
    out = assemble_events(df, "text").orderBy("event_no").collect()
    assert [r.event for r in out] == ["22/11/14 10:11:12 INFO A: x\n\tmore", "22/11/14 10:11:13 INFO B: y"]


def test_file_cut_into_splits_gives_the_same_events(spark, tmp_dir):
    from test_skew import conf

    lines = ["orphan"]
    for i in range(400):
        lines.append(f"22/11/14 10:{i // 60:02d}:{i % 60:02d} INFO App: event {i}")
        lines += [f"\tframe {j} of {i} " + "x" * (i % 40) for j in range(i % 7)]
    text = "\n".join(lines)
    with open(f"{tmp_dir}/big.log", "w") as fh:
        fh.write(text)
    with conf(spark, {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}):
        split = read_log_files(spark, f"{tmp_dir}/*.log").drop("file_path")
        assert spark.read.text(f"{tmp_dir}/big.log").rdd.getNumPartitions() > 5
        got = sorted(tuple(r) for r in split.collect())
    whole = assemble_events(spark.createDataFrame([(1, text)], "id int, text string"), "text").drop("id")
    assert got == sorted(tuple(r) for r in whole.collect())
