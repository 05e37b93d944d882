"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the survey's query table.

Each query reads whole driver tables (or frames Spark derives from them).
Queries that exercise sinks write into a fresh folder under the session's
shared checkpoint folder and read the result back.  Output columns are
aliased to the names used by the SQL oracle; timestamps leave as
``timestamp_ntz`` and 32-bit floats as doubles.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.functions import clean, logtext
from lakefold.operators import dedup, ingest, merge as m, periods
from lakefold.operators.listing import listing_tree
from lakefold.operators.multiline import assemble_events
from lakefold.operators.offsets import drain_report
from lakefold.plans import datasets, derived
from lakefold.plans.derived import table
from lakefold.session import scratch_path, stage
from lakefold.schemas import Contract
from lakefold.sinks.bronze import land_bronze
from lakefold.sinks.kafka import to_records
from lakefold.sources.catalog import register_silver, register_table
from lakefold.sources.compaction import compact
from lakefold.sources.discovery import discover, register_found
from lakefold.sources.files import all_string_schema, read_source
from lakefold.sources.logtail import tail_events
from lakefold.sources.silver import SilverTable
from lakefold.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
ALLOWED_LANGS = ["en", "de", "fr"]
LOOKBACK_REF = "1998-06-02"
ORDERS_TARGET_END = "1999-01-01 00:00:00"
ORDERS_SOURCE_START = "1998-01-01 00:00:00"
LINEITEM_SOURCE_START = "1999-01-01 00:00:00"
EVENTS_TARGET_END = "2024-01-20 00:00:00"
EVENTS_SOURCE_START = "2024-01-10 00:00:00"
UPSERT_CUT = "2024-01-15 00:00:00"
ACCTBAL_TARGET_END = 5000.0
ACCTBAL_SOURCE_START = 2000.0
PLAN_DAILY = ("2024-01-27", "2024-01-29")
PLAN_MONTHLY = ("2023-11-01", "2024-01-01")
PLAN_BASE_URL = "https://search.example.com/news"
LINE_START = "^[A-Z]"
LISTING_FIELDS = {
    "href": '<a href="([^"]*)">',
    "title": '<a href="[^"]*">(.*?)</a>',
}


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _ntz(col):
    return col.cast("timestamp_ntz")


# -- scans, projections, cleaning ----------------------------------------------


def distinct_projection(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return dedup.distinct_rows(periods.allow_list(docs, "lang", ALLOWED_LANGS), ["lang", "source"])


def keyword_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean.keyword("text").alias("keyword"))


def dotted_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    dotted = F.when(F.col("o_orderkey") % 13 == 0, F.date_format("o_orderdate", "yyyy.M.d")).otherwise(
        F.date_format("o_orderdate", "yyyy.MM.dd")
    )
    return o.select("o_orderkey", dotted.alias("dotted")).withColumn(
        "publish_date", clean.parse_date("dotted")
    )


def _half_hour_text(events: DataFrame) -> DataFrame:
    minute = F.when(F.minute("ts") < 30, F.lit("00")).otherwise(F.lit("30"))
    return events.select("event_id", derived.hour24_text(F.col("ts"), minute).alias("data_time_text"))


def hour24_fix(spark, sf_dir):
    t = _half_hour_text(table(spark, sf_dir, "events"))
    return t.withColumn("data_time", _ntz(clean.hour24_timestamp("data_time_text")))


def hour24_roll(spark, sf_dir):
    t = _half_hour_text(table(spark, sf_dir, "events"))
    return t.withColumn("data_time", _ntz(clean.hour24_timestamp("data_time_text", roll_day=True)))


def safe_numeric_cast(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    n = F.col("n_chars").cast("string")
    raw = (
        F.when(F.col("doc_id") % 7 == 0, F.lit("-"))
        .when(F.col("doc_id") % 11 == 0, F.concat(n, F.lit(".7")))
        .when(F.col("doc_id") % 13 == 0, F.concat(F.lit("-"), n, F.lit(".7")))
        .otherwise(n)
    )
    return d.select("doc_id", raw.alias("raw")).select(
        "doc_id", "raw",
        clean.to_float("raw").cast("double").alias("as_float"),
        clean.to_int("raw").alias("as_int"),
    )


def month_period(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("prd_de")).withColumn(
        "period", clean.month_period("prd_de")
    )


def hierarchy_label(spark, sf_dir):
    return datasets.census_transform(derived.census_bronze(spark, sf_dir, "DT_1")).select(*datasets.CENSUS_SILVER)


def lookback_window(spark, sf_dir):
    """Orders of the 3 days before ``ref`` and of the 3 whole months
    before ``ref``'s month (range predicates pushed to the parquet scan)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    days = periods.last_days(o, "o_orderdate", LOOKBACK_REF, 3).withColumn("lookback", F.lit("days"))
    months = periods.last_months(o, "o_orderdate", LOOKBACK_REF, 3).withColumn("lookback", F.lit("months"))
    return days.unionByName(months).select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "lookback"
    )


# -- merges ----------------------------------------------------------------------


def _orders_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < _ts(ORDERS_TARGET_END))
    source = o.filter(F.col("o_orderdate") >= _ts(ORDERS_SOURCE_START)).select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1.5).alias("o_totalprice"), "o_orderdate",
        F.lower("o_orderpriority").alias("o_orderpriority"),
    )
    return target, source


def merge_update_insert(spark, sf_dir):
    t, s = _orders_split(spark, sf_dir)
    return m.update_insert(t, s, ["o_orderkey"], update=["o_totalprice", "o_orderstatus"])


def merge_insert_only(spark, sf_dir):
    t, s = _orders_split(spark, sf_dir)
    return m.insert_only(t, s, ["o_orderkey"])


def merge_delete(spark, sf_dir):
    t, s = _orders_split(spark, sf_dir)
    return m.delete_matched(t, s, ["o_orderkey"])


LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]


def duplicate_rows(spark, sf_dir):
    return dedup.duplicate_rows(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS, ["l_shipdate"])


def _lineitem_source(li: DataFrame) -> DataFrame:
    return dedup.distinct_rows(
        li.filter(F.col("l_shipdate") >= _ts(LINEITEM_SOURCE_START)).withColumn(
            "l_quantity", F.col("l_quantity") + 1
        )
    )


def purge_reference(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return dedup.purge_duplicates(li, _lineitem_source(li), LINEITEM_KEYS, mode="reference")


def purge_keep_latest(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return dedup.purge_duplicates(
        li, _lineitem_source(li), LINEITEM_KEYS, mode="keep_latest", order_by=["l_shipdate"]
    )


def merge_null_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("bigint")).otherwise(F.col("event_id")).alias("event_id"),
        "ts", "user_id", "event_type", "value",
    )
    t = e.filter(F.col("ts") < _ts(EVENTS_TARGET_END))
    s = e.filter(F.col("ts") >= _ts(EVENTS_SOURCE_START))
    return m.insert_only(t, s, ["event_id"])


EVENT_ORDER = ["ts", "event_id"]


def _events_upsert_inputs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    target = m.latest_per_key(e.filter(F.col("ts") < _ts(UPSERT_CUT)), ["user_id"], EVENT_ORDER)
    source = e.filter(F.col("ts") >= _ts(UPSERT_CUT))
    return target, source


def upsert_last_write(spark, sf_dir):
    t, s = _events_upsert_inputs(spark, sf_dir)
    return m.upsert_latest(t, s, ["user_id"], order_by=EVENT_ORDER)


def merge_conflict(spark, sf_dir):
    t, s = _events_upsert_inputs(spark, sf_dir)
    return m.merge_conflicts(t, s, ["user_id"])


def schema_evolution(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    t = c.filter(F.col("c_acctbal") < ACCTBAL_TARGET_END)
    s = c.filter(F.col("c_acctbal") >= ACCTBAL_SOURCE_START).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey", "c_acctbal", "c_mktsegment",
        F.when(F.col("c_acctbal") >= 8000, F.lit("gold")).otherwise(F.lit("std")).alias("c_tier"),
    )
    return m.merge(t, s, ["c_custkey"], update="all", insert="all", evolve=True)


def _profiles(customer: DataFrame) -> DataFrame:
    return customer.select(
        "c_custkey", (F.col("c_custkey") % 4).cast("int").alias("bucket"),
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").cast("int").alias("nation")).alias("profile"),
        (F.col("c_custkey") % 100).cast("int").alias("visits"),
        F.array(F.struct(F.col("c_mktsegment").alias("k"))).alias("tags"),
        F.create_map(F.lit("n"), F.col("c_nationkey").cast("int")).alias("attrs"))


def schema_merge(spark, sf_dir):
    """M7/K1: into a stored table, first a batch with new nested fields and
    wider numbers, which leaves the files of untouched partitions as they
    are; then one whose numbers are texts, which rewrites them."""
    customer = table(spark, sf_dir, "customer")
    st = SilverTable(spark, scratch_path(spark, "silver_profiles"), partition_by=["bucket"])
    st.write(_profiles(customer.filter(F.col("c_acctbal") < ACCTBAL_TARGET_END)))
    wider = _profiles(customer.filter((F.col("c_acctbal") >= ACCTBAL_SOURCE_START) & (F.col("c_custkey") % 4 != 3))).withColumns({
        "profile": F.struct(F.upper("profile.name").alias("name"), "profile.nation", F.lit("new").alias("tier")),
        "visits": F.col("c_custkey").cast("long") * 10_000_000_000,
        "tags": F.transform("tags", lambda t: F.struct(F.lit(7).alias("w"), t["k"].alias("k"))),
        "attrs": F.create_map(F.lit("n"), F.col("c_custkey").cast("long") * 10_000_000_000)})
    texts = _profiles(customer.filter(F.col("c_custkey") % 12 == 0)).withColumn("visits", F.lit("many"))
    states = []
    for step, batch in ((1, wider), (2, texts)):
        touched = st.partition_values(batch)
        st.replace(m.merge(st.read(touched), batch, ["c_custkey"], update="all", insert="all"), touched)
        states.append(stage(st.read().select(
            F.lit(step).alias("step"), F.col("c_custkey").cast("long").alias("c_custkey"), "profile.name", "profile.nation", "profile.tier",
            F.col("visits").cast("string").alias("visits"),
            F.array_join(F.transform("tags", lambda t: F.concat_ws(":", t["k"], t["w"].cast("string"))), ",").alias("tags"),
            F.col("attrs")["n"].alias("attr")), "profiles"))
    return states[0].unionByName(states[1])


# -- dataset runs ------------------------------------------------------------------


def _two_runs(spark, spec, first: DataFrame, second: DataFrame) -> DataFrame:
    """Two scheduled runs, by the reference's rules, into a fresh Silver
    table; the second run folds into the state the first one left."""
    st = datasets.silver_table(spark, spec, scratch_path(spark, f"silver_{spec.name}"))
    datasets.run(spec, first, st, datasets.REFERENCE)
    datasets.run(spec, second, st, datasets.REFERENCE)
    return st.read()


def run_dataset_news(spark, sf_dir):
    first, second = derived.news_runs(spark, sf_dir)
    return _two_runs(spark, datasets.NEWS, first, second).select(*datasets.NEWS_COLUMNS)


def _air_out(silver: DataFrame) -> DataFrame:
    return silver.select(*datasets.AIR_COLUMNS).withColumns(
        {"dataTime": _ntz(F.col("dataTime")), **{c: F.col(c).cast("double") for c in datasets.AIR_FLOAT_COLUMNS}}
    )


def run_dataset_air(spark, sf_dir):
    first, second = derived.air_runs(spark, sf_dir)
    return _air_out(_two_runs(spark, datasets.AIR, first, second))


def run_dataset_air_cumulative(spark, sf_dir):
    """R9 by the production rules: Bronze is append-only, so the second run
    reads both revisions of every measurement and the one that landed last
    wins."""
    first, second = derived.air_runs(spark, sf_dir)
    day = lambda df, d: df.withColumn(datasets.LANDED, F.lit(d).cast("date"))
    st = datasets.silver_table(spark, datasets.AIR, scratch_path(spark, "silver_air"))
    landed = day(first, "2024-02-01"), day(second, "2024-02-02")
    options = datasets.RunOptions(roll_day=False)
    datasets.run(datasets.AIR, landed[0], st, options)
    datasets.run(datasets.AIR, landed[0].unionByName(landed[1]), st, options)
    return _air_out(st.read())


def run_dataset_census(spark, sf_dir):
    first, second = derived.census_runs(spark, sf_dir)
    return _two_runs(spark, datasets.CENSUS, first, second).select(*datasets.CENSUS_SILVER)


def _stream_census(spark, sf_dir, tops_first: bool) -> DataFrame:
    """The top-level rows in a micro-batch of their own, before or after
    those of the other codes."""
    src = scratch_path(spark, "census_stream")
    bronze = stage(derived.census_bronze(spark, sf_dir, "DT_S"), "census_bronze")
    tops, codes = bronze.filter(F.length("C1") == 2).coalesce(1), bronze.filter(F.length("C1") != 2).repartition(2)
    for part in (tops, codes) if tops_first else (codes, tops):
        part.write.mode("append").parquet(src)
    # files are taken in the order of their modification times
    stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 1).parquet(src)
    st = datasets.silver_table(spark, datasets.CENSUS, scratch_path(spark, "silver_census"))
    datasets.stream_run(datasets.CENSUS, stream, st, scratch_path(spark, "census_ckpt"))
    return st.read().select(*datasets.CENSUS_SILVER)


def stream_run_census(spark, sf_dir):
    """T6 for a dataset: the top-level rows arrive in the first micro-batch,
    the other codes in later ones; labels come from the table."""
    return _stream_census(spark, sf_dir, tops_first=True)


def stream_run_census_late(spark, sf_dir):
    """T6 with labels kept up to date: the codes arrive first and are
    labelled when their top-level rows come."""
    return _stream_census(spark, sf_dir, tops_first=False)


# -- sources and sinks -----------------------------------------------------------------


def topic_drain(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    records = events.select(
        F.encode(F.concat(F.lit('{"event_type":"'), F.col("event_type"), F.lit('","props":'), F.col("props"), F.lit("}")), "UTF-8").alias("value")
    )
    decoded = records.select(F.decode("value", "UTF-8").alias("message"))
    return decoded.groupBy(F.get_json_object("message", "$.event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_messages")
    )


def topic_drain_offsets(spark, sf_dir):
    """Run-once drains of topics whose messages come in four files,
    the second pair after the first run; offsets are lost on the way."""
    src, ckpt = scratch_path(spark, "topic"), scratch_path(spark, "topic_ckpt")
    messages = stage(derived.topic_messages(table(spark, sf_dir, "events")), "topic-messages")
    st = SilverTable(spark, scratch_path(spark, "silver_offsets"))
    for half in (0, 1):
        messages.filter(F.pmod(F.xxhash64("topic", "offset"), F.lit(2)) == half).repartition(2).write.mode("append").parquet(src)
        stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(src)
        jobs.drain_job(stream, st, ckpt)
    return drain_report(st.read())


REPLAY_DELAY = "2 hours"


def replayed_messages(spark, sf_dir):
    """Every record is sent twice, those of the last hour of the first
    run once more in the second; each lands once."""
    src, sink, ckpt = (scratch_path(spark, f"replay_{n}") for n in ("src", "sink", "ckpt"))
    keyed = ingest.with_stable_key(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    cut = F.lit(UPSERT_CUT).cast("timestamp")
    first, second = keyed.filter(F.col("ts") < cut), keyed.filter(F.col("ts") >= cut)
    again = first.filter(F.col("ts") >= cut - F.expr("INTERVAL 1 HOUR"))
    for sent in ([first, first], [second, again, second]):
        for part in sent:
            part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(keyed.schema).parquet(src)
        jobs.append_unique_job(stream, "message_key", "ts", REPLAY_DELAY, sink, ckpt)
    landed = spark.read.parquet(sink).drop("message_key")
    return landed.withColumn("ts", _ntz(F.col("ts")))


SCAN_COLUMNS = ["c_custkey", "c_name", "c_nationkey"]


def _csv_files(spark, sf_dir) -> DataFrame:
    """CSV files with a header, plus files where every customer appears again
    as a short (one field) and a long (four fields) row."""
    customer = table(spark, sf_dir, "customer").select(*[F.col(c).cast("string") for c in SCAN_COLUMNS])
    path = scratch_path(spark, "csv_scan")
    customer.write.option("header", True).csv(path)
    customer.select("c_custkey").write.mode("append").option("header", True).csv(path)
    customer.withColumn("extra", F.lit("x")).write.mode("append").option("header", True).csv(path)
    return read_source(spark, path, "csv", schema=all_string_schema(SCAN_COLUMNS))


def csv_scan(spark, sf_dir):
    """Malformed rows are dropped on read."""
    return _csv_files(spark, sf_dir)


def csv_scan_one_column(spark, sf_dir):
    """S3: the same rows are dropped when only one column is read."""
    return _csv_files(spark, sf_dir).select("c_custkey")


def json_scan(spark, sf_dir):
    """JSON lines (each customer once as valid JSON, once corrupt);
    the corrupt lines are kept whole in ``_corrupt_record``."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long"), "c_name", F.col("c_nationkey").cast("long"))
    good = customer.select(F.to_json(F.struct(*SCAN_COLUMNS)).alias("value"))
    bad = customer.select(F.concat(F.lit("{bad json "), F.col("c_custkey").cast("string")).alias("value"))
    path = scratch_path(spark, "json_scan")
    good.unionByName(bad).write.text(path)
    schema = T.StructType(
        [T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
         T.StructField("c_nationkey", T.LongType())]
    )
    return read_source(spark, path, "json", schema=schema)


def text_scan(spark, sf_dir):
    """Plain text lines."""
    path = scratch_path(spark, "text_scan")
    customer = table(spark, sf_dir, "customer")
    customer.select(F.concat_ws("|", *[F.col(c).cast("string") for c in SCAN_COLUMNS]).alias("line")).write.text(path)
    return read_source(spark, path, "txt")


def _land_events(spark, sf_dir) -> str:
    path = scratch_path(spark, "bronze")
    land_bronze(table(spark, sf_dir, "events"), path, ts_col="ts", source_tz="UTC")
    return path


def bronze_landing(spark, sf_dir):
    """K4: land events into Asia/Seoul day folders and count per folder."""
    path = _land_events(spark, sf_dir)
    landed = spark.read.parquet(path)
    return landed.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows"))


def partition_arrival(spark, sf_dir):
    """R5 + F19: expected-day calendar (data span +-2 days) left-joined to
    the landed per-day counts."""
    path = _land_events(spark, sf_dir)
    return ingest.arrival_report(spark.read.parquet(path), "ingest_date", pad_days=2)


def open_or_create(spark, sf_dir):
    """The first call creates the table, the second reopens it
    (the second frame is ignored); the table is then queried through SQL."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    st = SilverTable(spark, scratch_path(spark, "silver_customer"))
    st.open_or_create(customer)
    st.open_or_create(customer.filter(F.col("c_nationkey") == 0))
    name = f"silver_customer_{uuid.uuid4().hex[:10]}"
    register_silver(spark, name, st)
    out = spark.sql(f"SELECT c_custkey, c_name, c_nationkey FROM {name}")
    spark.catalog.dropTempView(name)
    return out


def register_table_query(spark, sf_dir):
    """Partitioned folder registered as a table, queried through SQL."""
    path = scratch_path(spark, "registered_customer")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    customer.repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(path)
    name = f"customer_{uuid.uuid4().hex[:10]}"
    register_table(spark, name, path)
    out = stage(spark.sql(f"SELECT c_nationkey, count(*) AS n_customers FROM {name} GROUP BY c_nationkey"), "registered")
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return out


def discover_tables(spark, sf_dir):
    """One tree with three feeds becomes three registered tables: news by
    landing day, whose later files have a column more; readings in folders
    named by bare dates, with wider numbers later on; customers in folders by
    segment."""
    root = scratch_path(spark, "lake")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.expr("CAST(doc_id % 3 AS INT)").alias("batch"))
    docs.filter("doc_id % 2 = 0").write.partitionBy("batch").parquet(f"{root}/feeds/news")
    docs.filter("doc_id % 2 = 1").withColumn("extra", F.lower("lang")).write.mode("append").partitionBy("batch").parquet(f"{root}/feeds/news")
    readings = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").cast("int").alias("reading"))
    readings.filter("event_id % 2 = 0").write.parquet(f"{root}/feeds/air/2024-01-01")
    readings.filter("event_id % 2 = 1").withColumn("reading", F.col("reading") * F.lit(10_000_000_000)).write.parquet(f"{root}/feeds/air/2024-01-02")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for n in (0, 1):
        customer.filter(F.col("c_custkey") % 2 == n).write.parquet(f"{root}/customers/part{n}")
    out = []
    for t in discover(spark, root):
        name = f"found_{t.name}_{uuid.uuid4().hex[:10]}"
        df = register_found(spark, t, name)
        by = [n for n, _ in t.partitions]
        out.append(stage(df.groupBy(F.array_join(F.array(*[F.col(c).cast("string") for c in by]), "/").alias("partition_value")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(df.columns[0]).alias("n_keys")).select(
            F.lit(t.name).alias("table_name"), F.lit(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)).alias("columns"),
            "partition_value", "n_rows", "n_keys"), "discovered"))
        spark.sql(f"DROP TABLE {name}")
    return out[0].unionByName(out[1]).unionByName(out[2])


def _small_files_table(spark, sf_dir) -> SilverTable:
    """Events by type, appended in five batches of one file per type."""
    events = table(spark, sf_dir, "events")
    st = SilverTable(spark, scratch_path(spark, "silver_events"), partition_by=["event_type"])
    st.write(events.filter("event_id % 5 = 0"))
    for n in range(1, 5):
        events.filter(f"event_id % 5 = {n}").coalesce(1).write.mode("append").partitionBy("event_type").parquet(st.location())
    return st


def compaction(spark, sf_dir):
    """K1/K2: small files of every partition are packed into larger ones; the
    content must not change."""
    st = _small_files_table(spark, sf_dir)
    compact(st)
    return st.read().select(*table(spark, sf_dir, "events").columns)


def compaction_report(spark, sf_dir):
    """K2: files per partition before and after, and whether the table's
    files shrank in number only."""
    st = _small_files_table(spark, sf_dir)
    report = stage(compact(st), "compaction-report")
    rows = st.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))
    named = report.select(F.regexp_extract("folder", "event_type=([^/]*)", 1).alias("event_type"), "files_before", "files_after",
                          (F.col("bytes_after") <= F.col("bytes_before")).alias("no_larger"))
    return named.join(rows, "event_type")


# -- logs ----------------------------------------------------------------------------


def log_assemble(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return assemble_events(docs, "text", LINE_START, keep=["doc_id"])


def log_clean(spark, sf_dir):
    lines = derived.log_lines(table(spark, sf_dir, "events"))
    return lines.select("event_id", logtext.clean_message("line").alias("message"))


def log_parse(spark, sf_dir):
    cleaned = log_clean(spark, sf_dir)
    return cleaned.select("event_id", *[c.alias(n) for n, c in logtext.parse_columns("message").items()]).withColumn(
        "log_ts", _ntz(F.col("log_ts"))
    )


def _records_folder(spark, sf_dir) -> tuple[str, T.StructType]:
    path = scratch_path(spark, "records")
    derived.kafka_records(table(spark, sf_dir, "events")).repartition(4).write.parquet(path)
    return path, spark.read.parquet(path).schema


def log_stream_append(spark, sf_dir):
    """Run-once stream of records into a Silver folder; the
    second run on the same checkpoint must add nothing."""
    src, schema = _records_folder(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "log_sink"), scratch_path(spark, "log_ckpt")
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src)
        jobs.log_append_job(stream, sink, ckpt)
    return spark.read.parquet(sink)


def json_landing(spark, sf_dir):
    """T4/T5/K5: parse the record stream and land JSON lines by day."""
    src, schema = _records_folder(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "json_sink"), scratch_path(spark, "json_ckpt")
    stream = spark.readStream.schema(schema).parquet(src)
    parsed = jobs.parse_log_stream(jobs.decode_messages(stream)).drop("value", "log_ts")
    jobs.append_job(parsed, sink, ckpt, fmt="json", partition_by=["year", "month", "day"])
    landed_schema = T.StructType(
        [T.StructField("timestamp", T.TimestampNTZType()), T.StructField("message", T.StringType()),
         T.StructField("log_level", T.StringType()), T.StructField("host_name", T.StringType()),
         T.StructField("spark_datestamp", T.StringType()), T.StructField("year", T.IntegerType()),
         T.StructField("month", T.IntegerType()), T.StructField("day", T.IntegerType())]
    )
    landed = spark.read.schema(landed_schema).json(sink)
    return landed.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("log_level") == "ERROR").alias("n_error")
    )


def landing_stream(spark, sf_dir):
    """T4: run-once landing of the event stream into ``ingest_date`` folders;
    the second run on the same checkpoint must add nothing."""
    src = scratch_path(spark, "landing_src")
    events = table(spark, sf_dir, "events")
    events.repartition(4).write.parquet(src)
    sink, ckpt = scratch_path(spark, "landing_sink"), scratch_path(spark, "landing_ckpt")
    for _ in range(2):
        jobs.landing_stream_job(spark.readStream.schema(events.schema).parquet(src), sink, ckpt)
    landed = spark.read.parquet(sink).filter(F.col("ingest_date").isNotNull())
    return landed.select(*events.columns)


def stream_merge(spark, sf_dir):
    """Micro-batches folded into a Silver table by ``foreachBatch``
    (latest event per user; order-insensitive, so batch order and replays
    do not change the result)."""
    src = scratch_path(spark, "events_stream")
    events = table(spark, sf_dir, "events")
    events.repartition(8).write.parquet(src)
    st = SilverTable(spark, scratch_path(spark, "silver_users"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(src)

    def fold(target, batch):
        return m.merge(target, batch, ["user_id"], update="all", insert="all",
                       on_conflict="latest", order_by=EVENT_ORDER, when_newer=EVENT_ORDER)

    jobs.merge_stream_job(stream, st, scratch_path(spark, "users_ckpt"), fold)
    return st.read()


TAIL_RANGE_BYTES = 1 << 16


def log_tail(spark, sf_dir):
    """Log files that grow between two runs, the first of which ends
    inside lines and events; the second run closes the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    logs, sink, ckpt = (scratch_path(spark, f"tail_{n}") for n in ("logs", "sink", "ckpt"))
    for share, close in ((0.5, None), (1.0, 0)):
        derived.write_log_files(docs, logs, share)
        jobs.append_job(tail_events(spark, logs, LINE_START, close_idle_seconds=close, range_bytes=TAIL_RANGE_BYTES), sink, ckpt)
    return spark.read.parquet(sink)


# -- ingestion ---------------------------------------------------------------------------


def listing_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return ingest.listing_extract(pages, "html", LISTING_FIELDS, keep=["page_id"], text_fields=["title"])


ITEM_BLOCK = r'(?s)<li class="item">.*?</li>'
ITEM_FIELDS = {
    "title": r'(?s)<a [^>]*class="title"[^>]*>(.*?)</a>',
    "url": r'<a [^>]*href="([^"]*)"',
    "publisher": r'(?s)<span class="press">(.*?)</span>',
    "description": r'(?s)<p>(.*?)</p>',
}


def listing_items(spark, sf_dir):
    """Title, url, publisher and description of every item; titles span
    lines and every third item has no publisher."""
    pages = derived.listing_pages(table(spark, sf_dir, "documents"))
    return ingest.listing_items(pages, "html", ITEM_BLOCK, ITEM_FIELDS, keep=["doc_id"],
                                text_fields=["title", "publisher", "description"])


def listing_tree_query(spark, sf_dir):
    """R1/F20 on raw pages: navigation links, and paragraphs, which lie
    inside one another where they are not closed."""
    pages = table(spark, sf_dir, "pages")
    nav = listing_tree(pages, "html", "nav > ul > li", {"text": ("", "strip"), "extra": ("a", "@href")}, keep=["page_id"])
    paragraphs = listing_tree(pages, "html", "article p", {"text": ("", "strip"), "extra": ("> b", "strip")}, keep=["page_id"])
    return nav.withColumn("listing", F.lit("nav")).unionByName(paragraphs.withColumn("listing", F.lit("article")))


ITEM_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def json_envelope(spark, sf_dir):
    env = derived.envelopes(table(spark, sf_dir, "events"))
    return ingest.envelope_items(env, "raw", ITEM_SCHEMA, keep=["event_id"])


def api_result(spark, sf_dir):
    payloads = derived.api_payloads(table(spark, sf_dir, "events"))
    return ingest.api_result(payloads, "raw", ITEM_SCHEMA, keep=["event_id"])


def api_result_broken(spark, sf_dir):
    """Every payload a second time, cut off before its end: a list that
    does not parse is an error, not silence."""
    payloads = derived.api_payloads(table(spark, sf_dir, "events"))
    cut = payloads.select("event_id", F.expr("substring(raw, 1, length(raw) - 1)").alias("raw"))
    both = payloads.withColumn("cut", F.lit(False)).unionByName(cut.withColumn("cut", F.lit(True)))
    return ingest.api_result(both, "raw", ITEM_SCHEMA, keep=["event_id", "cut"])


def _plan_keywords(spark, sf_dir) -> DataFrame:
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("word")
    )
    return words.distinct().select(F.concat("word", F.lit(" news")).alias("term"))


def request_plan_daily(spark, sf_dir):
    lo, hi = (F.lit(d).cast("date") for d in PLAN_DAILY)
    return ingest.request_plan(_plan_keywords(spark, sf_dir), "term", lo, hi, PLAN_BASE_URL, "day", pages=2)


def request_plan_monthly(spark, sf_dir):
    lo, hi = (F.lit(d).cast("date") for d in PLAN_MONTHLY)
    return ingest.request_plan(_plan_keywords(spark, sf_dir), "term", lo, hi, PLAN_BASE_URL, "month", pages=1)


BACKFILL = ("2024-01-01", "2024-02-29")


def request_backfill(spark, sf_dir):
    """The missing days of every keyword (source and language) as
    the fewest requests."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat_ws(" ", "source", "lang").alias("keyword"),
        F.date_add(F.lit(BACKFILL[0]).cast("date"), ((F.col("doc_id") * 7919) % 67).cast("int")).alias("day"))
    lo, hi = (F.lit(d).cast("date") for d in BACKFILL)
    return ingest.backfill_plan(docs, docs, "keyword", "day", lo, hi, PLAN_BASE_URL)


CONTRACT_REQUIRED = ["c_custkey", "c_name", "c_mktsegment"]


def contract_check(spark, sf_dir):
    c = _customers_with_gaps(spark, sf_dir)
    checked = ingest.contract_errors(c, CONTRACT_REQUIRED)
    reasons = F.array_join("contract_errors", ",")
    return checked.groupBy(
        F.when(F.size("contract_errors") == 0, F.lit("valid")).otherwise(F.lit("rejected")).alias("status"),
        reasons.alias("reasons"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


CUSTOMER_CONTRACT = Contract(
    "customer_topic", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), ("c_custkey", "c_name", "c_mktsegment")
)


def _customers_with_gaps(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        "c_acctbal",
        F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )


def topic_records(spark, sf_dir):
    """K7 + R7 + R8: customer rows as keyed topic records; rows breaking the
    contract are held back, the rest get a UUID key and a JSON value."""
    records, _ = to_records(_customers_with_gaps(spark, sf_dir), CUSTOMER_CONTRACT, strict=False)
    return records.select("value", F.length("key").alias("key_len"))


def message_key(spark, sf_dir):
    keyed = ingest.with_message_key(table(spark, sf_dir, "events").select("event_id"))
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("message_key").alias("n_keys"))


QUERIES: dict[str, Query] = {
    "distinct_projection": distinct_projection,
    "keyword_extract": keyword_extract,
    "dotted_date": dotted_date,
    "hour24_fix": hour24_fix,
    "hour24_roll": hour24_roll,
    "safe_numeric_cast": safe_numeric_cast,
    "month_period": month_period,
    "hierarchy_label": hierarchy_label,
    "lookback_window": lookback_window,
    "merge_update_insert": merge_update_insert,
    "merge_insert_only": merge_insert_only,
    "merge_delete": merge_delete,
    "duplicate_rows": duplicate_rows,
    "purge_reference": purge_reference,
    "purge_keep_latest": purge_keep_latest,
    "merge_null_keys": merge_null_keys,
    "upsert_last_write": upsert_last_write,
    "schema_evolution": schema_evolution,
    "schema_merge": schema_merge,
    "run_dataset_news": run_dataset_news,
    "run_dataset_air": run_dataset_air,
    "run_dataset_air_cumulative": run_dataset_air_cumulative,
    "run_dataset_census": run_dataset_census,
    "stream_run_census": stream_run_census,
    "stream_run_census_late": stream_run_census_late,
    "topic_drain": topic_drain,
    "topic_drain_offsets": topic_drain_offsets,
    "replayed_messages": replayed_messages,
    "merge_conflict": merge_conflict,
    "csv_scan": csv_scan,
    "csv_scan_one_column": csv_scan_one_column,
    "json_scan": json_scan,
    "text_scan": text_scan,
    "bronze_landing": bronze_landing,
    "partition_arrival": partition_arrival,
    "log_assemble": log_assemble,
    "log_clean": log_clean,
    "log_parse": log_parse,
    "log_stream_append": log_stream_append,
    "log_tail": log_tail,
    "stream_merge": stream_merge,
    "landing_stream": landing_stream,
    "listing_extract": listing_extract,
    "listing_items": listing_items,
    "listing_tree": listing_tree_query,
    "json_envelope": json_envelope,
    "api_result": api_result,
    "api_result_broken": api_result_broken,
    "request_plan_daily": request_plan_daily,
    "request_plan_monthly": request_plan_monthly,
    "request_backfill": request_backfill,
    "contract_check": contract_check,
    "message_key": message_key,
    "topic_records": topic_records,
    "json_landing": json_landing,
    "open_or_create": open_or_create,
    "register_table": register_table_query,
    "discover_tables": discover_tables,
    "compaction": compaction,
    "compaction_report": compaction_report,
}
