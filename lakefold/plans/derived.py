"""Bronze-shaped inputs derived from the driver tables.

The reference's feeds (news listings, air-quality readings, census codes,
application logs, API payloads, Kafka records) are not part of the test
data, so each is derived from a driver table with built-in expressions.
Every derivation reads a whole table and grows with it; the matching SQL
for the oracle lives in ``lakefold.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.functions.logtext import with_host
from lakefold.session import read_table

# Fixed parameters of the derived feeds.
NEWS_BASE_URL = "https://news.example.com/"
NEWS_FIRST_DAY = "2024-01-01"
NEWS_DAYS = 30
NEWS_RUN1_LAST_DAY = 19          # first run lands days 0..19 of the cycle
AIR_RUN1_END = "2024-01-20 00:00:00"
CENSUS_RUN1_END = "1999-01-01 00:00:00"
LOG_LEVELS = {"view": "INFO", "click": "DEBUG", "purchase": "WARN", "signup": "TRACE"}
LOG_DEFAULT_LEVEL = "ERROR"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# -- news --------------------------------------------------------------------


def news_bronze(documents: DataFrame) -> DataFrame:
    """Documents as scraped news rows: ``source`` is the publisher, the first
    line the title, the whole text the description, a text-hash URL (copies
    of a text share a URL) and the language as a quoted two-word keyword."""
    day = (F.col("doc_id") % NEWS_DAYS).cast("int")
    return documents.select(
        F.date_format(F.date_add(F.lit(NEWS_FIRST_DAY).cast("date"), day), "yyyy.MM.dd").alias("publish_date"),
        F.col("source").alias("publisher"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit(NEWS_BASE_URL), F.col("lang"), F.lit("/"), F.sha2("text", 256)).alias("url"),
        F.col("text").alias("description"),
        F.concat(F.lit('"'), F.col("lang"), F.lit(' news"')).alias("keyword"),
        day.alias("cycle_day"),
    )


def news_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First run: the rows of cycle days 0..19; second run: all of Bronze
    (every run re-reads the whole feed)."""
    bronze = news_bronze(table(spark, sf_dir, "documents"))
    first = bronze.filter(F.col("cycle_day") <= NEWS_RUN1_LAST_DAY).drop("cycle_day")
    return first, bronze.drop("cycle_day")


def listing_pages(documents: DataFrame) -> DataFrame:
    """A result page per document: one item per line of the text, the title
    with a tag inside and a line break, every third item without publisher."""
    def item(line: Column, i: Column) -> Column:
        no = (i + 1).cast("string")
        press = F.when((i + 1) % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit('<span class="press">'), F.col("source"), F.lit("</span>")))
        return F.concat(
            F.lit('<li class="item">\n<a target="_blank" class="title" href="'), F.lit(NEWS_BASE_URL), F.col("doc_id").cast("string"),
            F.lit("/"), no, F.lit('"><b>'), F.regexp_replace(line, "[<>]", ""), F.lit("</b>\nno. "), no, F.lit("</a>"), press,
            F.lit("<p>line "), no, F.lit("</p>\n</li>"))

    lines = F.split("text", "\n", -1)
    return documents.select("doc_id", F.concat(F.lit("<ul>"), F.array_join(F.transform(lines, item), "\n"), F.lit("</ul>")).alias("html"))


# -- air quality -------------------------------------------------------------


def hour24_text(ts: Column, minute_text: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` text where hour 0 is written as hour 24 of the
    previous day (the air-quality feed's convention)."""
    return F.when(
        F.hour(ts) == 0,
        F.concat(F.date_format(ts - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd"), F.lit(" 24:"), minute_text),
    ).otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd HH:"), minute_text))


def air_bronze(events: DataFrame, revision: int) -> DataFrame:
    """Hourly station readings: one row per (event type as province, user
    bucket as city, hour).  City bucket 0 has no city name (a null key
    part).  ``revision`` shifts the measured values so that a later run
    carries revised numbers for the same keys."""
    rev = F.lit(revision)
    hourly = events.groupBy(
        F.col("event_type").alias("sidoName"),
        (F.col("user_id") % 10).alias("city_no"),
        F.date_trunc("hour", "ts").alias("hour_ts"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("user_id").alias("umax"),
        F.min("user_id").alias("umin"),
    )
    return hourly.select(
        "sidoName",
        F.when(F.col("city_no") == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("city"), F.col("city_no").cast("string")))
        .alias("cityName"),
        F.concat(F.lit("City "), F.col("city_no").cast("string")).alias("cityNameEng"),
        F.concat(F.lit("D"), F.col("city_no").cast("string")).alias("districtCode"),
        hour24_text(F.col("hour_ts"), F.lit("00")).alias("dataTime"),
        F.col("n").cast("string").alias("coValue"),
        F.col("umax").cast("string").alias("no2Value"),
        F.when(F.col("n") == 1, F.lit("-")).otherwise(F.col("umin").cast("string")).alias("o3Value"),
        (F.col("n") * 10 + rev).cast("string").alias("pm10Value"),
        (F.col("umax") + rev).cast("string").alias("pm25Value"),
        (F.col("umin") + rev).cast("string").alias("so2Value"),
        F.lit("HOUR").alias("dataGubun"),
        F.lit("00").alias("resultCode"),
    )


def air_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    first = air_bronze(events.filter(F.col("ts") < F.lit(AIR_RUN1_END).cast("timestamp_ntz")), 0)
    return first, air_bronze(events, 1)


# -- census ------------------------------------------------------------------


def census_bronze(spark: SparkSession, sf_dir: str, tbl_id: str, before: str | None = None) -> DataFrame:
    """Monthly order counts per customer nation (5-character codes) and per
    region (2-character top-level codes): a two-level code hierarchy."""
    orders = table(spark, sf_dir, "orders")
    if before is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    per_nation = (
        orders.select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("PRD_DE"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("PRD_DE", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    region_code = F.lpad((F.col("n_regionkey") + 11).cast("string"), 2, "0")
    children = per_nation.select(
        "PRD_DE",
        F.concat(region_code, F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("C1"),
        F.col("n_name").alias("C1_NM"),
        F.lower("n_name").alias("C1_NM_ENG"),
        F.col("n").cast("string").alias("DT"),
    )
    tops = (
        per_nation.groupBy("PRD_DE", "n_regionkey")
        .agg(F.sum("n").alias("n"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "PRD_DE",
            region_code.alias("C1"),
            F.col("r_name").alias("C1_NM"),
            F.lower("r_name").alias("C1_NM_ENG"),
            F.col("n").cast("string").alias("DT"),
        )
    )
    return children.unionByName(tops).select(
        "PRD_DE", "C1", "C1_NM", "C1_NM_ENG", F.lit(tbl_id).alias("TBL_ID"), "DT",
        F.lit("M").alias("PRD_SE"), F.lit("101").alias("ORG_ID"),
    )


def census_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        census_bronze(spark, sf_dir, "DT_A", before=CENSUS_RUN1_END),
        census_bronze(spark, sf_dir, "DT_B"),
    )


# -- logs, payloads, records -----------------------------------------------------


def log_level_of(event_type: Column) -> Column:
    expr = None
    for etype, level in LOG_LEVELS.items():
        expr = (F.when(event_type == etype, F.lit(level)) if expr is None
                else expr.when(event_type == etype, F.lit(level)))
    return expr.otherwise(F.lit(LOG_DEFAULT_LEVEL))


def log_lines(events: DataFrame, with_junk: bool = True) -> DataFrame:
    """Shipped application-log messages: ``[hostN] yy/MM/dd HH:mm:ss LEVEL
    App: props``.  With ``with_junk`` every 4th event carries a stack-trace
    continuation with a newline, a tab and a backslash."""
    message = F.concat(
        F.date_format("ts", "yy/MM/dd HH:mm:ss"), F.lit(" "), log_level_of(F.col("event_type")),
        F.lit(" App: "), F.col("props"),
    )
    line = with_host(F.concat(F.lit("host"), (F.col("user_id") % 5).cast("string")), message)
    if with_junk:
        junk = F.concat(
            F.lit("\n\tat App.run(App.java:"), (F.col("event_id") % 100).cast("string"), F.lit(")\\")
        )
        line = F.when(F.col("event_id") % 4 == 0, F.concat(line, junk)).otherwise(line)
    return events.select("event_id", "ts", "event_type", line.alias("line"))


def kafka_records(events: DataFrame) -> DataFrame:
    """Log messages as Kafka records: ``timestamp``, binary ``value``."""
    lines = log_lines(events, with_junk=False)
    return lines.select(F.col("ts").alias("timestamp"), F.encode("line", "UTF-8").alias("value"))


def envelopes(events: DataFrame) -> DataFrame:
    """Air-API style envelopes: result code 22 for error events, 00
    otherwise; view events carry an empty item list, others two items."""
    code = F.when(F.col("event_type") == "error", F.lit("22")).otherwise(F.lit("00"))
    items = F.when(F.col("event_type") == "view", F.lit("")).otherwise(
        F.concat(F.col("props"), F.lit(',{"k": '), F.col("user_id").cast("string"), F.lit("}"))
    )
    raw = F.concat(
        F.lit('{"response":{"header":{"resultCode":"'), code,
        F.lit('"},"body":{"items":['), items, F.lit("]}}}"),
    )
    return events.select("event_id", raw.alias("raw"))


def api_payloads(events: DataFrame) -> DataFrame:
    """Statistics-API style results: ``err`` 20 (failure) for error events,
    ``err`` 30 (no data) for signups, otherwise a list of three rows."""
    listed = F.concat(
        F.lit("["), F.col("props"), F.lit(',{"k": '), F.col("user_id").cast("string"),
        F.lit("},"), F.col("props"), F.lit("]"),
    )
    raw = (
        F.when(F.col("event_type") == "error", F.lit('{"err":"20","errMsg":"failure"}'))
        .when(F.col("event_type") == "signup", F.lit('{"err":"30","errMsg":"no data"}'))
        .otherwise(listed)
    )
    return events.select("event_id", raw.alias("raw"))


# -- topics with offsets ---------------------------------------------------------


def topic_messages(events: DataFrame) -> DataFrame:
    """Events as messages of a topic per type with three partitions, offsets
    in order of the event; some offsets are lost on the way."""
    from pyspark.sql import Window

    partition = (F.col("user_id") % 3).cast("int")
    numbered = events.select(
        F.col("event_type").alias("topic"), partition.alias("partition"),
        (F.row_number().over(Window.partitionBy("event_type", partition).orderBy("event_id")) - 1).cast("long").alias("offset"),
        F.encode("props", "UTF-8").alias("value"))
    return numbered.filter("offset % 50 NOT IN (7, 8, 9) AND offset NOT BETWEEN 100 AND 120")


# -- growing log files -----------------------------------------------------------

#: Documents whose lines share a log file.
LOG_FILE_DOCS = 500


def write_log_files(documents: DataFrame, folder: str, share: float) -> None:
    """The lines of ``documents`` as log files of a source and a range of
    ids each, up to the first ``share`` of their bytes: a call with a larger
    share finds the files grown, wherever the cut lies.  Files are written
    whole, by name, so a repeated task does no harm.  The window keeps the
    lines of a file in one task: adaptive plans may drop a repartition by the
    key of a join, and deal the join's rows out anew."""
    from pyspark.sql import Window

    from lakefold.sources.logtail import open_fs

    lines = documents.select(
        F.concat(F.url_encode(F.coalesce("source", F.lit(""))), F.lit("-"), F.expr(f"doc_id div {LOG_FILE_DOCS}"), F.lit(".log")).alias("file"),
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).filter(F.col("file").isNotNull())
    order = ["doc_id", "pos", "line"]  # whole, so that each call writes the same
    whole = Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = lines.withColumn("size", F.sum(F.octet_length("line") + 1).over(whole)).sortWithinPartitions("file", *order)

    def write(batches):
        import pyarrow as pa

        filesystem, root = open_fs(folder)
        filesystem.create_dir(root, recursive=True)
        name, out, left = None, None, 0
        for batch in batches:
            for file, line, size in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if out:
                        out.close()
                    name, left = file, int(size * share)
                    out = filesystem.open_output_stream(f"{root}/{file}")
                data = line.encode() + b"\n"
                out.write(data[:left])
                left = max(0, left - len(data))
        if out:
            out.close()
        yield pa.RecordBatch.from_pydict({"done": pa.array([True])})

    ordered.select("file", "line", "size").mapInArrow(write, "done boolean").count()
