"""Ingestion operators re-aimed from single-process scripts.

Parsing of pages and API payloads, request planning, arrival checks,
message keys and contract checks all become column expressions over
DataFrames, so they scale with the number of rows instead of running in one
scraper process.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakefold.functions.clean import day_series, format_day, month_series, node_text, url_term
from lakefold.session import stage

# Fixed values of the public APIs' envelopes.
#: Air-quality API: success code in ``response.header.resultCode``.
ENVELOPE_OK = "00"
#: Statistics API: an ``err`` code containing this text means "no data".
NO_DATA_CODE = "30"
#: Search result paging: 10 results per page, first result number 1.
PAGE_SIZE = 10
#: Statistics API request parameters (the API key is session configuration
#: and never part of a plan).
#: News search request layout up to the keyword, the days and the result number.
SEARCH_QUERY, SEARCH_FROM, SEARCH_TO, SEARCH_START = "?where=news&query=", "&sort=1&pd=3&ds=", "&de=", "&start="
STATS_PARAMS = "method=getList&orgId=101&tblId=DT_1B040A3&itmId=T20&loadGubun=2&prdSe=M&format=json&jsonVD=Y"


# --------------------------------------------------------------------------
# R1 listing pages
# --------------------------------------------------------------------------


def listing_extract(
    df: DataFrame,
    html_col: str,
    fields: dict[str, str],
    keep: Iterable[str] = (),
    text_fields: Iterable[str] = (),
) -> DataFrame:
    """One row per listed item of each page.

    ``fields`` maps an output name to a regular expression whose group 1 is
    the value; every match on the page yields one value.  The per-field
    lists are zipped by position and cut to the shortest list (a page with
    three titles and two publishers gives two rows).  Zipping is per page,
    so a missing field on one page cannot shift the rows of later pages.
    ``text_fields`` get tags stripped and are trimmed (F20).  ``item_no``
    is the 1-based position on the page.
    """
    keep = list(keep)
    names = list(fields)
    text_fields = set(text_fields)
    arrays = df.select(
        *keep,
        *[F.regexp_extract_all(F.col(html_col), F.lit(p), 1).alias(n) for n, p in fields.items()],
    )
    shortest = F.least(*[F.size(n) for n in names]) if len(names) > 1 else F.size(names[0])
    zipped = arrays.select(*keep, F.slice(F.arrays_zip(*names), 1, shortest).alias("__items"))
    rows = zipped.select(*keep, F.posexplode("__items").alias("__pos", "__it"))
    return rows.select(
        *keep,
        (F.col("__pos") + 1).alias("item_no"),
        *[
            (node_text(F.col(f"__it.{n}")) if n in text_fields else F.col(f"__it.{n}")).alias(n)
            for n in names
        ],
    )


def listing_items(
    df: DataFrame,
    html_col: str,
    item: str,
    fields: dict[str, str],
    keep: Iterable[str] = (),
    text_fields: Iterable[str] = (),
) -> DataFrame:
    """One row per listed item of each page, fields taken from the item's own
    block: ``item`` matches a block (use ``(?s)`` where it spans lines), a
    field is group 1 of its pattern's first match inside the block, or null.
    A field that one item lacks cannot shift the fields of the others."""
    keep = list(keep)
    text_fields = set(text_fields)
    blocks = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(item), F.lit(0))).alias("__pos", "__block"))

    def field(name: str, pattern: str) -> Column:
        value = F.when(F.col("__block").rlike(pattern), F.regexp_extract("__block", pattern, 1))
        return (node_text(value) if name in text_fields else value).alias(name)

    return blocks.select(*keep, (F.col("__pos") + 1).alias("item_no"), *[field(n, p) for n, p in fields.items()])


# --------------------------------------------------------------------------
# R2 / R3 API payloads
# --------------------------------------------------------------------------


def envelope_schema(item_schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                "response",
                T.StructType(
                    [
                        T.StructField("header", T.StructType([T.StructField("resultCode", T.StringType())])),
                        T.StructField(
                            "body", T.StructType([T.StructField("items", T.ArrayType(item_schema))])
                        ),
                    ]
                ),
            )
        ]
    )


def parse_envelope(df: DataFrame, raw_col: str, item_schema: T.StructType) -> DataFrame:
    """R2: add ``result_code`` and ``items`` parsed from the JSON envelope."""
    parsed = F.from_json(F.col(raw_col), envelope_schema(item_schema))
    return df.withColumns(
        {
            "result_code": parsed["response"]["header"]["resultCode"],
            "items": parsed["response"]["body"]["items"],
        }
    )


def envelope_items(
    df: DataFrame, raw_col: str, item_schema: T.StructType, keep: Iterable[str] = (), strict: bool = False
) -> DataFrame:
    """R2: the items of successful envelopes, one row per item.

    ``strict=True`` raises when any envelope carries another result code (the
    collector treats that as a failed run).
    """
    keep = list(keep)
    parsed = parse_envelope(df, raw_col, item_schema)
    ok = F.col("result_code") == F.lit(ENVELOPE_OK)
    if strict:
        bad = parsed.filter(~ok | F.col("result_code").isNull()).limit(1).collect()
        if bad:
            raise ValueError(f"API envelope with result code {bad[0]['result_code']!r}")
    return (
        parsed.filter(ok)
        .select(*keep, F.posexplode("items").alias("item_no", "__it"))
        .select(*keep, (F.col("item_no") + 1).alias("item_no"), "__it.*")
    )


def envelope_errors(df: DataFrame, raw_col: str, item_schema: T.StructType) -> DataFrame:
    """R2: envelopes whose result code is not the success code."""
    parsed = parse_envelope(df, raw_col, item_schema)
    return parsed.filter(
        F.col("result_code").isNull() | (F.col("result_code") != F.lit(ENVELOPE_OK))
    ).drop("items")


def api_status(raw: Column, rows: Column) -> Column:
    """``ok`` (a list payload that parsed as ``rows``), ``empty`` (``err``
    containing the no-data code) or ``error`` (any other ``err``, a list
    that is cut off, or other unparseable text)."""
    err = F.get_json_object(raw, "$.err")
    is_list = F.ltrim(raw).startswith("[") & rows.isNotNull()
    return (
        F.when(is_list, F.lit("ok"))
        .when(err.contains(NO_DATA_CODE), F.lit("empty"))
        .otherwise(F.lit("error"))
    )


def api_result(
    df: DataFrame, raw_col: str, item_schema: T.StructType, keep: Iterable[str] = (), strict: bool = False
) -> DataFrame:
    """One row per item of every successful payload (a JSON list of
    rows; the rows of all requests form one flat table); ``empty`` payloads
    (an ``err`` with the no-data code) are skipped; ``error`` payloads give
    one row with null items, or raise with ``strict=True`` as the collector
    does.  Output: ``keep``, ``status``, ``item_no``, item fields."""
    keep = list(keep)
    rows = F.from_json(F.col(raw_col), T.ArrayType(item_schema))
    parsed = df.withColumn("__items", rows)
    tagged = parsed.select(*keep, api_status(F.col(raw_col), F.col("__items")).alias("status"), "__items")
    if strict:
        bad = tagged.filter(F.col("status") == "error").limit(1).collect()
        if bad:
            raise ValueError(f"API error payload for {[bad[0][k] for k in keep]}")
    # one pass over the payloads: an error is a list of one null item
    ok = F.col("status") == "ok"
    items = F.when(ok, F.col("__items")).otherwise(F.array(F.lit(None).cast(item_schema)))
    rows = tagged.filter(F.col("status") != "empty").select(*keep, "status", F.posexplode(items).alias("item_no", "__it"))
    return rows.select(*keep, "status", F.when(ok, F.col("item_no") + 1).alias("item_no"), "__it.*")


# --------------------------------------------------------------------------
# R4 request planning, R5 arrival
# --------------------------------------------------------------------------


def request_plan(
    keywords: DataFrame,
    keyword_col: str,
    start: Column,
    end: Column,
    base_url: str,
    freq: str = "day",
    pages: int = 1,
    keep: Iterable[str] = (),
    quote: bool = True,
) -> DataFrame:
    """One request row per keyword x period (x result page).

    Each keyword row generates its own period series (a generator, not a
    cross join).  ``quote`` wraps the keyword in double quotes (an exact
    phrase search, as the news collector sends it).  ``freq="day"``: the
    search layout ``where=news&query=..&sort=1&pd=3&ds=D&de=D&start=N`` with
    ``D`` as ``yyyy.MM.dd`` and ``N = 1 + 10 * page``; ``freq="month"``: the
    statistics layout with ``startPrdDe=endPrdDe=yyyyMM``.
    """
    keep = list(keep)
    if freq == "day":
        series, fmt = day_series(start, end), "yyyy.MM.dd"
    elif freq == "month":
        series, fmt = month_series(start, end), "yyyyMM"
    else:
        raise ValueError("freq must be 'day' or 'month'")
    term = F.concat(F.lit('"'), F.col(keyword_col), F.lit('"')) if quote else F.col(keyword_col)
    periods = keywords.select(*keep, term.alias("keyword"), F.explode(series).alias("period"))
    paged = periods.select("*", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))
    label = format_day("period", fmt)
    if freq == "day":
        url = F.concat(
            F.lit(base_url), F.lit(SEARCH_QUERY), url_term("keyword"),
            F.lit(SEARCH_FROM), label, F.lit(SEARCH_TO), label, F.lit(SEARCH_START),
            (F.lit(1) + F.lit(PAGE_SIZE) * F.col("page")).cast("string"),
        )
    else:
        url = F.concat(
            F.lit(base_url), F.lit("?"), F.lit(STATS_PARAMS), F.lit("&objL1="), url_term("keyword"),
            F.lit("&startPrdDe="), label, F.lit("&endPrdDe="), label,
        )
    return paged.select(*keep, "keyword", label.alias("period"), "page", url.alias("url"))


def backfill_plan(
    keywords: DataFrame,
    arrived: DataFrame,
    keyword_col: str,
    day_col: str,
    start: Column,
    end: Column,
    base_url: str,
    max_days: int | None = None,
    quote: bool = True,
) -> DataFrame:
    """R4 + R5: the fewest requests that fetch what is missing.

    ``arrived`` holds the (keyword, day) pairs that landed; of the days from
    ``start`` to ``end`` that a keyword lacks, neighbouring ones form one
    range, and each range is one request (of ``max_days`` at most).  Only the
    distinct days of a keyword are gathered, which the period bounds, so a
    keyword may hold any share of the rows.  Returns the keyword, ``first_day``,
    ``last_day``, ``n_days`` and the ``url`` of the range's first page.
    """
    wanted = keywords.select(keyword_col).distinct().withColumn("__days", day_series(start, end))
    known = (arrived.filter(F.col(day_col).between(start, end)).groupBy(F.col(keyword_col).alias("__k"))
             .agg(F.collect_set(day_col).alias("__known")))
    missing = wanted.join(known, F.col(keyword_col) == F.col("__k"), "left").select(keyword_col, F.array_except(
        "__days", F.coalesce("__known", F.array().cast("array<date>"))).alias("__m"))
    opens = F.filter("__m", lambda d, i: (i == 0) | (F.date_diff(d, F.get(F.col("__m"), i - 1)) > 1))
    closes = F.filter("__m", lambda d, i: (i == F.size("__m") - 1) | (F.date_diff(F.get(F.col("__m"), i + 1), d) > 1))
    ranges = missing.select(keyword_col, F.explode(F.arrays_zip(opens.alias("lo"), closes.alias("hi"))).alias("r")).select(
        keyword_col, F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    if max_days:
        steps = F.sequence(F.lit(0), F.date_diff("hi", "lo"), F.lit(max_days))
        ranges = ranges.select(keyword_col, "hi", F.col("lo"), F.explode(steps).alias("at")).select(
            keyword_col, F.date_add("lo", F.col("at")).alias("lo"), F.least("hi", F.date_add("lo", F.col("at") + max_days - 1)).alias("hi"))
    term = F.concat(F.lit('"'), F.col(keyword_col), F.lit('"')) if quote else F.col(keyword_col)
    day = lambda c: format_day(c, "yyyy.MM.dd")
    return ranges.withColumn("__term", term).select(
        keyword_col, F.col("lo").alias("first_day"), F.col("hi").alias("last_day"), (F.date_diff("hi", "lo") + 1).alias("n_days"),
        F.concat(F.lit(base_url), F.lit(SEARCH_QUERY), url_term("__term"), F.lit(SEARCH_FROM), day("lo"), F.lit(SEARCH_TO), day("hi"),
                 F.lit(SEARCH_START), F.lit("1")).alias("url"))


def arrival_report(
    bronze: DataFrame, day_col: str, start: Column | None = None, end: Column | None = None, pad_days: int = 0
) -> DataFrame:
    """One row per expected day with the rows that arrived and a flag.
    The per-day counts are staged: bounds and report both read them.

    The expected days run from ``start`` to ``end`` (default: the data's own
    first and last day, widened by ``pad_days``).  The per-day counts are an
    aggregate over the (partition-pruned) Bronze scan.
    """
    counts = stage(bronze.groupBy(F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("n_rows")), "arrival-counts")
    bounds = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    lo = start if start is not None else F.date_sub(F.col("lo"), pad_days)
    hi = end if end is not None else F.date_add(F.col("hi"), pad_days)
    calendar = bounds.select(F.explode(day_series(lo, hi)).alias("day"))
    counts = counts.filter(F.col("day").isNotNull())
    report = calendar.join(counts, "day", "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    return report.select("day", n.alias("n_rows"), (n > 0).alias("arrived"))


# --------------------------------------------------------------------------
# R7 message keys, R8 contracts
# --------------------------------------------------------------------------


def with_message_key(df: DataFrame, key_col: str = "message_key") -> DataFrame:
    """A random UUID per record.  Non-deterministic: write or checkpoint
    the result before reading it twice."""
    return df.withColumn(key_col, F.expr("uuid()"))


def with_stable_key(df: DataFrame, columns: Iterable[str] | None = None, key_col: str = "message_key") -> DataFrame:
    """R7 for messages that may be sent again: a digest of the record (or of
    ``columns``), the same for every copy of it."""
    own = list(columns or df.columns)
    return df.withColumn(key_col, F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256))


def contract_errors(df: DataFrame, required: Iterable[str], coerce: bool = True) -> DataFrame:
    """Add ``contract_errors`` (array of ``missing:<col>`` /
    ``type:<col>``).  Every field must be text; with ``coerce=True`` other
    types are cast to text first (what a string-typed record would carry)."""
    required = list(required)
    schema = {f.name: f.dataType for f in df.schema.fields}
    checks = []
    for c in required:
        checks.append(F.when(F.col(c).isNull(), F.lit(f"missing:{c}")))
    if not coerce:
        for c, t in schema.items():
            if not isinstance(t, T.StringType):
                checks.append(F.when(F.col(c).isNotNull(), F.lit(f"type:{c}")))
    out = df
    if coerce:
        out = df.select(
            *[F.col(c).cast("string").alias(c) if not isinstance(t, T.StringType) else F.col(c) for c, t in schema.items()]
        )
    errs = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return out.withColumn("contract_errors", errs)


def split_contract(
    df: DataFrame, required: Iterable[str], coerce: bool = True, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; ``rejected`` keeps ``contract_errors``.
    With ``strict=True`` reading the valid records raises at the first one
    that is rejected; no job runs before."""
    checked = contract_errors(df, required, coerce)
    fine = F.size("contract_errors") == 0
    if strict:
        broken = F.raise_error(F.concat(F.lit("records violate the contract: "), F.array_join("contract_errors", ", ")))
        fine = F.when(fine, F.lit(True)).otherwise(broken.cast("boolean"))
    valid = checked.filter(fine).drop("contract_errors")
    return valid, checked.filter(F.size("contract_errors") > 0)
