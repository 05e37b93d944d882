"""Cleaning column functions (ANSI-safe).

Each function maps ``Column -> Column`` and stays inside Spark's built-in
expression set, so it compiles into whole-stage codegen and behaves the same
in batch and streaming plans.  Casts and date parses use the ``try_`` forms:
under ANSI mode a plain cast of ``'-'`` raises, while the Bronze feeds
contain such placeholders and must turn them into nulls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the Silver contracts depend on.
#: First run of Hangul syllables, ASCII letters or digits (keyword cleaning).
KEYWORD_PATTERN = "[가-힣a-zA-Z0-9]+"
#: Bronze date formats.
NEWS_DATE_FORMAT = "yyyy.MM.dd"
AIR_TIME_FORMAT = "yyyy-MM-dd HH:mm"
CENSUS_PERIOD_FORMAT = "yyyyMMdd"
#: The end-of-day hour written by the air-quality feed.
HOUR_24 = "24:00"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def keyword(col: Column | str) -> Column:
    """first keyword run; no match gives ``""``, null stays null."""
    return F.regexp_extract(_c(col), KEYWORD_PATTERN, 0)


def parse_date(col: Column | str, fmt: str = NEWS_DATE_FORMAT) -> Column:
    """F2 / F8: strict-width date parse; unparseable text becomes null."""
    return F.try_to_date(_c(col), fmt)


def hour24_text(col: Column | str) -> Column:
    """rewrite ``24:00`` as ``00:00`` (same calendar day, as the feed's
    reference transform does)."""
    return F.regexp_replace(_c(col), HOUR_24, "00:00")


def parse_timestamp(col: Column | str, fmt: str = AIR_TIME_FORMAT) -> Column:
    """timestamp parse; unparseable text (for example an unreplaced
    ``24:00``) becomes null."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def hour24_timestamp(
    col: Column | str, fmt: str = AIR_TIME_FORMAT, roll_day: bool = False
) -> Column:
    """F3 + F4.  ``roll_day=False`` keeps the reference meaning (hour 24 of
    day D becomes 00:00 of day D); ``roll_day=True`` moves it to D + 1,
    which is the instant the feed means."""
    text = _c(col)
    ts = parse_timestamp(hour24_text(text), fmt)
    if not roll_day:
        return ts
    return F.when(text.contains(HOUR_24), ts + F.expr("INTERVAL 1 DAY")).otherwise(ts)


def to_float(col: Column | str) -> Column:
    """text to 32-bit float, null for placeholders such as ``-``."""
    return _c(col).try_cast("float")


def to_int(col: Column | str) -> Column:
    """text to int truncating decimals (``'12.7'`` -> 12, ``'-12.7'`` ->
    -12) as the pre-ANSI cast did; null for placeholders and overflow."""
    return _c(col).try_cast("double").try_cast("int")


def month_period(col: Column | str) -> Column:
    """F7 + F8: ``yyyyMM`` text to the first day of that month."""
    return parse_date(F.concat(_c(col), F.lit("01")), CENSUS_PERIOD_FORMAT)


def code_prefix(col: Column | str, width: int = 2) -> Column:
    """the top-level part of a hierarchical code (1-based substring)."""
    return F.substring(_c(col), 1, width)


def code_length(col: Column | str) -> Column:
    """F10."""
    return F.length(_c(col))


def binary_text(col: Column | str) -> Column:
    """``CAST(binary AS STRING)`` (UTF-8)."""
    return _c(col).cast("string")


def url_term(col: Column | str) -> Column:
    """URL-encode a query term the way the collector's form encoding
    does: UTF-8 bytes percent-encoded, space as ``+``, ``~`` kept and ``*``
    encoded (Java's encoder differs from it on exactly those two)."""
    java = F.url_encode(_c(col))
    return F.regexp_replace(F.regexp_replace(java, "%7E", "~"), "\\*", "%2A")


def format_day(col: Column | str, fmt: str) -> Column:
    """date text such as ``yyyy.MM.dd``, ``yyyyMM``, ``yyyy-MM-dd``."""
    return F.date_format(_c(col), fmt)


def day_series(start: Column | str, end: Column | str) -> Column:
    """inclusive daily series (array of dates)."""
    return F.sequence(_c(start), _c(end), F.expr("INTERVAL 1 DAY"))


def month_series(start: Column | str, end: Column | str) -> Column:
    """inclusive monthly series from the months of ``start``/``end``."""
    return F.sequence(
        F.trunc(_c(start), "MM"), F.trunc(_c(end), "MM"), F.expr("INTERVAL 1 MONTH")
    )


def node_text(col: Column | str) -> Column:
    """visible text of an HTML fragment: tags removed, trimmed."""
    return F.trim(F.regexp_replace(_c(col), "<[^>]*>", ""))
