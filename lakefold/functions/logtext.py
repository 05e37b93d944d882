"""Log-line column functions (shipper prefix, clean-up, field extraction).

The patterns are the public grok definitions written without lookaround,
so the same text runs in Java regex (Spark) and RE2 (the SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the public grok pattern set.
#: LOGLEVEL alternation, in its published order.
LOGLEVEL = (
    "([Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|"
    "[Ii]nfo?(?:rmation)?|INFO?(?:RMATION)?|[Ww]arn?(?:ing)?|WARN?(?:ING)?|"
    "[Ee]rr?(?:or)?|ERR?(?:OR)?|[Cc]rit?(?:ical)?|CRIT?(?:ICAL)?|[Ff]atal|"
    "FATAL|[Ss]evere|SEVERE|EMERG(?:ENCY)?|[Ee]merg(?:ency)?)"
)
#: USERNAME.
USERNAME = "([a-zA-Z0-9._-]+)"
#: DATESTAMP = DATE[- ]TIME with DATE = DATE_US|DATE_EU.  The trailing
#: "not followed by a digit" lookahead of TIME is expressed as a consumed
#: non-digit (or end) outside the captured group.
_MONTHNUM = "(?:0?[1-9]|1[0-2])"
_MONTHDAY = "(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])"
_YEAR = "(?:[0-9][0-9]){1,2}"
_HOUR = "(?:2[0123]|[01]?[0-9])"
_MINUTE = "(?:[0-5][0-9])"
_SECOND = "(?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)"
_DATE_US = f"{_MONTHNUM}[/-]{_MONTHDAY}[/-]{_YEAR}"
_DATE_EU = f"{_MONTHDAY}[./-]{_MONTHNUM}[./-]{_YEAR}"
_TIME = f"{_HOUR}:{_MINUTE}(?::{_SECOND})"
DATESTAMP = f"((?:{_DATE_US}|{_DATE_EU})[- ]{_TIME})(?:[^0-9]|$)"
#: Log4j timestamp layout of the application logs.
LOG_TIME_FORMAT = "yy/MM/dd HH:mm:ss"
#: Event-start line pattern of the shipper's multi-line rule.
EVENT_START = r"^([\d/]{6,8} [\d:]{6,8})"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_host(host: Column | str, message: Column | str) -> Column:
    """F16: ``[host] message`` as the shipper formats it."""
    return F.format_string("[%s] %s", _c(host), _c(message))


def clean_message(col: Column | str) -> Column:
    """remove NUL, newline and backslash characters."""
    return F.regexp_replace(_c(col), "[\\x00\\n\\\\]", "")


def log_level(col: Column | str) -> Column:
    """first `` LEVEL`` in the message; null when there is none."""
    return F.nullif(F.regexp_extract(_c(col), " " + LOGLEVEL, 1), F.lit(""))


def host_name(col: Column | str) -> Column:
    """first ``[a-zA-Z0-9._-]+`` run; null when there is none."""
    return F.nullif(F.regexp_extract(_c(col), USERNAME, 1), F.lit(""))


def datestamp(col: Column | str) -> Column:
    """the first date-time text (US or EU date, then a time)."""
    return F.nullif(F.regexp_extract(_c(col), DATESTAMP, 1), F.lit(""))


def log_time(col: Column | str, fmt: str = LOG_TIME_FORMAT) -> Column:
    """F15 companion: the date text as a timestamp (null when it does not
    fit the log layout)."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def parse_columns(message: Column | str) -> dict[str, Column]:
    """All parsed fields of one (cleaned) message, for ``withColumns``."""
    m = _c(message)
    stamp = datestamp(m)
    return {
        "log_level": log_level(m),
        "host_name": host_name(m),
        "spark_datestamp": stamp,
        "log_ts": log_time(stamp),
    }
