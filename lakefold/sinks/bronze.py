"""Bronze landing sinks (K4, K5).

Landing adds the landing day as a partition column (``ingest_date=...``
folders), so later reads of "today" or "the last 3 days" prune folders
instead of globbing every day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Landing time zone of the feeds.
LANDING_TIME_ZONE = "Asia/Seoul"


def landing_day(ts: Column | None, time_zone: str, source_tz: str | None = None) -> Column:
    """Calendar day, on the wall clock of ``time_zone``, of an instant.

    ``ts`` None means "now".  A ``timestamp_ntz`` column holds wall-clock
    values of ``source_tz`` (UTC for the event feeds); a ``timestamp``
    column is read in the session time zone (``source_tz`` None)."""
    instant = F.current_timestamp() if ts is None else ts
    local = instant.cast("timestamp_ntz")
    if source_tz is None:
        shifted = F.convert_timezone(None, F.lit(time_zone), local)
    else:
        shifted = F.convert_timezone(F.lit(source_tz), F.lit(time_zone), local)
    return F.to_date(shifted)


def with_landing_day(
    df: DataFrame,
    ts_col: str | None = None,
    time_zone: str = LANDING_TIME_ZONE,
    day_col: str = "ingest_date",
    source_tz: str | None = None,
) -> DataFrame:
    """K4 column: ``ingest_date`` from ``ts_col`` (or the current time)."""
    return df.withColumn(day_col, landing_day(F.col(ts_col) if ts_col else None, time_zone, source_tz))


def land_bronze(
    df: DataFrame,
    path: str,
    ts_col: str | None = None,
    time_zone: str = LANDING_TIME_ZONE,
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
    source_tz: str | None = None,
) -> None:
    """K4: append ``df`` under ``path/ingest_date=YYYY-MM-DD/``.

    Rows are rebalanced by landing day before the write, so each day gets a
    few large files (AQE splits a heavy day).  ``max_records_per_file``
    caps file size in records (the streaming connector flushes every 500 to
    1,000 records, which at batch scale would only produce many tiny files).
    """
    landed = with_landing_day(df, ts_col, time_zone, source_tz=source_tz).hint("rebalance", "ingest_date")
    writer = landed.write.mode("append").partitionBy("ingest_date").format(fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def with_day_parts(df: DataFrame, ts_col: str) -> DataFrame:
    """K5 columns: ``year``, ``month``, ``day`` of ``ts_col``."""
    ts = F.col(ts_col)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def land_json_lines(df: DataFrame, path: str, ts_col: str) -> None:
    """K5: JSON lines under ``year=YYYY/month=M/day=D`` folders."""
    with_day_parts(df, ts_col).write.mode("append").partitionBy("year", "month", "day").json(path)
