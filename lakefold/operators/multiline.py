"""Multi-line event assembly.

A line that does not match the start pattern is appended to the previous
event (the shipper's ``negate: true, match: after`` rule).  For texts in
rows, assembly runs inside each row with higher-order functions: no shuffle,
no window.  Files are assembled from a line scan, split by split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.functions.logtext import EVENT_START
from lakefold.sources.files import read_text_lines


def _start_lines(lines: Column, start_pattern: str) -> Column:
    """1-based numbers of the lines that open an event (line 1 always does)."""
    return F.filter(
        F.sequence(F.lit(1), F.size(lines)),
        lambda i: (i == 1) | F.element_at(lines, i).rlike(start_pattern),
    )


def _events(lines: Column, starts: Column) -> Column:
    """Array of ``struct(event_no, first_line, n_lines, event)``.

    ``lines`` and ``starts`` must be column references: inside a lambda an
    expression is re-evaluated for every element, so passing ``split(...)``
    directly would split the text once per line.
    """
    n = F.size(lines)

    def one(s: Column, j: Column) -> Column:
        end = F.coalesce(F.try_element_at(starts, j + 2), n + 1)
        return F.struct(
            (j + 1).alias("event_no"),
            s.alias("first_line"),
            (end - s).alias("n_lines"),
            F.array_join(F.slice(lines, s, end - s), "\n").alias("event"),
        )

    return F.transform(starts, one)


def assemble_events(
    df: DataFrame, text_col: str, start_pattern: str = EVENT_START, keep: list[str] | None = None
) -> DataFrame:
    """One row per assembled event: ``keep`` columns + ``event_no``,
    ``first_line`` (1-based), ``n_lines`` and ``event`` (lines joined by
    ``\\n``; ``\\r\\n`` line ends are accepted).  Continuation lines before the
    first start line form an event of their own."""
    keep = list(keep or [c for c in df.columns if c != text_col])
    split = df.select(*keep, F.split(F.col(text_col), "\r?\n", -1).alias("__lines"))
    starts = split.select(*keep, "__lines", _start_lines(F.col("__lines"), start_pattern).alias("__starts"))
    return starts.select(
        *keep, F.explode(_events(F.col("__lines"), F.col("__starts"))).alias("__e")
    ).select(*keep, "__e.event_no", "__e.first_line", "__e.n_lines", "__e.event")


def events_of_lines(lines: DataFrame, start_pattern: str = EVENT_START) -> DataFrame:
    """W2 over a line scan (``file_path, block, line_id, line``, see
    ``sources.files.read_text_lines``): splits of a file are assembled side
    by side, whatever the file's size.

    Lines are numbered within their split.  The number of lines and of
    event starts before a split comes from one row per split, so the only
    thing that passes from split to split is the number of the open event:
    a split's leading continuation lines get it and meet their event in the
    final aggregate.  A task holds one split or one event.

    Returns ``file_path, event_no, first_line, n_lines, event``.
    """
    in_split = Window.partitionBy("file_path", "block").orderBy("line_id")
    marked = lines.withColumn("n", F.row_number().over(in_split))
    opens = F.col("line").rlike(start_pattern) | ((F.col("block") == 0) & (F.col("n") == 1))
    marked = marked.withColumn("opens", opens.cast("int")).withColumn("event_in_split", F.sum("opens").over(in_split))
    splits = marked.groupBy("file_path", "block").agg(F.count(F.lit(1)).alias("lines"), F.sum("opens").alias("starts"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file_path", "block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
                            F.coalesce(F.sum("starts").over(before), F.lit(0)).alias("starts_before"))
    placed = marked.join(offsets, ["file_path", "block"]).select(
        "file_path", (F.col("starts_before") + F.col("event_in_split")).cast("int").alias("event_no"),
        (F.col("lines_before") + F.col("n")).cast("int").alias("line_no"), "line")
    return (placed.groupBy("file_path", "event_no")
            .agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
            .select("file_path", "event_no", F.col("l")[0]["line_no"].alias("first_line"), F.size("l").alias("n_lines"),
                    F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("event")))


def read_log_files(spark, path_glob: str, start_pattern: str = EVENT_START) -> DataFrame:
    """S11 + W2: read log files by splits and assemble their events."""
    return events_of_lines(read_text_lines(spark, path_glob), start_pattern)
