"""Following growing log files (S11 + W2).

``log_tail`` is a streaming data source whose offset is a map from each file
to the bytes read of it, so a file may grow between two runs and is never
read twice.  An offset always lies behind a line end: a line that has no end
yet waits.  New bytes are cut into ranges that are read side by side, a line
belonging to the range of its first byte, and the lines of a range are put
together to pieces on the spot:

    event  an event that begins in the range and whose successor does too
    more   the continuation lines before the range's first event
    open   the range's last event, which may go on
    end    the file is closed (idle for ``closeIdleSeconds``)

Complete events go straight to the sink.  Only the two pieces at the edges
of a range pass through streaming state, which keeps the open event of each
file until its successor, or the file's end, is seen.  An event is named by
its file and the position of its first byte, so nothing is numbered across
ranges and one file may hold most of the bytes.

Files under the folder only grow; rotated ones get new names.  A file that
has become shorter than what was read of it raises an error.  Reading ends a
closed file's last line and event; lines that come afterwards begin a new
event.  The offset map has an entry per file present.
"""

from __future__ import annotations

import fnmatch
import re
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lakefold.functions.logtext import EVENT_START

PIECES = "file string, kind string, start long, n_lines int, text string"
EVENTS = "file string, start long, n_lines int, event string"
OPEN_EVENT = "start long, n_lines int, text string"
#: Bytes of a range.
RANGE_BYTES = 64 << 20
#: A reading task has one range while there are no more than ``MIN_TASKS`` of
#: them; above that, consecutive ranges share a task of up to ``TASK_BYTES``.
MIN_TASKS, TASK_BYTES = 200, 64 << 20
_BLOCK, _ROWS = 1 << 20, 2000


def open_fs(path: str):
    """pyarrow's file system and path of a folder or file."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!/)", "file:///", re.sub(r"^s3[an]://", "s3://", path))
    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z][a-z0-9+.-]*:", uri) else (fs.LocalFileSystem(), uri)


class Range(InputPartition):
    """What a task reads, parts of files: (name, from, to, the file's first
    and last new byte, whether the file is closed there)."""

    def __init__(self, parts: list[tuple[str, int, int, int, int, bool]]):
        super().__init__(parts)
        self.parts = parts


class LogTailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*.log")
        self.start_pattern = options.get("startPattern", EVENT_START)
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        idle = options.get("closeIdleSeconds")
        self.idle = None if idle is None else float(idle)
        self.ends: dict[str, tuple[int, int]] = {}  # size -> position behind the last line end, as seen last

    # -- offsets ---------------------------------------------------------------
    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        filesystem, root = open_fs(self.folder)
        files = {}
        for f in filesystem.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = f.path[len(root):].lstrip("/")
            if f.type != fs.FileType.File or not fnmatch.fnmatch(name, self.pattern) or not f.size:
                continue
            closed = self.idle is not None and f.mtime is not None and time.time() - f.mtime.timestamp() >= self.idle
            files[name] = [f.size, 1] if closed else [self._line_end(filesystem, f.path, f.size), 0]
        return {"files": files}

    def _line_end(self, filesystem, path: str, size: int) -> int:
        """Position behind the last line end of a file."""
        if self.ends.get(path, (None,))[0] == size:
            return self.ends[path][1]
        end = 0
        with filesystem.open_input_file(path) as f:
            hi = size
            while hi and not end:
                lo = max(0, hi - (_BLOCK >> 4))
                f.seek(lo)
                end = lo + at + 1 if (at := f.read(hi - lo).rfind(b"\n")) >= 0 else 0
                hi = lo
        self.ends[path] = (size, end)
        return end

    def partitions(self, start: dict, end: dict) -> list[Range]:
        """Ranges of about ``rangeBytes``: long files are cut, short ones
        share a task."""
        out, own, held = [], [], 0
        for name, (hi, closed) in sorted(end["files"].items()):
            lo, was_closed = start["files"].get(name, (0, 0))
            if hi < lo:
                raise ValueError(f"{name} has become shorter: {lo} bytes were read, {hi} are left")
            ends_now = bool(closed and not (was_closed and hi == lo))
            at = lo
            while at < hi or (ends_now and at == lo):
                to = min(hi, at + max(1, self.range_bytes - held))
                own.append((name, at, to, lo, hi, ends_now and to == hi))
                held += to - at
                at = to
                if held >= self.range_bytes:
                    out.append(Range(own))
                    own, held = [], 0
                if at == hi:
                    break
        return _shared(out + [Range(own)] if own else out)

    # -- reading ---------------------------------------------------------------
    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("kind", pa.string()), ("start", pa.int64()),
                            ("n_lines", pa.int32()), ("text", pa.string())])
        rows, held = [], 0
        for row in self._pieces(partition.parts):
            rows.append(row)
            held += len(row[4])
            if len(rows) >= _ROWS or held >= _BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def _pieces(self, parts) -> Iterator[tuple]:
        opens = re.compile(self.start_pattern).search
        filesystem, root = open_fs(self.folder)
        for name, lo, hi, first, last, ends in parts:
            kind, start, lines = None, lo, []
            with filesystem.open_input_file(f"{root}/{name}") as f:
                for at, line in _lines(f, lo, hi, last, skip=lo > first):
                    if opens(line):
                        if kind:
                            yield name, "event" if kind == "open" else "more", start, len(lines), "\n".join(lines)
                        kind, start, lines = "open", at, []
                    elif not kind:
                        kind, start = "more", at
                    lines.append(line)
            if kind:
                yield name, kind, start, len(lines), "\n".join(lines)
            if ends:
                yield name, "end", hi, 0, ""


def _shared(ranges: list[Range]) -> list[Range]:
    """The ranges, dealt in order to tasks: each task leaves results with the
    driver and a file with the sink, so their number follows the bytes and
    not the size of a range."""
    sizes = [sum(to - lo for _, lo, to, *_ in r.parts) for r in ranges]
    tasks = max(MIN_TASKS, -(-sum(sizes) // TASK_BYTES))
    if len(ranges) <= tasks:
        return ranges
    share, held, out = max(1, -(-sum(sizes) // tasks)), 0, {}
    for r, size in zip(ranges, sizes):
        out.setdefault(held // share, []).extend(r.parts)
        held += size
    return [Range(parts) for parts in out.values()]


def _lines(f, lo: int, hi: int, last: int, skip: bool) -> Iterator[tuple[int, str]]:
    """Position and text of the lines whose first byte lies in [lo, hi);
    nothing is read from ``last`` on.  ``skip``: a line may have begun before
    ``lo``."""
    at = lo - 1 if skip else lo
    f.seek(at)
    rest = b""
    while at < hi:
        block = f.read(min(_BLOCK, last - at - len(rest)))
        whole = (rest + block).split(b"\n")
        rest = whole.pop()
        for raw in whole:
            if skip:
                skip = False
            elif at < hi:
                yield at, raw.removesuffix(b"\r").decode("utf-8", "replace")
            at += len(raw) + 1
        if not block:  # the end of the file: a last line without an end
            if rest and not skip and at < hi:
                yield at, rest.decode("utf-8", "replace")
            return


class LogTail(DataSource):
    """``spark.readStream.format("log_tail")``: options ``path`` (folder),
    ``pattern`` (of names below it), ``startPattern``, ``rangeBytes`` and
    ``closeIdleSeconds`` (default: files are never closed)."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return PIECES

    def streamReader(self, schema) -> LogTailReader:
        return LogTailReader(self.options)


def _join_edges(key, frames, state):
    """The events of one file that end in this batch; the open one stays."""
    import pandas as pd

    edges = pd.concat(list(frames)).sort_values("start", kind="stable")
    opened = list(state.get) if state.exists else None
    out = []
    for kind, start, n, text in zip(edges["kind"], edges["start"], edges["n_lines"], edges["text"]):
        if kind == "more" and opened:
            opened = [opened[0], opened[1] + n, f"{opened[2]}\n{text}"]
            continue
        if opened:
            out.append((key[0], *opened))
        opened = None if kind == "end" else [start, n, text]
    if opened:
        state.update((int(opened[0]), int(opened[1]), opened[2]))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=["file", "start", "n_lines", "event"])


def tail_events(spark: SparkSession, folder: str, start_pattern: str = EVENT_START, pattern: str = "*.log",
                close_idle_seconds: float | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A stream of the events of growing files: ``file`` (below ``folder``),
    ``start`` (position of the first byte), ``n_lines`` and ``event``."""
    spark.dataSource.register(LogTail)
    reader = spark.readStream.format("log_tail").options(
        path=folder, pattern=pattern, startPattern=start_pattern, rangeBytes=range_bytes)
    if close_idle_seconds is not None:
        reader = reader.option("closeIdleSeconds", close_idle_seconds)
    pieces = reader.load()
    whole = pieces.filter("kind = 'event'").select("file", "start", "n_lines", F.col("text").alias("event"))
    edges = pieces.filter("kind <> 'event'").groupBy("file").applyInPandasWithState(
        _join_edges, EVENTS, OPEN_EVENT, "append", "NoTimeout")
    return whole.union(edges)
