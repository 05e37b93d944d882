"""Growing log files (S11 + W2)."""

import os
import random
import re

import pytest

from lakefold.functions.logtext import EVENT_START
from lakefold.plans.derived import write_log_files
from lakefold.sources.logtail import MIN_TASKS, LogTailReader, tail_events
from lakefold.streaming.jobs import append_job

ONE = "22/11/14 10:11:12 INFO A: start\n\tat x.y(Z.java:1)\n"
TWO = "22/11/14 10:11:13 WARN B: nächste 漢\r\n  more\r\n"


def events_of(content: bytes, pattern=EVENT_START) -> list[tuple[int, int, str]]:
    """Assembly by the shipper's rule, line after line."""
    out, at = [], 0
    lines = content.split(b"\n")
    if lines[-1] == b"":
        lines.pop()
    for raw in lines:
        line = raw.removesuffix(b"\r").decode()
        if re.search(pattern, line) or not out:
            out.append([at, [line]])
        else:
            out[-1][1].append(line)
        at += len(raw) + 1
    return [(s, len(ls), "\n".join(ls)) for s, ls in out]


def put(path, data: bytes, mode="ab"):
    with open(path, mode) as f:
        f.write(data)


def run(spark, folder, **options):
    append_job(tail_events(spark, f"{folder}/logs", **options), f"{folder}/sink", f"{folder}/ckpt")
    rows = spark.read.parquet(f"{folder}/sink").collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        found.setdefault(r.file, []).append((r.start, r.n_lines, r.event))
    return found


def test_lines_appended_inside_a_line_and_an_event(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/logs/sub")
    log, other = f"{tmp_dir}/logs/a.log", f"{tmp_dir}/logs/sub/b.log"
    text = (ONE + TWO + ONE + ONE).encode()
    cut = text.index("ä".encode()) + 1  # inside a character of the second event
    put(log, text[:cut])
    put(other, b"orphan\nline\n")
    put(f"{tmp_dir}/logs/ignored.txt", text)
    assert run(spark, tmp_dir) == {}  # no event is known to be over
    put(log, text[cut:-5])
    assert run(spark, tmp_dir) == {"a.log": events_of(text)[:3]}
    put(other, TWO.encode())
    put(log, text[-5:])
    assert run(spark, tmp_dir)["sub/b.log"] == [(0, 2, "orphan\nline")]
    assert run(spark, tmp_dir, close_idle_seconds=0) == {
        "a.log": events_of(text), "sub/b.log": events_of(b"orphan\nline\n" + TWO.encode())}
    assert run(spark, tmp_dir, close_idle_seconds=0)["a.log"] == events_of(text)  # nothing twice


def test_closed_file_without_last_line_end_and_growth_after_it(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/logs")
    log = f"{tmp_dir}/logs/a.log"
    put(log, ONE.encode() + b"22/11/14 10:11:14 INFO C: cut")
    first = events_of(ONE.encode() + b"22/11/14 10:11:14 INFO C: cut")
    assert run(spark, tmp_dir, close_idle_seconds=0)["a.log"] == first
    at = os.path.getsize(log)
    put(log, b" off\n" + TWO.encode())
    assert run(spark, tmp_dir, close_idle_seconds=0)["a.log"] == first + [
        (s + at, n, e) for s, n, e in events_of(b" off\n" + TWO.encode())]


def test_shrunk_file_raises(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/logs")
    put(f"{tmp_dir}/logs/a.log", (ONE + TWO).encode())
    run(spark, tmp_dir, close_idle_seconds=0)
    put(f"{tmp_dir}/logs/a.log", ONE.encode(), "wb")
    with pytest.raises(Exception, match="become shorter"):
        run(spark, tmp_dir, close_idle_seconds=0)


def test_no_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/logs")
    assert run(spark, tmp_dir, close_idle_seconds=0) == {}


@pytest.mark.parametrize("range_bytes", [1, 7, 40, 1000])
def test_ranges_of_any_size_lose_and_repeat_nothing(tmp_dir, range_bytes):
    """Readers alone: pieces of all ranges, joined by position, over random
    growth steps."""
    rng = random.Random(range_bytes)
    line = lambda: (rng.choice(["22/11/14 10:11:12 INFO ", " at ", "", "x\t"]) + "é" * rng.randint(0, 30)).encode()
    content = {n: b"".join(line() + rng.choice([b"\n", b"\r\n"]) for _ in range(40)) + line() for n in ("a.log", "b.log")}
    reader = LogTailReader({"path": tmp_dir, "startPattern": EVENT_START, "rangeBytes": str(range_bytes)})
    offset, pieces, written = reader.initialOffset(), [], dict.fromkeys(content, 0)
    for step in range(6):
        for name, data in content.items():
            to = len(data) if step == 5 else rng.randint(written[name], len(data))
            put(f"{tmp_dir}/{name}", data[written[name]:to])
            written[name] = to
        if step == 5:
            reader.idle = 0.0
        end = reader.latestOffset()
        for part in reader.partitions(offset, end):
            pieces += reader._pieces(part.parts)
        offset = end
    for name, data in content.items():
        joined = []
        for _, kind, start, n, text in sorted((p for p in pieces if p[0] == name), key=lambda p: p[2]):
            if kind == "more" and joined:
                joined[-1] = (joined[-1][0], joined[-1][1] + n, f"{joined[-1][2]}\n{text}")
            elif kind != "end":
                joined.append((start, n, text))
        assert joined == events_of(data)
        assert sum(p[1] == "end" for p in pieces if p[0] == name) == 1


@pytest.mark.parametrize("n_files, size", [(900, 100), (3, 40_000)])
def test_number_of_tasks_does_not_follow_the_ranges(tmp_dir, n_files, size):
    """Every range is read by one task, in order, and no more than
    ``MIN_TASKS`` tasks share short ranges."""
    line = (ONE + TWO).encode()
    content = {f"{i:03d}.log": line * (1 + size // len(line)) for i in range(n_files)}
    for name, data in content.items():
        put(f"{tmp_dir}/{name}", data)
    reader = LogTailReader({"path": tmp_dir, "startPattern": EVENT_START, "rangeBytes": "90", "closeIdleSeconds": "0"})
    tasks = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert 1 < len(tasks) <= MIN_TASKS
    at = dict.fromkeys(content, 0)
    for name, lo, hi, *_ in (part for task in tasks for part in task.parts):
        assert lo == at[name] and hi - lo <= 90
        at[name] = hi
    assert at == {name: len(data) for name, data in content.items()}
    sizes = [sum(hi - lo for _, lo, hi, *_ in task.parts) for task in tasks]
    assert max(sizes) <= 2 * sum(sizes) / MIN_TASKS + 90
    assert sum(p[1] == "end" for task in tasks for p in reader._pieces(task.parts)) == n_files


def test_log_files_are_whole_when_a_join_would_be_replanned(spark, tmp_dir):
    rng = random.Random(3)
    docs = [(i, "\n".join(f"{i} {j} " + "é" * rng.randint(0, 60) for j in range(rng.randint(1, 30))), f"s{i % 4}") for i in range(1200)]
    docs += [(7, f"another {j}\nof one id", "s3") for j in range(20)]  # ids repeat
    want = {}
    for i, text, source in docs:
        want.setdefault(f"{source}-{i // 500}.log", []).extend(text.split("\n"))
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(6).write.parquet(f"{tmp_dir}/docs")
    held = {"spark.sql.autoBroadcastJoinThreshold": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in held}
    for c, v in held.items():
        spark.conf.set(c, v)
    try:
        for share in (0.5, 1.0):
            write_log_files(spark.read.parquet(f"{tmp_dir}/docs"), f"{tmp_dir}/{share}", share)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sorted(os.listdir(f"{tmp_dir}/1.0")) == sorted(want)
    for name, lines in want.items():
        whole = open(f"{tmp_dir}/1.0/{name}", "rb").read()
        assert sorted(whole.decode().split("\n")[:-1]) == sorted(lines)
        assert open(f"{tmp_dir}/0.5/{name}", "rb").read() == whole[:len(whole) // 2]
