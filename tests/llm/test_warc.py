import glob
import hashlib

import pytest
from conftest import multiset, write_tables

from lakefold.llm import warc
from lakefold.llm.queries import QUERIES
from lakefold.session import scratch_path

op7 = QUERIES["op7_warc"]


def expected(pages):
    last = {}
    for i, h in pages:
        if len((h or "").encode()) >= 1000 and i is not None:
            last[h] = max(last.get(h, i), i)
    out = []
    for i, h in pages:
        data = (h or "").encode()
        ref = last.get(h) if h in last and (i is None or i < last[h]) else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if ref is not None else "response", ref))
    return multiset(out)


def edge_pages():
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "é" * 700
    return [(1, None), (2, ""), (3, big), (4, big), (9, big), (5, "short"), (6, "short"), (7, fake), (8, "x" + fake * 50),
            (10, "\r\n\r\nWARC/1.1\r\n"), (11, "y" * 300_000), (12, fake * 3 + "z" * 5000), (13, fake * 3 + "z" * 5000),
            (None, big), (None, "a"), (3, big), (9, big), (14, "WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n"), (15, "tail\r\n")]


def test_whole_table(spark, small_sf):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{small_sf}/pages.parquet").collect()]
    assert multiset(map(tuple, op7(spark, small_sf).collect())) == expected(pages)


def test_edges(spark, tmp_path):
    rows = [(i, "http://a.example/b c\nd" if i and i % 2 else None, h) for i, h in edge_pages()]
    folder = write_tables(spark, str(tmp_path), [], pages=rows)
    assert multiset(map(tuple, op7(spark, folder).collect())) == expected(edge_pages())


def test_empty(spark, empty_sf):
    assert op7(spark, empty_sf).collect() == []


def test_records_cut_by_small_ranges(spark):
    """Ranges far smaller than records: chains jump over whole ranges, and
    magic inside payloads stays out."""
    rows = [(i, f"http://x/{i}", h) for i, h in edge_pages()]
    folder = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2),
                             scratch_path(spark, "t7") + "/warc")
    for size in (257, 4096, 1 << 20):
        got = warc.read_warc(spark, folder, range_bytes=size, with_payload=True).collect()
        assert multiset((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(edge_pages())
        assert all(r.content_ok for r in got)
        assert multiset(r.payload.decode() for r in got if r.record_type == "response" and r.page_id == 12 or r.page_id == 13) == multiset([edge_pages()[11][1]])


def test_files_are_plain_warc(spark):
    folder = warc.write_warc(spark.createDataFrame([(1, "http://x/1", "<p>é</p>")], "page_id long, url string, html string"),
                             scratch_path(spark, "t7b") + "/warc")
    data = b"".join(r.content for r in spark.read.format("binaryFile").load(folder).collect())
    head, _, block = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"WARC-Target-URI: http://x/1" in head
    length = int(head.split(b"Content-Length: ")[-1])
    assert block[length:] == b"\r\n\r\n" and block[:length].endswith("<p>é</p>".encode())


def archive(spark, rows, name):
    return warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).orderBy("page_id"),
                           scratch_path(spark, name) + "/warc")


@pytest.mark.parametrize("place", [0, 5, 9])
def test_very_long_urls_anywhere(spark, place):
    """A header of a megabyte at the file's start, inside it, at its end, and
    for small ranges at a range's start."""
    rows = [(i, "data:" + "u" * 1_000_000 if i == place else f"http://x/{i}", f"<p>{i}</p>" * 40) for i in range(10)]
    folder = archive(spark, rows, "t7c")
    for size in (100_000, warc.RANGE_BYTES):
        got = warc.read_warc(spark, folder, range_bytes=size).collect()
        assert multiset((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected([(i, h) for i, _, h in rows])
        assert {r.page_id: r.url for r in got}[place] == rows[place][1]


def test_long_url_through_the_query(spark, tmp_path):
    rows = [(1, "x" * 300_000, "a"), (2, "http://x/2", "b")]
    assert multiset(map(tuple, op7(spark, write_tables(spark, str(tmp_path), [], pages=rows)).collect())) == expected([(1, "a"), (2, "b")])


def damaged(folder, change):
    (path,) = glob.glob(f"{folder.removeprefix('file:')}/part-*")
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(change(data))
    for crc in glob.glob(f"{folder.removeprefix('file:')}/.*.crc"):
        open(crc, "wb").close()


@pytest.mark.parametrize("change,message", [
    (lambda d: d[:-300], "do not fill"), (lambda d: d[:700], "do not fill"), (lambda d: d[3:], "do not fill"),
    (lambda d: d + b"x", "do not fill"), (lambda d: d.replace(b"<p>3</p>", b"<p>4</p>", 1), "disagrees")])
def test_damaged_files_raise(spark, change, message):
    folder = archive(spark, [(i, f"http://x/{i}", f"<p>{i}</p>" * 40) for i in range(6)], "t7d")
    damaged(folder, change)
    for size in (200, warc.RANGE_BYTES):
        with pytest.raises(Exception, match=message):
            warc.read_warc(spark, folder, range_bytes=size).collect()


def test_repeated_magic_without_header_end(spark):
    rows = [(1, "http://x/1", "WARC/1.1\r\nContent-Length: 5\r\n" * 20_000), (2, "http://x/2", "b")]
    got = warc.read_warc(spark, archive(spark, rows, "t7e"), range_bytes=50_000).collect()
    assert sorted(r.page_id for r in got) == [1, 2]
