"""WARC archives: writing, and reading by verified boundary chains.

Writing: one record per page, written by Spark's text writer with the
record separator as line separator, so files commit like any Spark output.
Of pages with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest id is the response, the others are revisit records without payload
that refer to it.  The table of repeated payloads (one row per repeated
digest) is stored first; Spark broadcasts it only if its stored size is below
the session's threshold, else the pages are shuffled by digest.

Reading: files are cut into byte ranges.  A task scans its range for the
record magic, wherever it occurs, and emits for each candidate the offset of
the record that would follow (from its headers).  A magic inside a payload
is such a candidate, too.  Only what the file start reaches is a record:
each task first follows the candidates inside its range to where they leave
it, and pointer jumping over these range entries (one or few per range;
log2(ranges) rounds) marks the entries that the file start reaches.  A
second pass follows the chains from the marked entries and reads the
records; a header or payload that crosses the range's end is read on.  A
file whose chain does not end exactly at its length (cut off, damaged) and a
payload that disagrees with its header raise an error.

Headers may have any length.  The ends of headers and the length fields are
found by one pass over a range each, so a magic that payloads repeat costs a
look-up and no scan of its own.

Memory per task: one range and one record.

Defined results: null or empty html is an empty payload; a null url is
written as an empty one, line breaks and spaces in urls are percent-encoded;
null ids are written as ``null`` and read back as null, and refer to or are
referred to like the smallest id; pages that agree in id and payload are all
responses if theirs is the largest id; an empty table gives no records.
Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read, scratch_path, stage, text_of
from .token_files import open_fs

REVISIT_BYTES = 1000
MAGIC = b"WARC/1.1\r\n"
SEPARATOR = "\r\n\r\n"
RANGE_BYTES = 4 << 20
HEADER_END = b"\r\n\r\n"
LENGTH_FIELD = re.compile(rb"\r\n[ \t]*content-length[ \t]*:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n)", re.IGNORECASE)
#: No crawl time is given; a fixed one keeps archives reproducible.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing ---------------------------------------------------------------

def _name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_warc(pages: DataFrame, folder: str) -> str:
    """Write ``page_id``, ``url``, ``html`` as WARC files under ``folder``."""
    payload = text_of("html")
    digested = pages.select("page_id", "url", payload.alias("payload"),
                            F.octet_length(payload).cast("long").alias("n_bytes"),
                            F.sha1(payload.cast("binary")).alias("digest"))
    repeated = stage(digested.filter(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest")
                     .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response_id"))
                     .filter((F.col("n") > 1) & F.col("response_id").isNotNull()).drop("n"), "warc-repeated")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    # coalesce: a null id is below every other one
    is_revisit = F.col("response_id").isNotNull() & (F.coalesce(F.col("page_id") < F.col("response_id"), F.lit(True)))
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A"), " ", "%20")
    lines = [F.lit("WARC/1.1"),
             F.concat(F.lit("WARC-Type: "), F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
             F.concat(F.lit("WARC-Record-ID: "), _name(F.col("page_id"))),
             F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), uri),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
             F.concat(F.lit("X-Payload-Length: "), F.col("n_bytes").cast("string")),
             F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("response_id")))),
             F.when(is_revisit, F.lit(f"WARC-Profile: {PROFILE}")),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.when(is_revisit, F.lit(0)).otherwise(
                 F.octet_length(http) + F.col("n_bytes")).cast("string"))]
    block = F.when(is_revisit, F.lit("")).otherwise(F.concat(http, "payload"))
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)
    digested.join(repeated, "digest", "left").select(record.alias("value")).write.option("lineSep", SEPARATOR).text(folder)
    return folder


# --- reading ---------------------------------------------------------------

class Archive:
    """Reads bytes of one file, ahead in ``RANGE_BYTES`` steps."""

    def __init__(self, uri: str):
        filesystem, path = open_fs(uri)
        self.f = filesystem.open_input_file(path)
        self.lo, self.data = 0, b""

    def hold(self, lo: int, n: int) -> None:
        self.f.seek(lo)
        self.lo, self.data = lo, self.f.read(n)

    def bytes(self, lo: int, n: int) -> bytes:
        at = lo - self.lo
        if 0 <= at and at + n <= len(self.data):
            return self.data[at:at + n]
        self.f.seek(lo)
        return self.f.read(n)

    def header(self, lo: int) -> tuple[dict[str, str], int] | None:
        """Fields of the record at ``lo`` and the offset of its block."""
        n = 2048
        while (end := (data := self.bytes(lo, n)).find(HEADER_END)) < 0:
            if len(data) < n:
                return None  # the file ends first
            n *= 4
        if not data.startswith(MAGIC):
            return None
        fields = {}
        for line in data[len(MAGIC):end].split(b"\r\n"):
            name, colon, value = line.partition(b":")
            if not colon:
                return None
            fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        length = fields.get("content-length", "")
        return (fields, lo + end + 4) if length.isascii() and length.isdigit() else None

    def candidates(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """Every (magic's offset, offset after the record) from lo to hi - 1."""
        self.hold(lo, hi - lo + len(MAGIC) - 1)
        magics = [m.start() for m in re.finditer(re.escape(MAGIC), self.data)]
        if not magics:
            return []
        while (end := self.data.find(HEADER_END, magics[-1])) < 0:  # read on to the end of the last header
            more = self.f.read(RANGE_BYTES)
            if not more:
                break
            self.data += more
        ends = [m.start() for m in re.finditer(b"(?=" + HEADER_END + b")", self.data[:end + 4 if end >= 0 else None])]
        lengths = [(m.start(), int(m.group(1))) for m in LENGTH_FIELD.finditer(self.data)]
        places, out = [at for at, _ in lengths], []
        for at in magics:
            e, n = bisect.bisect_left(ends, at), -1
            if e < len(ends):
                n = bisect.bisect_left(places, ends[e]) - 1  # the last length field before the header's end
            if n >= 0 and places[n] >= at:
                out.append((lo + at, lo + ends[e] + 4 + lengths[n][1] + 4))
        return out

    def close(self) -> None:
        self.f.close()


def byte_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path``, ``no``, ``lo``, ``hi`` of every range of every file."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length").filter("length > 0")
    step = F.lit(range_bytes).cast("long")
    return stage(files.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)))
                 .select("path", (F.col("lo") / step).cast("long").alias("no"), "lo",
                         F.least(F.col("lo") + step, "length").alias("hi"), "length"), "warc-ranges")


def _over_ranges(ranges: DataFrame, run, schema: str) -> DataFrame:
    tasks = max(1, min(ranges.count(), 10_000))
    return ranges.repartition(tasks).mapInArrow(run, schema)


def range_exits(ranges: DataFrame) -> DataFrame:
    """Per candidate: its offset, the offset where the chain from it leaves
    its range, and the range that holds that offset."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                archive = Archive(r["path"])
                leaves: dict[int, int] = {}
                for off, after in reversed(archive.candidates(r["lo"], r["hi"])):
                    leaves[off] = leaves.get(after, after)
                archive.close()
                # a chain that ends inside the range at no candidate is broken and goes nowhere
                out = [(off, to) for off, to in leaves.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["path"]] * len(out), pa.string()), pa.array([o for o, _ in out], pa.int64()),
                     pa.array([t for _, t in out], pa.int64())], ["path", "off", "leaves"])

    return _over_ranges(ranges, run, "path string, off long, leaves long")


def reached_entries(exits: DataFrame, most_ranges: int) -> DataFrame:
    """The offsets at which the chain from each file's start enters a range.
    Marked entries double their reach each round."""
    entries = exits.filter("off = 0").unionByName(
        exits.join(exits.select("path", F.col("leaves").alias("off")).distinct(), ["path", "off"], "left_semi")).distinct()
    jump = stage(entries, "warc-entries")
    marked = jump.filter("off = 0").select("path", "off")
    for _ in range(max(0, most_ranges - 1).bit_length()):
        ahead = marked.join(jump, ["path", "off"]).select("path", F.col("leaves").alias("off"))
        marked = stage(marked.union(ahead).distinct(), "warc-marked")
        to = jump.select("path", F.col("off").alias("leaves"), F.col("leaves").alias("further"))
        jump = stage(jump.join(to, ["path", "leaves"]).select("path", "off", F.col("further").alias("leaves")), "warc-jump")
    return marked


def check_chains(ranges: DataFrame, exits: DataFrame, marked: DataFrame) -> None:
    """Raise unless the chain from each file's start ends at the file's end."""
    ends = exits.join(marked, ["path", "off"], "left_semi").groupBy("path").agg(F.max("leaves").alias("leaves"))
    files = ranges.filter("no = 0").select("path", "length")
    bad = files.join(ends, "path", "left").filter("leaves IS NULL OR leaves <> length").limit(5).collect()
    if bad:
        raise ValueError("records do not fill their file: " + ", ".join(
            f"{r.path} ({r.leaves} of {r.length} bytes)" for r in bad))


RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, content_ok boolean")


def _page(name: str | None) -> int | None:
    name = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name not in ("", "null") else None


def read_warc(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, with_payload: bool = False,
              strict: bool = True) -> DataFrame:
    """The records of the archives under ``folder``.  Size and digest are
    those of the full payload: computed from a response's block, and for a
    revisit those that the record states (it holds none).  ``content_ok``:
    they agree with the headers; ``strict`` raises where they do not."""
    ranges = byte_ranges(spark, folder, range_bytes)
    exits = stage(range_exits(ranges), "warc-exits")
    most = ranges.agg(F.max("no")).first()[0]
    marked = reached_entries(exits, (most or 0) + 1)
    check_chains(ranges, exits, marked)
    step = F.lit(range_bytes).cast("long")
    chains = ranges.join(marked.withColumn("no", F.floor(F.col("off") / step)), ["path", "no"]).filter("off < length")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                archive, off, out = Archive(r["path"]), r["off"], []
                archive.hold(r["lo"], r["hi"] - r["lo"])
                while off < r["hi"]:
                    found = archive.header(off)
                    if found is None:
                        raise ValueError(f"{r['path']}: no record at offset {off}")
                    fields, at = found
                    n = int(fields["content-length"])
                    stated = fields["warc-payload-digest"].removeprefix("sha1:")
                    block = archive.bytes(at, n) if n else b""
                    payload = None
                    if fields["warc-type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    else:
                        size, digest = int(fields["x-payload-length"]), stated
                    ok = digest == stated and size == int(fields["x-payload-length"])
                    if strict and not ok:
                        raise ValueError(f"{r['path']}: the payload at offset {at} disagrees with its header")
                    out.append((_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, digest,
                                fields["warc-type"], _page(fields.get("warc-refers-to")), ok)
                               + ((payload,) if with_payload else ()))
                    off = at + n + 4
                archive.close()
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                     [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * with_payload)

    return _over_ranges(chains, run, RECORD + ", payload binary" * with_payload)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_warc(read(spark, sf_dir, "pages", "page_id", "url", "html"), scratch_path(spark, "op7") + "/warc")
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest,
                  strlen(coalesce(html, '')) AS n FROM pages),
     m AS (SELECT digest, max(page_id) AS response_id FROM p WHERE n >= {REVISIT_BYTES} GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id < response_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < response_id THEN response_id END AS refers_to
FROM p LEFT JOIN m USING (digest)
"""
