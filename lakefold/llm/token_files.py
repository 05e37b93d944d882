"""Token-id files with fixed-width bit packing.

Documents are ordered by id over range partitions, encoded, and written to
binary files: every id takes the fewest bits that hold the vocabulary.  A
file holds a header, a table of documents, the byte offset of each block of
``BLOCK_IDS`` ids and the packed blocks, so any range of ids is found and
unpacked with a few vectorised numpy operations:

    magic 8 bytes | bits, block ids: 2 x uint32 | ids, documents: 2 x uint64
    document ids: int64 each | id is null: uint8 each | first id: uint64 each, and the end
    byte offset of each block, and the end: uint64 each | blocks
    (little endian; 64 ids are packed, low bits first, in ``bits`` words of 64 bits)

Files roll at ``FILE_IDS`` ids, so a writer or reader holds a few MB (or one
document, if larger).  File names are unique to the attempt that writes
them; the manifest, committed by Spark, names the files of the attempts that
counted, so lost executors and retries leave no wrong result.  Files live
under the shared folder of the session and are opened with pyarrow's file
systems.

Encoding is the tokenizers library's, each distinct piece of text encoded
once per worker (a bounded cache).  One shuffle: the texts, by ranges of id
and text digest, so one id may hold a third of all rows.

Defined results: a null or empty text has the end id alone; a null id sorts
first and is kept; repeated rows follow one another; ties of an id are
ordered by the text's digest; an empty table gives no files and no rows.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import text_slices, vocab_path
from .common import in_memory_cache, read, scratch_path, text_of

VOCAB = "byte_bpe_50k.json"
MAGIC = b"LFIDS\x01\r\n"
BLOCK_IDS = 4096  # a multiple of 64
FILE_IDS = 1 << 21
CACHE_PIECES = 800_000
END_ID = 0


# --- packing ---------------------------------------------------------------

def bits_for(n_ids: int) -> int:
    """Fewest bits that hold the ids 0 to ``n_ids - 1``."""
    return max(1, (n_ids - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """64 ids in ``bits`` words; the last group is padded with 0.  Where the
    width is a whole number type's, its array is that layout."""
    groups = -(-len(ids) // 64)
    if bits in (8, 16, 32):
        out = np.zeros(groups * 64, f"<u{bits // 8}")
        out[: len(ids)] = ids
        return out.tobytes()
    lanes = np.zeros(groups * 64, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, 64)
    out = np.zeros((groups, bits), np.uint64)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    words = np.frombuffer(data, "<u8").astype(np.uint64).reshape(-1, bits)
    out = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        lane = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lane = lane | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, i] = lane & mask
    return out.reshape(-1)[:n].astype(np.uint32)


# --- files -----------------------------------------------------------------

def open_fs(uri: str):
    """pyarrow's file system and path for a folder or file of the session."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri) if ":" in uri.split("/")[0] else uri)


def file_bytes(ids: np.ndarray, doc_ids: list, starts: np.ndarray, bits: int) -> bytes:
    """``starts``: first id of each document, and the end."""
    n_blocks = -(-len(ids) // BLOCK_IDS)
    sizes = [-(-min(BLOCK_IDS, len(ids) - i * BLOCK_IDS) // 64) * bits * 8 for i in range(n_blocks)]
    head = len(MAGIC) + 24 + len(doc_ids) * 9 + 8 * (len(doc_ids) + 1) + 8 * (n_blocks + 1)
    offsets = head + np.r_[0, np.cumsum(sizes)].astype("<u8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join([MAGIC, struct.pack("<IIQQ", bits, BLOCK_IDS, len(ids), len(doc_ids)), numbers.tobytes(),
                     nulls.tobytes(), starts.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), pack(ids, bits)])


class TokenFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        filesystem, path = open_fs(uri)
        self.f = filesystem.open_input_file(path)
        if self.f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.bits, self.block, self.n_ids, self.n_docs = struct.unpack("<IIQQ", self.f.read(24))
        numbers = np.frombuffer(self.f.read(8 * self.n_docs), "<i8").tolist()
        nulls = np.frombuffer(self.f.read(self.n_docs), np.uint8)
        self.doc_ids = [None if n else d for d, n in zip(numbers, nulls)]
        self.starts = np.frombuffer(self.f.read(8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.f.read(8 * (-(-self.n_ids // self.block) + 1)), "<u8").astype(np.int64)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi - 1`` of the file, from the blocks that hold them."""
        if hi <= lo:
            return np.empty(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        self.f.seek(int(self.offsets[first]))
        data = self.f.read(int(self.offsets[last + 1] - self.offsets[first]))
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        return unpack(data, self.bits, n)[lo - first * self.block: hi - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def close(self) -> None:
        self.f.close()


# --- encoding --------------------------------------------------------------

class _Numbers(dict):
    """Numbers keys in order of their first lookup; ``new`` holds them until
    they are taken."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def take(self) -> list[str]:
        self.new, out = [], self.new
        return out


class _Growing:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.held, self.n = np.empty(1 << 12, dtype), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            held = np.empty(2 * (self.n + len(values)), self.held.dtype)
            held[:self.n] = self.held[:self.n]
            self.held = held
        self.held[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.held[:self.n]


class PieceEncoder:
    """The library's ids of whole texts, each distinct piece encoded once.

    A text is cut before every space that follows something else than white
    space, and between a Latin letter and the punctuation or line feed after
    it.  This pre-tokenizer cuts there in any text, so the ids of the pieces
    are the ids of the text."""

    #: Where white space of any kind comes before a space, the cut depends on
    #: what follows; such texts are cut before runs of white space only.
    uneven = re.compile(r"\s ").search
    runs = re.compile(r"\s*\S+|\s+").findall
    word = re.compile(r" \S+").fullmatch
    marked = re.compile(r"[.,;:!?|#$%&*\n](?<=[A-Za-zÀ-ÖØ-öø-ɏ][.,;:!?|#$%&*\n])").sub

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.width = np.zeros(self.size, np.int64)  # bytes of each id
        for token, i in vocab.items():
            self.width[i] = len(token.encode()) if token in self.special else len(token)
        self._reset()

    def _reset(self) -> None:
        self.index = _Numbers()
        self.flat = _Growing(np.uint32)
        self.start, self.count, self.uses = (_Growing(np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep the pieces that came up again, the most frequent half of the
        cache at most."""
        uses = self.uses.values
        again = np.flatnonzero(uses > 1)
        if len(again) > CACHE_PIECES // 2:
            again = np.sort(again[np.argsort(-uses[again], kind="stable")[:CACHE_PIECES // 2]])
        every = list(self.index)
        names = [every[i] for i in again.tolist()]
        count = self.count.values[again]
        flat = _gather(self.flat.values, self.start.values[again], count)[0]
        self._reset()
        self.index.update(zip(names, range(len(names))))
        for kept, values in ((self.flat, flat), (self.count, count), (self.start, np.cumsum(count) - count), (self.uses, np.zeros(len(names)))):
            kept.append(values)

    def pieces(self, text: str) -> list[str]:
        if "  " in text or "\n " in text or self.uneven(text) or "\x00" in text or any(s in text for s in self.special):
            return self.runs(text)
        out = self.marked("\x00\\g<0>", text).replace(" ", "\x00 ").split("\x00")
        return out if out[0] else out[1:]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that begin with a space and hold no other white
        space, and each piece's number: encoded as one text, which is cut
        before every such space, and taken apart by the ids' bytes."""
        ids = np.array(self.tok.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, np.int64)
        ends, to = np.cumsum([len(p.encode()) for p in pieces]), np.cumsum(self.width[ids])
        at = np.searchsorted(to, ends)
        if not (to[np.minimum(at, len(to) - 1)] == ends).all():
            raise ValueError("a token spans two pieces")
        return ids, np.diff(np.r_[-1, at])

    def _learn(self, new: list[str]) -> None:
        words, others = [], []
        for i, p in enumerate(new):
            (words if self.word(p) else others).append(i)
        made, count = [np.empty(0, np.int64)], np.zeros(len(new), np.int64)
        for i in range(0, len(words), 2048):
            part = words[i:i + 2048]
            ids, count[part] = self._joined([new[j] for j in part])
            made.append(ids)
        for i in range(0, len(others), 512):
            part = others[i:i + 512]
            lists = [e.ids for e in self.tok.encode_batch_fast([new[j] for j in part], add_special_tokens=False)]
            count[part] = [len(x) for x in lists]
            made.append(np.array([t for x in lists for t in x], np.int64))
        start = np.empty(len(new), np.int64)
        order = np.array(words + others, np.int64)
        start[order] = self.flat.n + np.cumsum(count[order]) - count[order]
        for kept, values in ((self.start, start), (self.count, count), (self.uses, np.zeros(len(new))), (self.flat, np.concatenate(made))):
            kept.append(values)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets (one more than texts)."""
        if len(self.index) > CACHE_PIECES:
            self._forget()
        cut: list[str] = []
        ends = [0]
        for t in texts:
            if t:
                cut += self.pieces(t)
            ends.append(len(cut))
        which = np.fromiter(map(self.index.__getitem__, cut), np.int64, len(cut))
        if self.index.new:
            self._learn(self.index.take())
        self.uses.values[:] += np.bincount(which, minlength=self.uses.n)
        ids, to = _gather(self.flat.values, self.start.values[which], self.count.values[which])
        return ids, np.r_[0, to][ends]


def _gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments of ``flat`` one after another, and where each ends."""
    to = np.cumsum(count)
    total = int(to[-1]) if len(to) else 0
    return flat[np.repeat(start - (to - count), count) + np.arange(total)], to


def encoder(path: str) -> PieceEncoder:
    return in_memory_cache("pieces", path, lambda: PieceEncoder(vocab_path(path)))


# --- the operator ----------------------------------------------------------

MANIFEST = "part int, seq int, path string, n_docs long, n_ids long, bits int"


def write_token_files(docs: DataFrame, folder: str, path: str = VOCAB, end_id: int = END_ID,
                      file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``doc_id``, ``text`` into files under ``folder`` in ascending
    order of id, the end id after each document; returns the manifest."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        filesystem, root = open_fs(folder)
        bits = bits_for(max(enc.size, end_id + 1))
        held_ids: list[np.ndarray] = []
        held_docs: list = []
        lens: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal held_ids, held_docs, lens, held, seq
            ids = np.concatenate(held_ids)
            starts = np.r_[0, np.cumsum(np.concatenate(lens))]
            name = f"part-{part:05d}-{seq:05d}-{uuid.uuid4().hex}.ids"
            with filesystem.open_output_stream(f"{root}/{name}") as f:
                f.write(file_bytes(ids, held_docs, starts, bits))
            row = {"part": [part], "seq": [seq], "path": [f"{folder}/{name}"], "n_docs": [len(held_docs)],
                   "n_ids": [len(ids)], "bits": [bits]}
            held_ids, held_docs, lens, held, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, pa.schema([
                ("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                ("n_ids", pa.int64()), ("bits", pa.int32())]))

        for batch in batches:
            filesystem.create_dir(root, recursive=True)
            names = batch.column(0).to_pylist()
            for lo, hi, texts in text_slices(batch.column(1), min(1 << 20, file_ids)):
                ids, at = enc.encode(texts)
                held_ids.append(np.insert(ids, at[1:], end_id))
                lens.append(np.diff(at) + 1)
                held_docs += names[lo:hi]
                held += len(held_ids[-1])
                if held >= file_ids:
                    yield flush()
        if held_docs:
            yield flush()

    ordered = (docs.select("doc_id", text_of("text").alias("text"))
               .withColumn("digest", F.xxhash64("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), "digest")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest", "text").drop("digest"))
    manifest = f"{folder}-manifest"
    ordered.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all files before; summed by part first."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("before"))
    in_part = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return manifest.withColumn("in_part", in_part).join(before, "part").withColumn(
        "start", F.col("before") + F.col("in_part")).drop("in_part", "before")


def read_documents(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read the files back: per document its global start, its ids' number
    and crc32, and the ids themselves if asked for."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                      + [("ids", pa.list_(pa.int64()))] * with_ids)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                f = TokenFile(row["path"])
                ids, at = f.ids(0, f.n_ids), f.starts  # FILE_IDS ids, or one document
                own = [ids[lo:hi] for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]
                cols = [pa.array(f.doc_ids, pa.int64()), pa.array(row["start"] + at[:-1], pa.int64()),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64())]
                if with_ids:
                    cols.append(pa.array([x.tolist() for x in own], pa.list_(pa.int64())))
                f.close()
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    files = with_starts(manifest).select("path", "start")
    return files.repartition(max(1, min(manifest.count(), 10_000))).mapInArrow(run, schema)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return read_documents(write_token_files(docs, scratch_path(spark, "op4")))
