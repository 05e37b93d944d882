"""Token counts with a whole-token shortcut.

Before any text is read, every string of the vocabulary is put through the
merges: the strings that end as one token, their own, are *proven*.  A
pre-token of a text that is one of them counts as one token without a merge;
the others are merged, all new ones of a slice at once (``bpe.MergeTable``),
and only their counts are kept.  Ids are never made.

The vocabulary file (``tokenizers`` JSON: byte-level BPE without normalizer)
is a parameter and is read in the workers; no tokenizer library takes part.
Added tokens are found in the raw text first and count as one each, as the
library does by default.

Scale: row-local, no shuffle.  A worker holds the vocabulary, one slice of
texts (or one text, if longer) and counts of at most ``CACHE_CHARS``
characters of other pre-tokens, which are forgotten together beyond that.

Defined results: a null or empty text has no bytes and no tokens; long texts
are counted whole, also when they are one pre-token; null ids, ties and
repeated rows pass through row by row; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .bpe import MergeTable, byte_symbols, text_slices, vocab_path
from .common import in_memory_cache, read

VOCAB = "byte_bpe_50k.json"
LIMIT = 1024
CACHE_CHARS = 1 << 24
#: Fixed value: the pre-tokens of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def unassigned(pattern: str) -> np.ndarray:
    """For every code point: whether ``pattern`` matches it though Python's
    Unicode tables, like the library's, do not know it yet."""
    import regex

    known = regex.compile(pattern).match
    return np.array([unicodedata.category(chr(c)) == "Cn" and known(chr(c)) is not None
                     for c in range(sys.maxunicode + 1)])


class TokenCounter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
                or not before.get("use_regex") or spec.get("normalizer") or model.get("ignore_merges")):
            raise ValueError(f"{path}: not a byte-level BPE vocabulary without normalizer")
        self.vocab, symbols = model["vocab"], byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.first = np.array([self.vocab[s] for s in symbols], np.int64)
        self.table = MergeTable(self.vocab, model["merges"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        longest_first = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.at_special = regex.compile("|".join(longest_first)) if self.special else None
        self.pre_tokens = regex.compile(PATTERN).findall
        self.unassigned = unassigned(r"[\p{L}\p{N}\s]")
        self.whole = self.prove()
        self.forget()

    def prove(self) -> frozenset[str]:
        """The vocabulary strings that encode alone as their own token."""
        names = [t for t in self.vocab if t not in self.special]
        raw = [bytes(self.byte_of[c] for c in t) for t in names]
        ids, count = self.merge(raw)
        at = np.cumsum(count) - count
        proven = (count == 1) & (ids[at] == np.array([self.vocab[t] for t in names]))
        found = set()
        for text, one in zip(raw, proven.tolist()):
            if one:
                try:
                    found.add(text.decode())
                except UnicodeDecodeError:
                    pass  # part of a character: never a pre-token
        return frozenset(found)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and each word's number."""
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        return self.table.merge(symbols, np.array([len(w) for w in words], np.int64))

    def forget(self) -> None:
        self.known, self.held = dict.fromkeys(self.whole, 1), 0

    def learn(self, new: list[str]) -> None:
        raw = [w.encode() for w in new]
        self.known.update(zip(new, self.merge(raw)[1].tolist()))
        self.held += sum(map(len, new))

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many added tokens it holds."""
        if self.at_special is not None and self.at_special.search(text):
            parts = self.at_special.split(text)
            lists = [self.pieces(p)[0] for p in parts if p]
            return [w for ws in lists for w in ws], len(parts) - 1
        strange = () if text.isascii() else np.flatnonzero(self.unassigned[np.frombuffer(text.encode("utf-32-le"), np.uint32)])
        if not len(strange):
            return self.pre_tokens(text), 0
        # cut where the text would be cut with a character that is no letter, digit or space in their place
        masked = list(text)
        for i in strange.tolist():
            masked[i] = "\ue000"
        ends = np.cumsum([len(w) for w in self.pre_tokens("".join(masked))]).tolist()
        return [text[lo:hi] for lo, hi in zip([0, *ends], ends)], 0

    def counts(self, texts: list[str]) -> list[int]:
        if self.held > CACHE_CHARS:
            self.forget()
        cut = [self.pieces(t) if t else ([], 0) for t in texts]
        new = set().union(*(ws for ws, _ in cut)).difference(self.known)
        if new:
            self.learn(sorted(new))
        of = self.known.__getitem__
        return [sum(map(of, ws)) + added for ws, added in cut]


def counter(path: str) -> TokenCounter:
    return in_memory_cache("token_counts", path, lambda: TokenCounter(vocab_path(path)))


def token_counts(docs: DataFrame, text_col: str = "text", path: str = VOCAB, limit: int = LIMIT) -> DataFrame:
    """Replace the text by ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    keep = [c for c in docs.columns if c != text_col]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n = pa.array([n for _, _, part in text_slices(texts) for n in counter(path).counts(part)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, n_bytes, n, pc.greater(n, limit)],
                                             [*keep, "n_bytes", "n_tokens", "over_limit"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != text_col)
    return docs.mapInArrow(run, f"{kept}n_bytes long, n_tokens long, over_limit boolean")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents", "doc_id", "text"))
