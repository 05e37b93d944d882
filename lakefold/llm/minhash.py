"""Near-duplicate groups by MinHash with odd sketches.

A document is its set of distinct word shingles (hashes of 64 bits).  One
permutation MinHash gives ``SAMPLES`` samples (empty bins borrow from others
by a fixed random order per bin).  Bands of ``ROWS`` samples bring candidates
together; samples folded into a bitmap by parity (the odd sketch) tell, from
the population count of the XOR of two bitmaps, how many differ.  Candidates
further apart than a pair at the threshold can be go; the others are
confirmed on their full sets.

Documents with equal sets form one node, so copies never meet.  Within a band
bucket members meet the bucket's smallest node, not each other; confirmed
links give components, and only where a bucket holds several components do
members of different ones meet: their sketches, block by block inside a task
and each pair in the first band that it shares.  A link between two nodes is thereby either confirmed or
implied by others, with the odds of the bands: at a similarity of 0.8, a pair
shares no band with a probability of 5e-9.

Scale: one scan for the sketches, ``BANDS`` narrow rows per node shuffled
once, one shuffle of the texts that share a bucket.  Components are found by
joins on stored tables.  Nothing is collected.

Nodes are named by 64 bits of a 128-bit hash of their set.

Defined results: null, empty and blank texts have the empty set and are
linked with nothing; with fewer words than a shingle the whole sequence is
the one shingle; long texts are taken whole; repeated rows and equal sets
share a component; a null id is never the smallest unless the component has
no other; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import text_slices
from .common import in_memory_cache, read, released, stage, staging, text_of
from .components import connected_components

ROWS, BANDS = 5, 48
SAMPLES = ROWS * BANDS
SKETCH_BITS = 4096
#: Candidates go if their sketches differ in more bits than those of a pair
#: at the threshold would, by this many standard deviations.
SKETCH_SIGMAS = 6.0
#: Members of a bucket that are compared with each other at a time.
BUCKET_BLOCK = 1024
#: Pairs whose sketches are compared in one step.
PAIR_STEP = 1 << 15

U = np.uint64
_SEED = 0x5EED


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    per_byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
    order = np.stack([rng.permutation(SAMPLES) for _ in range(SAMPLES)])
    return per_byte, order


@dataclass
class Sets:
    """Distinct shingle hashes of documents: flat, ascending per document."""

    hashes: np.ndarray
    starts: np.ndarray  # one more than documents

    def __len__(self) -> int:
        return len(self.starts) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i]:self.starts[i + 1]]


def shingle_sets(texts: list[str | None], n_words: int) -> Sets:
    """The shingle sets of texts, computed over one buffer of all of them."""
    per_byte, _ = in_memory_cache("minhash", "tables", _tables)
    data = [(t or "").encode().lower() for t in texts]  # bytes.lower: A-Z only
    x = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    size = np.array([len(d) for d in data], np.int64)
    first = np.cumsum(size + 1) - size - 1
    blank = (x == 32) | ((x >= 9) & (x <= 13))
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    if not len(starts):
        return Sets(np.empty(0, U), np.zeros(len(texts) + 1, np.int64))
    # words: sum of byte values times powers of an odd base by position
    at = np.arange(len(x))
    at[starts[0]:] -= np.repeat(starts, np.diff(np.r_[starts, len(x)]))
    at[blank] = 0
    power = np.multiply.accumulate(np.r_[U(1), np.full(int(at.max()), 0x9E3779B97F4A7C15, U)])
    value = per_byte[x] * power[at]
    value[blank] = 0
    word = mix(np.add.reduceat(value, starts))
    doc = np.searchsorted(first, starts, "right") - 1
    n = np.bincount(doc, minlength=len(texts))
    # shingles that start at each word, and one of all words of a short document
    whole = (n[doc] < n_words) & np.r_[True, doc[1:] != doc[:-1]]
    h, ok = np.full(len(word), n_words, U), np.ones(len(word), bool)
    for i in range(n_words):
        last = max(0, len(word) - i)
        inside, step = np.zeros(len(word), bool), np.zeros(len(word), U)
        inside[:last] = doc[i:] == doc[:last]
        step[:last] = word[i:]
        h = np.where(inside, mix(h * U(0x9E3779B97F4A7C15) + step), h)
        ok &= inside
    keep = ok | whole
    h, doc = h[keep], doc[keep]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.empty(0, bool)
    h, doc = h[new], doc[new]
    return Sets(h, np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))])


def samples(sets: Sets) -> np.ndarray:
    """One permutation MinHash: the smallest hash of each of ``SAMPLES`` bins
    of the hash range, per non-empty set (rows of empty sets are 0)."""
    _, order = in_memory_cache("minhash", "tables", _tables)
    n = len(sets)
    doc = np.repeat(np.arange(n), np.diff(sets.starts))
    cell = doc * SAMPLES + ((sets.hashes >> U(40)) * U(SAMPLES) >> U(24)).astype(np.int64)
    out, full = np.zeros(n * SAMPLES, U), np.zeros(n * SAMPLES, bool)
    smallest = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
    out[cell[smallest]] = sets.hashes[smallest]  # ascending, so the first of a cell is its smallest
    full[cell[smallest]] = True
    out, full = out.reshape(n, SAMPLES), full.reshape(n, SAMPLES)
    row, gap = np.nonzero(~full & full.any(axis=1)[:, None])
    for probe in range(16):  # all gaps at once, while most find a full bin
        source = order[gap, probe]
        found = full[row, source]
        out[row[found], gap[found]] = out[row[found], source[found]]
        row, gap = row[~found], gap[~found]
    for i in np.unique(row):  # sets of few bins
        gaps = gap[row == i]
        out[i, gaps] = out[i, order[gaps, full[i][order[gaps]].argmax(axis=1)]]
    return out


def band_keys(sample: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, the band's number mixed in."""
    rows = sample.reshape(len(sample), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), (len(sample), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key * U(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key.astype(np.int64)


def odd_sketches(sets: Sets) -> np.ndarray:
    """Parity bitmaps: every sample flips one bit.  The samples folded are the
    finest there are, one bin per hash value, so all hashes of the set: then
    the differing bits follow from the sets' sizes and similarity alone."""
    n = len(sets)
    doc = np.repeat(np.arange(n), np.diff(sets.starts))
    bit = (mix(sets.hashes * U(0xD6E8FEB86659FD93)) % U(SKETCH_BITS)).astype(np.int64)
    flips = np.bincount(doc * SKETCH_BITS + bit, minlength=n * SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)


def similarity_estimate(bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Similarity from the population count of the XOR of two odd sketches
    and the sum of the set sizes."""
    left = np.maximum(1.0 - 2.0 * bits / SKETCH_BITS, 1e-9)
    differing = -SKETCH_BITS / 2.0 * np.log(left)
    return (sizes - differing) / (sizes + differing)


def most_bits(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Differing bits that a pair of the threshold's similarity stays below:
    the mean for its symmetric difference, plus ``SKETCH_SIGMAS`` standard
    deviations (exact moments of the parities of that many balls in bins)."""
    balls = np.asarray(sizes, np.float64) * (1 - threshold) / (1 + threshold)
    one, two = (1 - 2 / SKETCH_BITS) ** balls, (1 - 4 / SKETCH_BITS) ** balls
    variance = (SKETCH_BITS + SKETCH_BITS * (SKETCH_BITS - 1.0) * two - SKETCH_BITS ** 2 * one ** 2) / 4
    return SKETCH_BITS / 2 * (1 - one) + SKETCH_SIGMAS * np.sqrt(np.maximum(variance, 0)) + 1


SKETCHED = "doc_id long, content long, n_shingles long, node long, bands array<long>, sketch binary"


def sketch_documents(docs: DataFrame, n_words: int) -> DataFrame:
    """Per document: set size, node (null for the empty set), bands, sketch."""

    def run(batches):
        for batch in batches:
            for lo, hi, texts in text_slices(batch.column(2), 1 << 20):
                sets = shingle_sets(texts, n_words)
                n = np.diff(sets.starts)
                some = n > 0
                node = np.zeros(len(sets), np.int64)
                if some.any():
                    at = sets.starts[:-1][some]
                    total = np.add.reduceat(mix(sets.hashes ^ U(0xA5A5A5A5A5A5A5A5)), at)
                    parity = np.bitwise_xor.reduceat(mix(sets.hashes * U(3)), at)
                    node[some] = mix(mix(total + n[some].astype(U)) ^ parity).astype(np.int64)
                sample = samples(sets)
                keys = band_keys(sample)
                sketch = odd_sketches(sets)
                empty = ~some
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.array(node, pa.int64(), mask=empty),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(keys.ravel())),
                    pa.array([x.tobytes() for x in sketch], pa.binary())],
                    ["doc_id", "content", "n_shingles", "node", "bands", "sketch"])

    text = text_of("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("content"),
                       text.alias("text")).mapInArrow(released(run, "minhash"), SKETCHED)


def promising(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose sketches do not rule them out, with ``gap``,
    how far they are apart by them."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), U).reshape(batch.num_rows, -1) for c in (2, 3))
            sizes = batch.column(4).to_numpy()
            bits = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            found = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(1.0 - similarity_estimate(bits, sizes))], ["a", "b", "gap"])
            yield found.filter(pa.array(bits <= most_bits(sizes, threshold)))

    a, b = (sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"{c}_sketch"), F.col("n_shingles").alias(f"{c}_n")) for c in "ab")
    return (pairs.join(a, "a").join(b, "b").select("a", "b", "a_sketch", "b_sketch", (F.col("a_n") + F.col("b_n")).alias("sizes"))
            .mapInArrow(released(run, "minhash"), "a long, b long, gap double"))


def bucket_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Promising pairs ``a`` > ``b`` of nodes in different components that
    share a bucket, each pair from the first band that they share.

    ``members``: ``key``, ``lo``, ``hi``, ``block``, ``node``, ``comp``,
    ``n_shingles``, ``bands``, ``sketch``; a group (key, lo, hi) holds blocks
    lo and hi of a bucket.  Pairs stay inside the task as positions; what leaves it has
    passed the sketches."""
    names = ["key", "lo", "hi", "block", "node", "comp", "n_shingles", "bands", "sketch"]

    def found(rows: pa.Table):
        key, lo, hi, block, node, comp, n = (rows.column(c).to_numpy() for c in names[:7])
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), U).reshape(len(rows), -1)
        new = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        before = np.arange(len(rows)) - first  # rows of the group before each row
        to = np.cumsum(before)
        start = 0
        while start < len(rows):  # rows start..end make about PAIR_STEP pairs
            end = max(start + 1, int(np.searchsorted(to, (to[start - 1] if start else 0) + PAIR_STEP, "right")))
            i = np.repeat(np.arange(start, end), before[start:end])
            j = np.arange(len(i)) - np.repeat(np.cumsum(before[start:end]) - before[start:end], before[start:end]) + first[i]
            start = end
            go = (comp[i] != comp[j]) & ((lo[i] == hi[i]) | (block[i] != block[j]))
            i, j = i[go], j[go]
            bits = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)
            go = bits <= most_bits(n[i] + n[j], threshold)
            i, j = i[go], j[go]
            shared = bands[i] == bands[j]
            go = bands[i, shared.argmax(axis=1)] == key[i]
            i, j = i[go], j[go]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(node[i], node[j])), pa.array(np.minimum(node[i], node[j]))], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch.select(names)])
            held = rows if held is None else pa.concat_tables([held, rows])
            group = np.stack([held.column(c).to_numpy() for c in names[:3]])
            last = np.flatnonzero((group != group[:, -1:]).any(axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
            if cut:
                yield from found(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield from found(held)

    dealt = members.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.select(*names).mapInArrow(released(run, "minhash"), "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, n_words: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >=
    percent * union."""

    def run(batches):
        for batch in batches:
            keep = []
            for lo, hi, left in text_slices(batch.column(2), 1 << 19):
                x, y = shingle_sets(left, n_words), shingle_sets(batch.column(3).slice(lo, hi - lo).to_pylist(), n_words)
                for i in range(hi - lo):
                    p, q = x.of(i), y.of(i)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    a, b = (texts.select(F.col("node").alias(c), F.col("text").alias(f"{c}_text")) for c in "ab")
    return (pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text")
            .mapInArrow(released(run, "minhash"), "a long, b long"))


def _grouped(docs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """``doc_id``, ``content``, ``n_shingles``, ``component`` of every document."""
    threshold = percent / 100
    sketched = stage(sketch_documents(docs, n_words), "near-sketches")
    nodes = stage(sketched.filter("node is not null").dropDuplicates(["node"]), "near-nodes")
    sketches = nodes.select("node", "sketch", "n_shingles")

    # buckets of several nodes; each member beside the smallest.  Keys are counted before they are
    # shuffled, and a hot one is split by the join
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    centers = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("center")).filter("n > 1")
    members = stage(keyed.join(centers, "key").select("key", "node", "center"), "near-members")
    involved = members.select("node").distinct().join(nodes.select("node", "doc_id", "content"), "node")
    held = docs.select("doc_id", text_of("text").alias("text")).withColumn("content", F.xxhash64("text"))
    texts = stage(held.withColumnRenamed("doc_id", "id").withColumnRenamed("content", "own")
                  .join(involved, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("content")))
                  .select("node", "text").dropDuplicates(["node"]), "near-texts")

    def across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components so far."""
        a, b = (comp.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp")) for c in "ab")
        return (pairs.join(a, "a", "left").join(b, "b", "left")
                .filter(F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b")).drop("a_comp", "b_comp"))

    # round 1: every node and the most alike of its buckets' smallest nodes
    stars = members.filter("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    stars = stage(promising(stars, sketches, threshold), "near-stars")
    best = stars.groupBy("a").agg(F.min(F.struct("gap", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    tested = stage(best, "near-best")
    links = stage(confirmed(tested, texts, n_words, percent), "near-links")
    comp = connected_components(links)
    # round 2: the other smallest nodes, where that joins two components
    rest = stage(across(stars.join(tested, ["a", "b"], "left_anti"), comp), "near-rest")
    if not rest.isEmpty():
        links = stage(links.union(confirmed(rest, texts, n_words, percent)), "near-links")
        tested = tested.select("a", "b").union(rest.select("a", "b"))
        comp = connected_components(links)
    # round 3: all members of a bucket that are still in different components
    own = stage(members.select("key", "node").join(comp, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp")), "near-comps")
    split = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    open_ = stage(own.join(split, "key", "left_semi"), "near-open")
    sizes = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BUCKET_BLOCK).alias("blocks"))
    blocked = (open_.join(sizes, "key").join(nodes.select("node", "n_shingles", "bands", "sketch"), "node")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
               .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}))
    pairs = bucket_pairs(blocked, threshold).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    pairs = stage(pairs, "near-last")
    if not pairs.isEmpty():
        links = stage(links.union(confirmed(pairs, texts, n_words, percent)), "near-links")
        comp = connected_components(links)

    return sketched.select("doc_id", "content", "n_shingles", "node").join(comp, "node", "left").select(
        "doc_id", "content", "n_shingles", F.coalesce("comp", "node").alias("component"))


def _groups(docs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The stored result of ``_grouped``; what it is found from goes."""
    with staging(docs.sparkSession):
        return stage(_grouped(docs, n_words, percent), "near-rows", kept=True)


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs``: ``doc_id``, ``text``.  One row per document: ``doc_id``,
    ``content`` (hash of the text), ``n_shingles``, ``component_id`` (smallest
    id of its group), ``component`` (the group's name, null without shingles)
    and ``first`` (it has the smallest id and, of these, content)."""
    rows = _groups(docs, n_words, percent)
    least = rows.filter("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content")).alias("least"))
    return rows.join(least, "component", "left").select(
        "doc_id", "content", "n_shingles", "component",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("component").isNull() | (F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
                                        & (F.col("content") == F.col("least.content")))).alias("first"))


def deduplicated(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id; documents
    without words all stay.  All columns stay."""
    found = _groups(docs.select("doc_id", "text"), n_words, percent)
    # the first of a group is a minimum, taken before groups are shuffled
    least = found.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content")).alias("least"))
    first = least.select(F.struct("least.doc_id", "least.content").alias("which"), "component")
    lone = found.filter("component is null").select(F.struct("doc_id", "content").alias("which"), "component").distinct()
    row = docs.select(F.struct(*docs.columns).alias("near_row"))
    keyed = row.select("near_row", F.struct(F.col("near_row.doc_id").cast("long").alias("doc_id"),
                                            F.xxhash64(text_of("near_row.text")).alias("content")).alias("own"))
    chosen = stage(first.unionByName(lone), "near-kept")
    kept = keyed.join(chosen, F.col("own").eqNullSafe(F.col("which")))
    # repeated rows of the kept document: one stays; documents without words have no group
    single = kept.filter("component is not null").dropDuplicates(["component"])
    return single.select("near_row.*").unionByName(kept.filter("component is null").select("near_row.*"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, n_words=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM w),
e AS (SELECT doc_id, unnest(shingles) AS shingle, len(shingles) AS n FROM s),
both_ AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
    AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
links AS (SELECT a, b FROM both_ UNION ALL SELECT b, a FROM both_),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
"""
