"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots (thousands).  Bytes
and rows are aggregated per slot, and a slot-to-shard map of that fixed
size says where each slot lives.  The map is a versioned table: rebalancing
reads the latest version, *edits* it (moves or swaps single slots between
the heaviest and the lightest shard) and writes the next version; records
never hash to another slot, so an edit moves only the slots it names.

Law kept: ``bytes`` (shard sizes near equal).

Scale: one scan of the text (equal records are counted before they are
shuffled and come back as numbered copies, staged as a narrow table), one
map-side combined aggregate over at most ``n_slots`` keys, one shuffle of
narrow rows by slot for the positions.  Only the map, of the fixed size
``n_slots``, is planned on the driver and broadcast.

Defined results: a null text has size 1 (0 bytes plus 1); null ids hash like
any value; the copies of a record that agrees with others in id and text are
numbered and hash with their number, so they spread over the slots like
other records; an empty table gives an even map and no rows.  Further
columns are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, scratch_path, stage, text_of

N_SLOTS = 8192
#: Copies of one record that a task numbers at a time.
COPIES = 100_000


def slot_of(id_col: str = "doc_id", digest_col: str = "digest", copy_col: str = "copy", n_slots: int = N_SLOTS) -> Column:
    """The record's virtual slot: a function of the record and, where it
    repeats, of its copy's number.  The text's digest takes part so that
    records sharing a hot id spread over the slots."""
    return F.pmod(F.xxhash64(id_col, digest_col, copy_col), F.lit(n_slots)).cast("int")


def numbered_copies(records: DataFrame, copy_col: str = "copy") -> DataFrame:
    """All records, equal ones numbered from 0.  Equal records cannot be told
    apart, so they are counted and written out again from the count, in runs
    of ``COPIES`` that are shuffled apart."""
    keys = records.columns
    runs = (records.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, "n", F.explode(F.expr(f"sequence(0, (n - 1) div {COPIES})")).alias("run")))
    many = runs.filter(F.col("n") > COPIES).repartition(*keys, "run")
    return (runs.filter(F.col("n") <= COPIES).unionByName(many)
            .select(*keys, F.explode(F.expr(f"sequence(run * {COPIES}, least(n, (run + 1) * {COPIES}) - 1)")).alias(copy_col)))


def slot_stats(records: DataFrame, slot: str = "vslot", size: str = "size") -> DataFrame:
    """Bytes and rows per slot (at most ``n_slots`` rows)."""
    return records.groupBy(slot).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))


def even_map(n_slots: int, n_shards: int) -> list[int]:
    return [s % n_shards for s in range(n_slots)]


def _best_edit(heavy: list[tuple[int, int]], light: list[tuple[int, int]], gap: int):
    """The move or swap (slot out, slot back or None) that comes nearest to
    halving ``gap``; lists are (bytes, slot) ascending."""
    best, best_miss = None, gap  # an edit must lower the gap: transfer strictly between 0 and gap
    sizes = [b for b, _ in light]
    for b, s in heavy:
        want = b - gap / 2
        at = bisect.bisect_left(sizes, want)
        for i in (at - 1, at):
            if 0 <= i < len(light) and 0 < b - sizes[i] < gap and abs(2 * (b - sizes[i]) - gap) < best_miss:
                best, best_miss = (s, light[i][1]), abs(2 * (b - sizes[i]) - gap)
        if 0 < b < gap and abs(2 * b - gap) < best_miss:
            best, best_miss = (s, None), abs(2 * b - gap)
    return best


def rebalance(current: list[int], weights: dict[int, int], n_shards: int,
              tolerance: float = 0.0005, max_edits: int = 20_000) -> tuple[list[int], int]:
    """Edit a slot map until the heaviest and the lightest shard differ by at
    most ``tolerance`` of the mean (or no single move or swap helps).  Returns
    the new map and the number of slots that moved.  Works on the map alone,
    whose size is fixed."""
    edited = list(current)
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(edited):
        if weights.get(slot, 0):
            held[shard].append((weights[slot], slot))
    for x in held:
        x.sort()
    load = [sum(b for b, _ in x) for x in held]
    mean = sum(load) / n_shards
    for _ in range(max_edits):
        hi, lo = max(range(n_shards), key=load.__getitem__), min(range(n_shards), key=load.__getitem__)
        gap = load[hi] - load[lo]
        if gap <= tolerance * mean or (edit := _best_edit(held[hi], held[lo], gap)) is None:
            break
        for slot, src, dst in ((edit[0], hi, lo), (edit[1], lo, hi)):
            if slot is None:
                continue
            item = (weights[slot], slot)
            held[src].remove(item)
            bisect.insort(held[dst], item)
            load[src] -= item[0]
            load[dst] += item[0]
            edited[slot] = dst
    return edited, sum(a != b for a, b in zip(current, edited))


class SlotMap:
    """The versioned slot-to-shard map: one folder per version."""

    def __init__(self, spark: SparkSession, path: str, n_slots: int = N_SLOTS):
        self.spark, self.path, self.n_slots = spark, path.rstrip("/"), n_slots

    def write(self, version: int, shards: list[int]) -> None:
        rows = list(enumerate(shards))
        (self.spark.createDataFrame(rows, "vslot int, shard int").coalesce(1)
         .write.parquet(f"{self.path}/version={version}"))

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={version}").select("vslot", "shard")

    def shards(self, version: int) -> list[int]:
        out = [0] * self.n_slots
        for r in self.read(version).collect():  # n_slots rows
            out[r.vslot] = r.shard
        return out


def shard_records(records: DataFrame, n_shards: int, map_path: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Place records (columns ``doc_id``, ``size``, ``vslot`` and any others)
    on shards by bytes.  Writes map version 0 (even) and version 1 (edited by
    the slots' bytes) under ``map_path``; adds ``shard`` and ``slot``, the
    record's position in its shard, gapless from 0."""
    spark = records.sparkSession
    slots = SlotMap(spark, map_path, n_slots)
    slots.write(0, even_map(n_slots, n_shards))
    stats = {r.vslot: (r.bytes, r.rows) for r in slot_stats(records).collect()}  # n_slots rows at most
    edited, _ = rebalance(slots.shards(0), {s: b for s, (b, _) in stats.items()}, n_shards)
    slots.write(1, edited)
    first, offset = [0] * n_shards, []
    for slot, shard in enumerate(edited):  # where each slot starts in its shard
        offset.append((slot, first[shard]))
        first[shard] += stats.get(slot, (0, 0))[1]
    starts = spark.createDataFrame(offset, "vslot int, slot_start long")
    placed = records.join(F.broadcast(slots.read(1).join(starts, "vslot")), "vslot")  # n_slots rows
    in_slot = Window.partitionBy("vslot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    return placed.withColumn("slot", F.col("slot_start") + F.row_number().over(in_slot) - 1).drop("slot_start")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    text = text_of("text").cast("binary")
    digests = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                          F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("digest"))
    narrow = stage(numbered_copies(digests).withColumn("vslot", slot_of()), "op1")
    placed = shard_records(narrow, 8, scratch_path(spark, "op1-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"))
