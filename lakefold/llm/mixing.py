"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document's expected copies
are target / source size.  The whole part is certain.  The fractional parts
are rounded by the pivotal method: two documents meet, words of expected
mass move from one to the other in a random direction (with the
probabilities that keep both expectations) until one of them has a whole
number of copies; the other meets the next.  Mass is counted in words, so
every meeting keeps the source's words exactly, and one document per group
is left with a fraction.

Groups are hash buckets of a source, sized by its row count, so a source
that holds a third of all rows is many groups.  The documents left over
combine in a reduction tree: ``FANOUT`` groups' residuals form the next
level's group, until one document per source is left, which is rounded by
its own probability.  Each source's taken words therefore miss its target by
less than one document's size.

Random numbers are seeded by source, level and bucket, and documents meet in
an order given by their own values: reruns, retries and other partitionings
agree.  Rows that agree in id, source, size and text would keep their sum of
fractions among themselves, so they enter as one unit with a row count: all
but one of them are rounded on the spot, and a repeated row costs no more
than a single one.

Scale: one scan of the texts (sizes are staged as a narrow table), one
shuffle of the narrow rows by group, tables of one row per source or group
after that.  Only the largest group number reaches the driver.

Defined results: a null or empty text has size 0 and takes the whole part of
its copies; a null source is a source of its own, last in order; repeated
rows get copies that differ by one at most; null ids pass through; an empty table gives no
rows.  Source statistics are one row per source.
"""

from __future__ import annotations

import random
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import WORD, read, stage, text_of

#: Documents in a group at the first level, on average.
GROUP_ROWS = 4096
#: Groups whose residuals form a group of the next level.
FANOUT = 256
#: Copies of one row that a task writes at a time.
RUN = 1000
SEED = 5
WEIGHTS = (3, 1, 2)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """One row per source: rows, size, target.  Sources in code point order,
    null last, weigh ``weights``, repeating, and share ``share`` of all sizes;
    a target stops at ``most`` times its source's size and the excess is
    shared by weight again.  That ends at one level per weight: in the order
    of cap / weight, the first source whose cap lies above the level that the
    words left give."""
    by_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.orderBy("cap_level", "no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("cap_level", "no").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("cap_level", "no").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    caps = (by_source.withColumn("no", F.row_number().over(order) - 1)
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int")))
            .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
            .withColumn("cap_level", F.col("cap") / F.col("weight")))
    levels = (caps.withColumn("level", (F.lit(share) * F.sum("source_size").over(every)
                                        - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                              / F.sum("weight").over(after))
              .withColumn("level", F.min(F.when(F.col("cap_level") >= F.col("level"), F.struct("cap_level", "no", "level")))
                          .over(every)["level"]))
    return levels.select("source", "no", "n_rows", "source_size",
                         F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def pivot(units: list[tuple[int, float]], rng: random.Random) -> tuple[list[int | None], int | None, float]:
    """Round fractions of units (size, fraction in 0..1) in the given order.
    Returns 0 or 1 per unit, the unit left over (its value is None) and the
    fraction that it has now."""
    out: list[int | None] = [None] * len(units)
    held, f = None, 0.0
    for i, (size, g) in enumerate(units):
        if size <= 0 or g <= 0.0 or g >= 1.0:  # nothing to move
            out[i] = int(g >= 1.0)
            continue
        if held is None:
            held, f = i, g
            continue
        own, other = units[held][0], size
        up = min((1.0 - f) * own, g * other)  # words that can move to the held unit
        down = min(f * own, (1.0 - g) * other)
        if rng.random() * (up + down) < down:
            whole_held, whole_other = (1.0 - f) * own <= g * other, (1.0 - f) * own >= g * other
            f, g = (1.0 if whole_held else f + up / own), (0.0 if whole_other else g - up / other)
        else:
            whole_held, whole_other = f * own <= (1.0 - g) * other, f * own >= (1.0 - g) * other
            f, g = (0.0 if whole_held else f - down / own), (1.0 if whole_other else g + down / other)
        if whole_held:
            out[held] = int(f)
            held, f = (None, 0.0) if whole_other else (i, g)
        if whole_other:
            out[i] = int(g)
    return out, held, f


def _pivot_groups(units: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree: per (source number, bucket), round ``extra`` of
    the units; ``fraction`` is left where ``extra`` is null."""
    names = units.columns

    def run(table: pa.Table) -> pa.Table:
        # similar sizes meet; the order is the units' own, whatever partition they came from
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("content", "ascending")])
        no, bucket = table.column("no")[0].as_py(), table.column("bucket")[0].as_py()
        rng = random.Random(f"{seed}:{level}:{no}:{bucket}")
        fractions = table.column("fraction").to_pylist()
        out, held, f = pivot(list(zip(table.column("size").to_pylist(), fractions)), rng)
        if held is not None:
            fractions[held] = f
            if last:
                out[held] = int(rng.random() < f)
        table = table.set_column(names.index("fraction"), "fraction", pa.array(fractions, pa.float64()))
        return table.set_column(names.index("extra"), "extra", pa.array(out, pa.int32()))

    return units.groupBy("no", "bucket").applyInArrow(run, units.schema)


#: What a unit is told apart by.
UNIT = ("doc_id", "source", "size", "content")


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2,
        seed: int = SEED, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``sized``: a row of ``UNIT`` columns per document (a stored table: it
    is read more than once).  Returns one row per unit: ``n`` documents, of
    which ``n_more`` are taken ``base + 1`` times and the others ``base``
    times, beside ``source_size`` and ``target``."""
    targets = stage(source_targets(sized, weights, share, most), "mix-targets")  # a row per source
    unit = sized.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("source", "own")
    units = (unit.join(targets, F.col("own").eqNullSafe(F.col("source")))
             .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
             .withColumn("base", F.floor("rate").cast("int"))
             .withColumn("sum", F.col("n") * (F.col("rate") - F.col("base")))
             .withColumn("n_more", F.floor("sum"))
             .withColumn("fraction", F.col("sum") - F.col("n_more"))
             .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "content"), F.ceil(F.col("n_rows") / group_rows)))
             .withColumn("extra", F.lit(None).cast("int"))
             .select(*UNIT, "source_size", "target", "n", "base", "n_more", "no", "bucket", "fraction", "extra"))
    groups = targets.select(F.max(F.ceil(F.col("n_rows") / group_rows))).first()[0] or 1
    level, levels = 0, []
    while True:
        done = stage(_pivot_groups(units, level, groups <= 1, seed), f"mix-level{level}")
        levels.append(done if groups <= 1 else done.filter("extra is not null"))
        if groups <= 1:
            break
        units = done.filter("extra is null").withColumn("bucket", F.floor(F.col("bucket") / FANOUT))
        groups, level = -(-groups // FANOUT), level + 1
    return reduce(DataFrame.unionByName, levels).select(
        *UNIT, "source_size", "target", "n", "base", (F.col("n_more") + F.col("extra")).alias("n_more"))


def sized_documents(docs: DataFrame) -> DataFrame:
    """The ``UNIT`` columns of documents: words counted, texts hashed."""
    return docs.select("doc_id", "source", F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(text_of("text")).alias("content"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each row as often as it is taken; ``docs``
    has ``doc_id``, ``source``, ``text`` and any other columns, which stay."""
    spread = docs.select(F.struct(*docs.columns).alias("mix_row"))
    size = F.regexp_count(text_of("mix_row.text"), F.lit(WORD)).cast("long")
    rows = spread.select("mix_row", F.col("mix_row.doc_id").alias("doc_id"), F.col("mix_row.source").alias("source"),
                         size.alias("size"), F.xxhash64(text_of("mix_row.text")).alias("content"))
    units = mix(stage(rows.select(*UNIT), "mix-sizes"), **settings).select(
        F.struct(*UNIT).alias("unit"), "n", "base", "n_more")
    joined = rows.withColumn("own", F.struct(*UNIT)).select("mix_row", "own").join(
        units, F.col("own").eqNullSafe(F.col("unit"))).drop("unit")
    one = joined.filter("n = 1").select("mix_row", (F.col("base") + F.col("n_more")).alias("copies"))
    one = one.filter("copies > 0").select("mix_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("mix_row.*")
    return one.unionByName(_repeated(joined.filter("n > 1")).select("mix_row.*"))


def _repeated(rows: DataFrame) -> DataFrame:
    """``mix_row`` of repeated units, each as often as it is taken.  Rows that
    agree in all columns cannot be told apart: they are counted before they
    are shuffled and written out again in runs of ``RUN`` copies that are
    shuffled apart, so a third of all rows may be equal."""
    marked = rows.withColumn("variant", F.sha2(F.to_json("mix_row"), 256))
    same = marked.groupBy("own", "variant").agg(
        F.count(F.lit(1)).alias("m"), F.any_value("mix_row").alias("mix_row"), F.any_value("base").alias("base"), F.any_value("n_more").alias("n_more"))
    # how many rows of a unit come before a variant: one narrow row per variant
    before = F.sum("m").over(Window.partitionBy("own").orderBy("variant")) - F.col("m")
    stored = stage(same, "mix-variants")
    more = F.least(F.greatest(F.col("n_more") - F.col("before"), F.lit(0).cast("long")), F.col("m"))
    counts = stored.select("own", "variant", "m", "base", "n_more").withColumn("before", before).select(
        F.col("own").alias("of"), F.col("variant").alias("which"), (F.col("m") * F.col("base") + more).alias("copies"))
    runs = (stored.select("own", "variant", "mix_row").join(counts, F.col("own").eqNullSafe(F.col("of")) & (F.col("variant") == F.col("which")))
            .filter("copies > 0").select("mix_row", "variant", "copies", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})")).alias("run")))
    many = runs.filter(F.col("copies") > RUN).repartition("variant", "run")
    return runs.filter(F.col("copies") <= RUN).unionByName(many).select(
        "mix_row", F.explode(F.expr(f"sequence(run * {RUN}, least(copies, (run + 1) * {RUN}) - 1)")).alias("copy"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    units = mix(stage(sized_documents(docs), "mix-sizes"))
    each = units.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    copies = F.col("base") + (F.col("i") <= F.col("n_more")).cast("int")
    return each.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"),
                       copies.cast("int").alias("copies"))
