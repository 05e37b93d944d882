"""Filter interaction audit by recursive enumeration of filter orders.

Five filters judge every document; a document's failures are a mask of five
bits.  All orders of the filters are audited from the counts per mask, not
from the documents: a recursive CTE starts with the empty prefix beside each
mask that occurs, and each level extends every prefix by each unused letter,
carries the bits applied so far, and emits the new step's outcome for that
mask (kept, removed here, or redundant).  325 prefixes stand for the 120
orders, since a step depends only on the letters before it.  The outcomes
are joined with the counts of each part and added up.

Filters (words are maximal runs of anything but space and 0x09-0x0D):
A under 50 words; B distinct words under 65 % of the words; C upper-case
A-Z over 5 % of the code points; D any of ``#$%&*|``; E the text of a
smaller id, table-wide.

Scale: one scan of the texts, staged as one narrow row each (id, part, text
digest, mask).  Equal rows are counted before they are shuffled; the first
id of a text is a map-side combined minimum and meets the documents on
(id, digest), so that a text of a third of all rows is no hot key; rows
without id, which can neither repeat a smaller id nor be labelled, take no
part in the joins.  The enumeration has at most 32 x 326 rows whatever the
input, and is broadcast; parts may be as many as they like.

Defined results: a null text is the empty text, a null source the part '';
a null id is not smaller than any and has no smaller one, so it never fails
E, and it has no labels; rows equal in id and text do not repeat each other;
of several label rows of an id any that says 1 counts; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import WORD, read, stage, text_of

LETTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, SYMBOLS = 50, 65, 5, "[#$%&*|]"

#: Prefixes of filter orders beside each mask that occurs; ``bit`` is the
#: last letter's, ``before`` the bits of the letters in front of it.
WALK = """
WITH RECURSIVE walk(prefix, letter, step, bit, before, applied, mask) AS (
    SELECT '', '', 0, 0, 0, 0, mask FROM {masks}
    UNION ALL
    SELECT /*+ BROADCAST(u) */ concat(w.prefix, u.letter), u.letter, w.step + 1, u.bit, w.applied, w.applied | u.bit, w.mask
    FROM walk w JOIN {unused} u ON w.applied = u.applied
)
SELECT prefix, letter, step, mask,
    CAST(mask & applied = 0 AS INT) AS kept,
    CAST(mask & bit <> 0 AND mask & before = 0 AS INT) AS removed,
    CAST(mask & bit <> 0 AND mask & before <> 0 AS INT) AS redundant,
    CAST(mask = bit AS INT) AS only
FROM walk WHERE step > 0
"""


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at the text alone (all but E)."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    chars = F.length(text).cast("long")
    upper = chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failures = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n, 100 * upper > MAX_UPPER_PERCENT * chars,
                text.rlike(SYMBOLS)]
    bits = [f.cast("int") * (1 << i) for i, f in enumerate(failures)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per ``part`` and ``mask`` that occurs: documents ``n``, and how many of
    them are labelled ``good`` and ``toxic``."""
    repeat = 1 << LETTERS.index("E")
    rows = stage(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text_of("text").alias("text"),
    ).select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
             text_failures(F.col("text")).alias("mask")), "audit-rows")
    known = rows.filter("doc_id IS NOT NULL")
    counted = known.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    judged = (counted.join(firsts, ["doc_id", "digest"], "left").join(said, "doc_id", "left").select(
        "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(repeat)).alias("mask"), "n",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    unknown = rows.filter("doc_id IS NULL").select(
        "part", "mask", F.lit(1).cast("long").alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return judged.union(unknown).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def walk_orders(spark: SparkSession, masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The outcome of every prefix of every order for every mask (at most 32,
    so one partition holds them; a level keeps its predecessor's partitions)."""
    unused = [(applied, c, 1 << i) for applied in range(1 << len(letters)) for i, c in enumerate(letters) if not applied >> i & 1]
    return spark.sql(WALK, masks=masks.coalesce(1), unused=spark.createDataFrame(unused, "applied int, letter string, bit int"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    spark = docs.sparkSession
    cells = stage(mask_cells(docs, labels), "audit-cells")
    walk = stage(walk_orders(spark, cells.select("mask").distinct()), "audit-walk")  # at most 32 x 325 rows
    steps = cells.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "letter", "step").agg(
        F.sum(F.col("n") * F.col("kept")).alias("kept"), F.sum(F.col("n") * F.col("removed")).alias("removed"),
        F.sum(F.col("n") * F.col("redundant")).alias("redundant"), F.sum(F.col("n") * F.col("only")).alias("unique_fails"),
        F.sum(F.col("good") * F.col("removed")).alias("good_lost"), F.sum(F.col("toxic") * F.col("removed")).alias("toxic_lost"))
    # a prefix of k letters begins (5 - k)! orders
    weight = F.factorial(F.lit(len(LETTERS)) - F.col("step"))
    steps = steps.withColumn("shapley", F.sum(F.col("removed") * weight).over(Window.partitionBy("part", "letter")))
    orders = (walk.filter(F.col("step") == len(LETTERS)).select(F.col("prefix").alias("filter_order")).distinct()
              .select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("at"))
              .select("filter_order", F.expr("substring(filter_order, 1, at)").alias("prefix")))  # 600 rows
    return steps.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents", "doc_id", "text", "source"),
                 read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


ORACLE = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '{WORD}') AS w FROM docs),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (SELECT w.part, coalesce(s.good, 0) AS good, coalesce(s.toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
    FROM words w LEFT JOIN said s ON w.doc_id = s.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
filters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM filters a, filters b, filters c, filters d, filters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
walk AS (
    SELECT filter_order, bits, 0 AS step, 0 AS bit, 0 AS before, 0 AS applied FROM orders
    UNION ALL
    SELECT filter_order, bits, step + 1, bits[step + 1], applied, applied | bits[step + 1] FROM walk WHERE step < 5),
counts AS (SELECT c.part, w.filter_order, w.step, w.bit,
    sum(CASE WHEN mask & applied = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells c, walk w WHERE w.step > 0 GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counts
"""
