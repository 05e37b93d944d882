"""Document fingerprints by spot signatures.

A signature is a common word (anchor) with the chain of the next content
words, common words left out.  A document's fingerprint is the set of its
signatures' hashes; likeness is the Jaccard similarity of two sets.  Where
``GAP`` words pass without an anchor (lists, tables, other languages) each
further word serves as one; texts of fewer than ``SHORT`` characters, or with
so few words, also give their character grams, so that they can be compared.

Near duplicates (``similar_pairs``): sets are partitioned by length such that
a set can only match its own and the next partition, meet on their rarest
signatures, and are compared by Jaccard, pruned where the lengths alone rule
a match out.

Everything is DataFrame functions; nothing runs in Python on the executors.

Scale: for the next document's text, documents are bucketed by quantiles of
the id (``BUCKETS`` at most), shuffled once, and each bucket gets a copy of
the next bucket's first document; no window spans the table.

Defined results: a null text is the empty text, whose fingerprint is empty;
two empty fingerprints are alike (1.0), an empty and another are not (0.0);
ids sort null first, equal ids by text; the only document is its own next;
long texts are taken whole; repeated rows follow one another; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read, text_of

#: Common words of the languages expected; a parameter.
ANCHORS = (
    # English
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "with", "you",
    # German
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    # French
    "avec", "dans", "du", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    # Spanish
    "con", "del", "el", "las", "lo", "los", "no", "para", "por", "se", "una", "y",
)
#: Content words in a chain, and how far ahead they may lie.
CHAIN, AHEAD = 2, 8
#: Words without an anchor after which every word starts a chain.
GAP = 8
#: Characters below which a text, or the mean word's share of it above which
#: its words, say too little: then it also gives grams of GRAM characters.
SHORT, GRAM = 64, 4
#: Documents in a bucket, and most buckets.
BUCKET_ROWS, BUCKETS = 4096, 20_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def bare_characters(words_col: str, text_col: str) -> Column:
    """The characters of a text whose words say too little, else none."""
    n = F.length(text_col)
    bare = (n > 0) & ((n < SHORT) | (F.size(words_col) * SHORT < n))
    return F.when(bare, F.split(F.lower(text_col), "")).otherwise(F.array().cast("array<string>"))


def signatures(words_col: str, chars_col: str, anchors: tuple[str, ...] = ANCHORS) -> Column:
    """The set of signature hashes from the columns of ``words`` and
    ``bare_characters``.  Both must be columns: inside a lambda an expression
    is evaluated again for every element."""
    w, chars = F.col(words_col), F.col(chars_col)

    def start(x: Column, i: Column) -> Column:
        """(anchor, chain) if a chain starts at word i, else a null chain."""
        content = F.slice(F.filter(F.slice(w, i + 2, AHEAD), lambda y: ~y.isin(*anchors)), 1, CHAIN)
        recent = F.exists(F.slice(w, F.greatest(i + 1 - GAP, F.lit(1)), F.least(i, F.lit(GAP))), lambda y: y.isin(*anchors))
        common = x.isin(*anchors)
        return F.struct(common.alias("common"), x.alias("word"),
                        F.when(common, content).when(~recent, F.slice(w, i + 2, CHAIN)).alias("chain"))

    chains = F.filter(F.transform(w, start), lambda s: F.size(s["chain"]) >= F.when(s["common"], 1).otherwise(0))
    spots = F.transform(chains, lambda s: F.hash(s["common"], s["word"], s["chain"]))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(chars) - GRAM + 1, F.lit(1))),
                        lambda i: F.hash(F.lit("gram"), F.slice(chars, i, GRAM)))
    return F.array_sort(F.array_distinct(F.concat(
        spots, F.when(F.size(chars) > 0, grams).otherwise(F.array().cast("array<int>")))))


def with_signatures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    w, chars = f"{out}_words", f"{out}_chars"
    return (df.withColumn(w, words(F.col(text_col))).withColumn(chars, bare_characters(w, text_col))
            .withColumn(out, signatures(w, chars)).drop(w, chars))


def as_text(sigs: Column) -> Column:
    """A fingerprint in print: its hashes in order, eight hex digits each."""
    return F.array_join(F.transform(sigs, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard similarity of two sets; below ``floor`` by their lengths alone
    it is not computed (0.0)."""
    shared = F.size(F.array_intersect(a, b))
    hopeless = F.least(F.size(a), F.size(b)) < floor * F.greatest(F.size(a), F.size(b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0) | hopeless, 0.0)
            .otherwise(shared / (F.size(a) + F.size(b) - shared)))


def length_partition(n: Column, threshold: float) -> Column:
    """Sets that can reach the threshold lie in the same or neighbouring
    partitions: each spans lengths up to 1 / threshold times its least."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.0 / threshold))).cast("int")


def similar_pairs(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``prints``: ``doc_id``, ``signature``.  Pairs ``a`` < ``b`` of
    representatives (smallest id of equal sets) with their ``likeness`` of at
    least the threshold.  Empty sets match nothing."""
    sets = prints.filter(F.size("signature") > 0).groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
    n = F.size("signature")
    posted = sets.select("doc_id", n.alias("n"), F.explode("signature").alias("s"))
    frequency = posted.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    # two sets of the threshold's likeness share one of the first n - ceil(t n) + 1 signatures in any common order
    rare = (posted.join(frequency, "s").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))
            .withColumn("part", length_partition(F.col("n"), threshold))
            .select("doc_id", "n", "part", F.explode(F.slice("o", 1, F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1)).alias("p"))
            .select("doc_id", "n", "part", F.col("p.s").alias("s")))
    left = rare.select(F.col("doc_id").alias("a"), F.col("n").alias("a_n"), "s", F.explode(F.array("part", F.col("part") + 1)).alias("part"),
                       F.col("part").alias("a_part"))
    right = rare.select(F.col("doc_id").alias("b"), F.col("n").alias("b_n"), "s", "part")
    pairs = (left.join(right, ["s", "part"])
             .filter((F.col("a_part") < F.col("part")) | (F.col("a") < F.col("b")))
             .filter(F.least("a_n", "b_n") >= threshold * F.greatest("a_n", "b_n") - 1e-9)
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("signature").alias(f"{c}_sig")) for c in "ab")
    return (pairs.join(one, "a").join(two, "b")
            .select("a", "b", likeness(F.col("a_sig"), F.col("b_sig"), threshold).alias("likeness"))
            .filter(F.col("likeness") >= threshold - 1e-12))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` by bucket, plus one row (``copy``) per bucket for
    the first document of the next bucket; columns ``bucket``, ``copy``."""
    docs = docs.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    n = docs.count()
    buckets = max(1, min(BUCKETS, -(-n // BUCKET_ROWS)))
    cuts = docs.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0] if buckets > 1 else []
    splits = [float("-inf"), *sorted({float(c) for c in cuts or []}), float("inf")]
    if len(splits) > 2:
        docs = Bucketizer(splits=splits, inputCol="at", outputCol="bucket").transform(docs).withColumn("bucket", F.col("bucket").cast("int"))
    else:
        docs = docs.withColumn("bucket", F.lit(0))
    firsts = docs.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least"))
    order = Window.orderBy("bucket")  # a row per bucket
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    previous = firsts.select(F.col("least.doc_id").alias("first_id"), F.coalesce(
        F.lag("bucket").over(order), F.max("bucket").over(whole)).alias("into"))
    copies = (docs.select("doc_id", "text").join(F.broadcast(previous), F.col("doc_id").eqNullSafe(F.col("first_id")))
              .groupBy("into").agg(F.min("text").alias("text"))
              .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("into").alias("bucket"), F.lit(1).alias("copy")))
    return docs.select("doc_id", "text", "bucket", F.lit(0).alias("copy")).unionByName(copies)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its own, its edited text's and the next document's
    signatures, beside lengths and the edited text."""
    rows = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")))
    rows = with_signatures(rows.repartition("bucket"), "text", "signature")
    order = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_first(), "text")
    ahead = rows.withColumns({"next_text": F.lead("text").over(order), "next_signature": F.lead("signature").over(order),
                              "n_chars": F.length("text").cast("long")}).filter("copy = 0")
    take = F.floor(F.col("n_chars") / 4).cast("int")
    edited = ahead.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - take),
                                                 F.when(take > 0, F.substring("next_text", F.lit(1), take)).otherwise("")))
    return with_signatures(edited, "edited", "edited_signature")


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(read(spark, sf_dir, "documents", "doc_id", "text"))
    own, changed, following = F.col("signature"), F.col("edited_signature"), F.col("next_signature")
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"))
