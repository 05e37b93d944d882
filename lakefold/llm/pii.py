"""Personal data: candidate spans scored by boosted trees.

Base spans follow fixed rules (``BASE``).  Beyond them, high-recall
generators propose spans that may overlap each other: address-like strings,
also with a spelt-out at sign, number-like strings with narrow and with
loose separators, and within every number string, however long, all windows
of consecutive digit groups with 7 to 19 digits (a number beside another
one; a start group has at most ``WINDOW`` windows).  Each candidate has format features (digits, groups,
separators, a valid dotted quad, the Luhn check) and context features (words
before it, neighbouring letters).  Weak labels say which candidates agree
with a base span of a kind (positives); the features leave out what the base
rules insist on (a plus sign, a literal @ or dot), so the trees carry a
kind's other marks over to strings that the rules miss.

Negatives are true ones: candidates that fail the kind's check (digits,
Luhn, quad, a dotted host) or meet a base span that they do not agree with.
The check's own feature is hidden from the kind's trees (``HIDDEN``), else it
would tell the classes apart by itself.  Of numbers that are no cards, one in
ten passes Luhn, so a failed Luhn counts as a ninth of a wrong addition.  All
other candidates are unlabelled and no negatives, however many they are,
unless they are reliably unlike the kind: positives of the fold aside are
held out as spies, and what scores below nearly all of them under trees that
tell positives from all the rest is a negative, too.

Per kind, boosted trees are fitted on four fifths of all documents, and the
lowest score whose precision on the other fifth is high enough (a lower
confidence bound of ``PRECISION``) selects what is added of the candidates
that pass the kind's check.  Base spans always stay; a candidate that meets
one is not added.  Selected candidates of a kind are settled from the left:
of those that overlap the one that ends first, and so each other, the one
stays whose numbers of digits and groups are most frequent among the kind's
positives, then the best score, the longest, the first; all that overlap it
go, and so on behind it.  What stays never overlaps, however long a chain of
candidates is.

The features are small integers, so the candidates of all documents enter
the fit as counts per feature combination.  The classifier is fitted on a
bounded sample of them: the ``COMBINATIONS`` most frequent ones (ties by the
features' values); the trees, fitted from these counts on the driver, are
applied as CASE expressions.

Everything on the documents is DataFrame functions: no Python on the
executors, no shuffle of texts.  The patterns give the same matches as the
rules' plain patterns, but start a run of characters only once and repeat
possessively, so long runs cost linear time.

Defined results: null and empty texts have no spans; texts are taken whole;
offsets count code points; work and memory grow in proportion to a text and
its candidates, however many lie in one text; null ids belong to the fit; repeated rows count
as often as they occur; without candidates, or with too few base spans of a
kind to bear out the precision, nothing is added; an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read, stage, text_of

KINDS = ("email", "ip", "card", "phone")

# The base rules' patterns, rewritten without backtracking.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
_RUN = r"(?:(?<![0-9])|\G)[0-9]++"
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN + r"\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
QUAD = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

#: Candidate generators.
GENERATORS = {
    "address": _LOCAL + r"(?:@|\x20?[\[(](?:at|@)[\])]\x20?)[A-Za-z0-9-]++"
                        r"(?:(?:\.|\x20?[\[(](?:dot|\.)[\])]\x20?)[A-Za-z0-9-]++)*+",
    "number": r"[0-9]++(?:[\x20.-][0-9]++)*+",
    "loose_number": r"[+(]{0,2}[0-9]++(?:[\x20().-]{1,3}[0-9]++)*+",
}
#: Spellings of @ and of the dot in an address, and a whole address.
AT, DOT = r"\x20?[\[(](?:at|@)[\])]\x20?", r"\x20?[\[(](?:dot|\.)[\])]\x20?"
ADDRESS = r"^[^@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"
#: Words before a candidate that tell kinds apart.
CONTEXT = (r"tel|phone|call|mobile|fax|sms", r"card|visa|credit|pay|account", r"host|server|addr|\bip\b", r"mail|contact|write")
CONTEXT_CHARS = 24
#: Digits, and so digit groups at most, of a window.
WINDOW = 19
#: Features and their numbers of levels.
FEATURES = {"generator": 3, "digits": 21, "groups": 7, "longest": 9, "last": 4, "separators": 16, "quad": 2, "luhn": 2,
            "context": 5, "letters": 4}
#: Feature combinations (with the fold) that the fit sees: rows on the driver.
COMBINATIONS = 50_000
#: The features that a kind's check decides on.
HIDDEN = {"email": (), "ip": ("quad",), "card": ("luhn",), "phone": ("digits",)}
PRECISION = 0.95
#: The share of spies that may score below a candidate that is no negative.
SPIES_BELOW = 0.05
#: Numbers that fail Luhn for one that passes by chance.
LUHN_FAILS = 9
#: Characters of a text's pieces from which contexts are cut.
PIECE = 1024
FOLDS = 5


# --- spans -----------------------------------------------------------------

def prefix_sums(numbers: Column, chunk: int = 256) -> Column:
    """Sum of the elements before each element; appends stay within chunks,
    so long arrays cost linear time."""
    def running(values: Column) -> Column:
        zero = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, zero, lambda acc, v: F.struct(
            (acc["sum"] + v).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out")))["out"]

    starts = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(chunk))
    totals = F.transform(starts, lambda i: F.aggregate(F.slice(numbers, i, chunk), F.lit(0), lambda a, b: a + b))
    return F.flatten(F.zip_with(starts, running(totals), lambda i, base: F.transform(
        running(F.slice(numbers, i, chunk)), lambda s: s + base)))


def scan(values: Column, state: Column, state_type: str, out_type: str, step, chunk: int = 128) -> Column:
    """Fold over an array that also writes: ``step(state, value)`` gives a
    struct of the next ``state`` and an array ``out``.  Returns the last state
    and all that was written; appends stay within chunks, so long arrays cost
    linear time."""
    none = F.array().cast(f"array<{out_type}>")

    def one(acc: Column, v: Column) -> Column:  # a fold over one element binds a value without a copy of the state
        return F.aggregate(F.array(step(acc["state"], v)), acc, lambda a, r: F.struct(r["state"].cast(state_type).alias("state"), F.when(
            F.size(r["out"]) == 0, a["out"]).otherwise(F.concat(a["out"], r["out"].cast(f"array<{out_type}>"))).alias("out")))

    def over(every: Column) -> Column:
        def block(acc: Column, i: Column) -> Column:
            return F.aggregate(F.slice(every, i, chunk), F.struct(acc["state"].alias("state"), none.alias("out")), one,
                               lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

        starts = F.sequence(F.lit(1), F.greatest(F.size(every), F.lit(1)), F.lit(chunk))
        return F.aggregate(starts, F.struct(state.cast(state_type).alias("state"), none.alias("out")), block)

    return let(values, over)


def pieces_of(text: Column) -> Column:
    """A text cut every ``PIECE`` characters: a substring of a long text
    costs a walk from its start, one of its pieces does not."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(pieces: Column, start: Column, length: Column) -> Column:
    """``length`` characters from ``start`` (0-based) of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    n = F.floor((start + F.greatest(length, F.lit(1)) - 1) / PIECE).cast("int") - first + 1
    return F.when(length > 0, F.substring(F.array_join(F.slice(pieces, first + 1, n), ""), start - first * PIECE + 1, length)).otherwise("")


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """Array of (start, end, hit) of a pattern's matches; ``possible`` is a
    cheap test that holds wherever the pattern can match."""
    hits = F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return hits


def located(text: Column, pattern: str, hits: Column) -> Column:
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
    found = F.zip_with(F.zip_with(steps, prefix_sums(steps), lambda n, before: n + before), hits, lambda end, h: F.struct(
        (end - F.length(h)).alias("start"), end.alias("end"), h.alias("hit")))
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.when(F.size(hits) > 0, found).otherwise(empty)


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a digit string (of 12 to 19 digits, else false)."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n + 1 - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.when((n >= 12) & (n <= 19), total % 10 == 0).otherwise(False)


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(QUAD)
    if kind == "card":
        return luhn(digits_of(hit))
    if kind == "phone":
        return F.length(digits_of(hit)).between(9, 15)
    return F.lit(True)


def _possible(text: Column, kind: str) -> Column:
    if kind in ("email", "address"):
        return F.contains(text, F.lit("@")) | (text.rlike(r"[\[(]at[\])]") if kind == "address" else F.lit(False))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]")


def _with_matches(docs: DataFrame, text: str, patterns: dict[str, str], prefix: str) -> DataFrame:
    """Columns ``prefix + name`` with the located matches of each pattern (the
    hits are computed once, then located)."""
    t = F.col(text)
    docs = docs.withColumns({f"{prefix}{k}_hits": matches(t, p, _possible(t, k)) for k, p in patterns.items()})
    return docs.withColumns({f"{prefix}{k}": located(t, p, F.col(f"{prefix}{k}_hits")) for k, p in patterns.items()}).drop(
        *[f"{prefix}{k}_hits" for k in patterns])


SPAN = "array<struct<start:int,kind:int,end:int>>"


def base_spans(columns: dict[str, Column]) -> Column:
    """All base spans, by start and kind; ``columns``: located matches."""
    def of(no: int, kind: str, found: Column) -> Column:
        return F.transform(F.filter(found, lambda m: _passes(kind, m["hit"])), lambda m: _span(m, no))

    return F.array_sort(F.concat(*[of(no, kind, c) for no, (kind, c) in enumerate(columns.items())]))


def _span(m: Column, kind: int) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))


# --- candidates ------------------------------------------------------------

def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_windows(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the column ``name``: (start, end, hit, before, after, ahead: what
    precedes the whole number string) of the
    windows of consecutive digit groups, short of a whole number string, with
    7 to ``WINDOW`` digits.  A string's first group has the marks before it, others an
    opening bracket.  The columns on the way are flat arrays over all digit
    groups of a text; of the text between them only the end is kept."""
    t, c = F.col(text), lambda k: F.col(f"{name}_{k}")
    digits, possible = "[0-9]++", F.col(text).rlike("[0-9]")
    docs = docs.withColumn(f"{name}_hits", matches(t, digits, possible))
    docs = docs.withColumns({
        f"{name}_at": located(t, digits, c("hits")),
        f"{name}_gaps": F.when(possible, F.transform(F.split(t, digits, -1), lambda g: F.struct(
            g.rlike(r"^[\x20().-]{1,3}$").alias("links"), F.substring(g, -CONTEXT_CHARS, CONTEXT_CHARS).alias("tail"),
            F.substring(g, 1, 1).alias("head"))))})
    docs = docs.withColumns({
        f"{name}_sizes": F.transform(c("hits"), lambda h: F.length(h)),
        f"{name}_breaks": F.transform(c("gaps"), lambda g: F.when(g["links"], 0).otherwise(1)),
        f"{name}_pieces": F.flatten(F.zip_with(F.slice(c("gaps"), 1, F.size(c("hits"))), c("hits"), lambda g, h: F.array(g["tail"], h)))})
    docs = docs.withColumns({f"{name}_sums": prefix_sums(c("sizes")), f"{name}_runs": prefix_sums(c("breaks")), f"{name}_ahead": F.filter(c("gaps"), lambda g: ~g["links"]), f"{name}_n": F.size(c("hits"))})

    def run(i: Column) -> Column:  # the number of the group's string
        return F.get(c("runs"), i + 1)

    def starting(i: Column) -> Column:
        def fits(j: Column) -> Column:
            n = F.get(c("sums"), j) + F.get(c("sizes"), j) - F.get(c("sums"), i)
            whole = (F.get(c("breaks"), i) == 1) & ((j == c("n") - 1) | (F.get(c("breaks"), j + 1) == 1))
            return n.between(7, WINDOW) & (run(i) == run(j)) & ~whole

        tail = F.get(c("gaps"), i)["tail"]
        marks = F.when(F.get(c("breaks"), i) == 1, F.regexp_extract(tail, r"[+(]{0,2}$", 0)).otherwise(F.regexp_extract(tail, r"\(?$", 0))
        lead = F.array_join(F.slice(c("pieces"), F.greatest(2 * i + 1 - CONTEXT_CHARS, F.lit(1)), F.least(2 * i + 1, F.lit(CONTEXT_CHARS + 1))), "")
        return F.transform(F.filter(F.sequence(i, F.least(i + WINDOW - 1, c("n") - 1)), fits), lambda j: F.struct(
            (F.get(c("at"), i)["start"] - F.length(marks)).alias("start"), F.get(c("at"), j)["end"].alias("end"),
            F.concat(marks, F.array_join(F.slice(c("pieces"), 2 * i + 2, 2 * (j - i) + 1), "")).alias("hit"),
            lead.substr(F.lit(1), F.length(lead) - F.length(marks)).substr(-CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
            F.get(c("gaps"), j + 1)["head"].alias("after"),
            F.get(c("ahead"), run(i) - 1)["tail"].alias("ahead")))

    found = F.flatten(F.transform(F.sequence(F.lit(0), c("n") - 1), starting))
    none = F.array().cast("array<struct<start:int,end:int,hit:string,before:string,after:string,ahead:string>>")
    return docs.withColumn(name, F.when(c("n") > 1, found).otherwise(none)).drop(
        *[f"{name}_{k}" for k in ("hits", "at", "gaps", "sizes", "breaks", "pieces", "sums", "runs", "ahead", "n")])


def candidates(pieces: Column, columns: dict[str, Column], windows: Column) -> Column:
    """Candidate spans of a text in ``pieces`` with their features;
    ``passes``: bits of the kinds whose check holds."""
    def described(no: int, name: str, start: Column, hit: Column, before: Column, after: Column,
                  ahead: Column | None = None) -> Column:
        # an address in its plain spelling
        plain = F.regexp_replace(F.regexp_replace(hit, AT, "@"), DOT, ".") if name == "address" else hit
        return let(F.struct(
            start.alias("start"), hit.alias("hit"), before.alias("before"), after.alias("after"),
            (before if ahead is None else F.concat_ws(" ", ahead, before)).alias("words"), plain.alias("plain"), digits_of(hit).alias("d"),
            F.filter(F.split(plain, "[^A-Za-z0-9]+"), lambda g: g != "").alias("groups")), lambda m: features(no, name, m))

    def features(no: int, name: str, m: Column) -> Column:
        start, hit, before, after, plain, d, groups = (m[k] for k in ("start", "hit", "before", "after", "plain", "d", "groups"))
        words = F.lower(m["words"])
        context = F.lit(0)
        for i, pattern in reversed(list(enumerate(CONTEXT, 1))):
            context = F.when(words.rlike(pattern), i).otherwise(context)
        letter = r"[A-Za-z0-9]$"
        marks = [F.contains(hit, F.lit(c)).cast("int") * 2 ** i for i, c in enumerate(" .-(")]
        values = {
            "generator": F.lit(no), "digits": F.least(F.length(d), F.lit(20)), "groups": F.least(F.size(groups), F.lit(6)),
            "longest": F.least(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(8)),
            "last": F.lit(0) if name == "address" else F.greatest(F.least(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(5)) - 2, F.lit(0)),
            # for an address the spelling of @ and . stays out
            "separators": F.lit(0) if name == "address" else marks[0] + marks[1] + marks[2] + marks[3],
            "quad": hit.rlike(QUAD).cast("int"), "luhn": luhn(d).cast("int"), "context": context,
            "letters": before.rlike(letter).cast("int") + 2 * after.rlike(letter).cast("int")}
        kinds = ("email",) if name == "address" else KINDS[1:]
        checks = {"email": plain.rlike(ADDRESS), "ip": values["quad"] == 1, "card": values["luhn"] == 1, "phone": F.length(d).between(9, 15)}
        passes = sum((checks[k].cast("int") * 2 ** KINDS.index(k) for k in kinds), F.lit(0))
        return F.struct(start.alias("start"), (start + F.length(hit)).alias("end"), passes.alias("passes"),
                        *[F.coalesce(v, F.lit(0)).cast("int").alias(k) for k, v in values.items()])

    def whole(no: int, name: str, m: Column) -> Column:
        before = part(pieces, F.greatest(m["start"] - CONTEXT_CHARS, F.lit(0)), F.least(m["start"], F.lit(CONTEXT_CHARS)))
        return described(no, name, m["start"], m["hit"], before, part(pieces, m["end"], F.lit(1)))

    def of(no: int, name: str, found: Column) -> Column:
        own = found if name == "address" else F.filter(found, lambda m: F.length(digits_of(m["hit"])).between(7, 20))
        return F.transform(own, lambda m: whole(no, name, m))

    no, name = list(enumerate(columns))[-1]  # windows are cut from the loose numbers
    parts = F.transform(windows, lambda w: described(no, name, w["start"], w["hit"], w["before"], w["after"], w["ahead"]))
    return F.concat(*[of(no, name, c) for no, (name, c) in enumerate(columns.items())], parts)


def beside_base(candidates: Column, base: Column) -> Column:
    """The candidates with ``meets`` (a base span overlaps) and ``agrees``
    (bits of the kinds with a base span that shares 0.8 of the union).

    Base spans of a kind do not overlap each other, so the last one that
    begins before a candidate's end is the one that meets it, if any does,
    and the last one that begins at or before its middle is the one that can
    agree.  One pass over all starts, ends and middles in order finds them."""
    lasts = [f"k{i}" for i in range(len(KINDS))]
    state_type = f"struct<{','.join(f'{k}:int' for k in lasts)}>"

    def event(at: Column, query: int, no: Column, what: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(query).alias("query"), no.alias("no"), what.alias("what"))

    starts = F.transform(base, lambda s, j: event(s["start"], 0, j + 1, s["kind"]))
    asked = F.flatten(F.transform(candidates, lambda c, i: F.array(
        event(F.floor((c["start"] + c["end"]) / 2).cast("int"), 1, i, F.lit(0)), event(c["end"] - 1, 1, i, F.lit(1)))))

    def step(state: Column, e: Column) -> Column:
        moved = F.struct(*[F.when((e["query"] == 0) & (e["what"] == i), e["no"]).otherwise(state[k]).alias(k) for i, k in enumerate(lasts)])
        answer = F.struct(e["no"].alias("no"), e["what"].alias("what"), state.alias("lasts"))
        return F.struct(moved.alias("state"), F.when(e["query"] == 1, F.array(answer)).otherwise(F.array().cast(f"array<{answer_type}>")).alias("out"))

    none = F.struct(*[F.lit(0).alias(k) for k in lasts])
    answer_type = f"struct<no:int,what:int,lasts:{state_type}>"
    answers = F.sort_array(scan(F.sort_array(F.concat(starts, asked)), none, state_type, answer_type, step)["out"])

    def marked(found: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            middle, end = F.get(found, 2 * i)["lasts"], F.get(found, 2 * i + 1)["lasts"]
            meets, agrees = F.lit(False), F.lit(0)
            for n, k in enumerate(lasts):
                meets = meets | ((end[k] > 0) & (F.get(base, end[k] - 1)["end"] > c["start"]))
                same = let(F.get(base, middle[k] - 1), lambda s: 10 * _overlap(c, s) >= 8 * (
                    F.greatest(c["end"], s["end"]) - F.least(c["start"], s["start"])))
                agrees = agrees + F.when((middle[k] > 0) & same, 1 << n).otherwise(0)
            return c.withField("meets", meets).withField("agrees", agrees)

        return F.transform(candidates, one)

    lone = F.transform(candidates, lambda c: c.withField("meets", F.lit(False)).withField("agrees", F.lit(0)))
    return F.when((F.size(base) == 0) | (F.size(candidates) == 0), lone).otherwise(let(answers, marked))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``pii_base`` (base spans) and ``pii_candidates``."""
    # a single copy of the text with null as empty
    out = docs.withColumn("pii_text", text_of(text_col))
    out = with_windows(_with_matches(out, "pii_text", {**BASE, **GENERATORS}, "pii_"), "pii_text", "pii_windows")
    some = F.size("pii_windows") + sum((F.size(f"pii_{k}") for k in GENERATORS), F.lit(0)) > 0
    found = (out.withColumn("pii_base", base_spans({k: F.col(f"pii_{k}") for k in BASE}))
             .withColumn("pii_pieces", F.when(some, pieces_of(F.col("pii_text"))).otherwise(F.array().cast("array<string>")))
             .withColumn("pii_spans", candidates(F.col("pii_pieces"), {k: F.col(f"pii_{k}") for k in GENERATORS}, F.col("pii_windows")))
             .withColumn("pii_candidates", beside_base(F.col("pii_spans"), F.col("pii_base"))))
    return found.drop("pii_text", "pii_windows", "pii_pieces", "pii_spans", *[f"pii_{k}" for k in (*BASE, *GENERATORS)])


def _overlap(c: Column, s: Column) -> Column:
    return F.least(c["end"], s["end"]) - F.greatest(c["start"], s["start"])


# --- boosted trees ---------------------------------------------------------

@dataclass
class Tree:
    value: float = 0.0
    feature: str = ""
    at: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def score(self, x: dict[str, int]) -> float:
        return self.value if self.low is None else (self.low if x[self.feature] <= self.at else self.high).score(x)

    def expression(self, row: Column | dict[str, Column]) -> Column:
        if self.low is None:
            return F.lit(float(self.value))
        return F.when(row[self.feature] <= self.at, self.low.expression(row)).otherwise(self.high.expression(row))


def grow(rows: list[tuple[dict[str, int], float, float]], depth: int, rate: float, least: float = 1.0) -> Tree:
    """Regression tree on (features, gradient, curvature)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = Tree(value=rate * max(-4.0, min(4.0, g / (h + 1.0))))
    if depth == 0:
        return leaf
    best, choice = g * g / (h + 1.0) + 1e-6, None
    for name in FEATURES:
        sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
        for x, rg, rh in rows:
            s = sums[x[name]]
            s[0] += rg
            s[1] += rh
        lg = lh = 0.0
        for v in sorted(sums)[:-1]:
            lg, lh = lg + sums[v][0], lh + sums[v][1]
            gain = lg * lg / (lh + 1.0) + (g - lg) ** 2 / (h - lh + 1.0)
            if gain > best:
                best, choice = gain, (name, v)
    if choice is None:
        return leaf
    name, at = choice
    return Tree(feature=name, at=at, low=grow([r for r in rows if r[0][name] <= at], depth - 1, rate),
                high=grow([r for r in rows if r[0][name] > at], depth - 1, rate))


@dataclass
class Booster:
    """Trees for one kind; ``threshold``: lowest score that is selected;
    ``typical``: positives by (digits, groups)."""

    prior: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    threshold: float = math.inf
    typical: dict[tuple[int, int], int] = field(default_factory=dict)

    def score(self, x: dict[str, int]) -> float:
        return self.prior + sum(t.score(x) for t in self.trees)

    def total(self, row: Column | dict[str, Column]) -> Column:
        total = F.lit(float(self.prior))
        for t in self.trees:
            total = total + t.expression(row)
        return total


def boost(rows: list[tuple[dict[str, int], float, float]], n_trees: int = 20, depth: int = 3, rate: float = 0.4) -> Booster:
    """Logistic boosting on (features, positives, negatives) counts."""
    pos, neg = sum(r[1] for r in rows), sum(r[2] for r in rows)
    model = Booster()
    if not pos or not neg:
        return model
    model.prior = math.log((pos + 1) / (neg + 1))
    margin = [model.prior] * len(rows)
    for _ in range(n_trees):
        work = []
        for (x, p, n), m in zip(rows, margin):
            share = 1 / (1 + math.exp(-max(-30.0, min(30.0, m))))
            work.append((x, p - (p + n) * share, (p + n) * share * (1 - share)))
        tree = grow(work, depth, rate)
        model.trees.append(tree)
        margin = [m + tree.score(x) for (x, _, _), m in zip(rows, margin)]
    return model


def calibrate(model: Booster, rows: list[tuple[dict[str, int], float, float]], precision: float = PRECISION) -> None:
    """Set the threshold: the lowest score down to which everything selected
    has the precision, by the lower end of a 95 % Wilson interval."""
    scored = defaultdict(lambda: [0.0, 0.0])
    for x, p, n in rows:
        s = scored[round(model.score(x), 9)]
        s[0] += p
        s[1] += n
    p = n = 0.0
    for score in sorted(scored, reverse=True):
        p, n = p + scored[score][0], n + scored[score][1]
        total, z = p + n, 1.96
        if total:
            share = p / total
            low = (share + z * z / (2 * total) - z * math.sqrt(share * (1 - share) / total + z * z / (4 * total * total))) / (1 + z * z / total)
            if low >= precision:
                model.threshold = score


def passes(c: Column, kind: int) -> Column:
    return c["passes"].bitwiseAND(F.lit(1 << kind)) != 0


def spies_floor(model: Booster, rows: list[tuple[dict[str, int], float, float]]) -> float:
    """The score below which at most ``SPIES_BELOW`` of the positives lie."""
    scored = sorted((model.score(x), p) for x, p, _ in rows if p)
    below, most = 0.0, SPIES_BELOW * sum(p for _, p in scored)
    for score, p in scored:
        below += p
        if below > most:
            return score - 1e-9
    return -math.inf


def fit(rows: list[tuple[bool, dict[str, int], float, float, float]]) -> Booster:
    """Trees and threshold of a kind from (aside, features, positives, true
    negatives, unlabelled) counts."""
    apart = boost([(x, p, n + u) for aside, x, p, n, u in rows if not aside])
    floor = spies_floor(apart, [(x, p, n) for aside, x, p, n, _ in rows if aside])
    unlike = [apart.score(x) < floor for _, x, *_ in rows]
    known = [(aside, (x, p, n + (u if far else 0.0))) for (aside, x, p, n, u), far in zip(rows, unlike)]
    model = boost([r for aside, r in known if not aside])
    calibrate(model, [r for aside, r in known if aside])
    return model


def train(found: DataFrame) -> dict[str, Booster]:
    """Fit from the stored result of ``find`` (with ``doc_id``): counts per
    feature combination, kind and fold over all documents."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    each = found.select(fold.alias("aside"), F.explode("pii_candidates").alias("c"))
    c = F.col("c")
    each = each.select("aside", "c", c["meets"].alias("meets"),
                       *[(c["agrees"].bitwiseAND(F.lit(1 << i)) != 0).alias(f"agrees_{k}") for i, k in enumerate(KINDS)])
    # a Luhn check that fails where nothing else does
    by_luhn = ~F.col("meets") & c["digits"].between(12, 19) & (c["luhn"] == 0)
    labels = {}
    for i, k in enumerate(KINDS):
        wrong = ~F.col(f"agrees_{k}") & (F.col("meets") | ~passes(c, i))
        labels |= {f"is_{k}": F.col(f"agrees_{k}"), f"not_{k}": wrong & ~by_luhn if k == "card" else wrong}
    labels["luhn_fails"] = by_luhn & ~F.col("agrees_card")
    counts = each.select("aside", *[c[k].alias(k) for k in FEATURES], *[v.cast("long").alias(k) for k, v in labels.items()]).groupBy(
        "aside", *FEATURES).agg(F.count(F.lit(1)).alias("n"), *[F.sum(k).alias(k) for k in labels])
    frequent = counts.orderBy(F.col("n").desc(), "aside", *FEATURES).limit(COMBINATIONS)
    table = [r.asDict() for r in frequent.collect()]
    table.sort(key=lambda r: [r[k] for k in ("aside", *FEATURES)])
    models = {}
    for kind in KINDS:
        rows = []
        for r in table:
            if (r["generator"] == 0) != (kind == "email"):
                continue
            fails = r["luhn_fails"] if kind == "card" else 0
            rows.append((bool(r["aside"]), {k: 0 if k in HIDDEN[kind] else r[k] for k in FEATURES}, float(r[f"is_{kind}"]),
                         r[f"not_{kind}"] + fails / LUHN_FAILS, float(r["n"] - r[f"is_{kind}"] - r[f"not_{kind}"] - fails)))
        models[kind] = fit(rows)
        for r in table:
            if r[f"is_{kind}"]:
                shape = (r["digits"], r["groups"])
                models[kind].typical[shape] = models[kind].typical.get(shape, 0) + r[f"is_{kind}"]
    return models


def best_apart(chosen: Column) -> Column:
    """Of (typical, score, start, end), what stays when overlapping ones
    compete, from the left: the best of those that overlap the one that ends
    first."""
    span = "struct<start:int,end:int,typical:bigint,score:double>"

    def worth(c: Column) -> Column:
        return F.struct(c["typical"], c["score"], (c["end"] - c["start"]).alias("length"))

    def step(state: Column, x: Column) -> Column:
        best, edge, last = state["best"], state["edge"], state["last"]
        nothing = F.array().cast(f"array<{span}>")

        def to(best: Column, edge: Column, last: Column, out: Column) -> Column:
            return F.struct(F.struct(best.cast(span).alias("best"), edge.cast("int").alias("edge"), last.cast("int").alias("last")).alias("state"), out.alias("out"))

        rival = to(F.when(worth(x) > worth(best), x).otherwise(best), F.least(edge, x["end"]), last, nothing)
        behind = x["start"] < best["end"]
        won = to(F.when(~behind, x), F.when(behind, 0).otherwise(x["end"]), best["end"], F.array(best))
        return (F.when(x["start"] < last, to(best, edge, last, nothing)).when(best.isNull(), to(x, x["end"], last, nothing))
                .when(x["start"] < edge, rival).otherwise(won))

    placed = F.sort_array(F.transform(chosen, lambda c: F.struct(c["start"], c["end"], c["typical"], c["score"])))
    begin = F.struct(F.lit(None).cast(span).alias("best"), F.lit(0).alias("edge"), F.lit(0).alias("last"))
    settled = lambda every: let(scan(every, begin, f"struct<best:{span},edge:int,last:int>", span, step), lambda r: F.concat(
        r["out"], F.when(r["state"]["best"].isNotNull(), F.array(r["state"]["best"])).otherwise(F.array().cast(f"array<{span}>"))))
    return let(placed, lambda every: F.when(F.size(every) > 1, settled(every)).otherwise(every))


def all_spans(models: dict[str, Booster]) -> Column:
    """Base spans and selected candidates that meet none of them, by start,
    kind and end."""
    def added(no: int, model: Booster) -> Column:
        if model.threshold == math.inf:
            return F.array().cast(SPAN)
        hidden = {k: F.lit(0) for k in HIDDEN[KINDS[no]]}
        pairs = [F.lit(v) for (d, g), n in sorted(model.typical.items()) for v in (d * 10 + g, n)]
        typical = F.create_map(*pairs).cast("map<int,bigint>")
        able = F.filter("pii_candidates", lambda c: ((c["generator"] == 0) == (KINDS[no] == "email")) & passes(c, no) & ~c["meets"])
        scored = F.transform(able, lambda c: F.struct(c["start"], c["end"], model.total(
            {k: hidden.get(k, c[k]) for k in FEATURES}).alias("score"), F.coalesce(F.try_element_at(
                typical, c["digits"] * 10 + c["groups"]), F.lit(0)).alias("typical")))
        chosen = F.filter(scored, lambda c: c["score"] >= F.lit(model.threshold - 1e-9))
        return F.transform(best_apart(chosen), lambda c: _span(c, no))

    return F.array_sort(F.array_distinct(F.concat("pii_base", *[added(i, models[k]) for i, k in enumerate(KINDS)])))


def as_text(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged_spans(spans: Column) -> Column:
    """Spans (by start) that overlap as one, of the first one's kind."""
    span = "struct<start:int,kind:int,end:int>"

    def step(held: Column, s: Column) -> Column:
        grown = F.struct(held["start"].alias("start"), held["kind"].alias("kind"), F.greatest(held["end"], s["end"]).alias("end"))
        joins = s["start"] < held["end"]
        return F.struct(F.when(joins, grown).otherwise(s).alias("state"), F.when(joins | held.isNull(), F.array().cast(SPAN)).otherwise(F.array(held)).alias("out"))

    joined = lambda every: let(scan(every, F.lit(None).cast(span), span, span, step), lambda r: F.concat(
        r["out"], F.when(r["state"].isNotNull(), F.array(r["state"])).otherwise(F.array().cast(SPAN))))
    return let(spans, lambda every: F.when(F.size(every) > 1, joined(every)).otherwise(every))


def redacted(text: str, merged: str) -> Column:
    """The text column with every span of a column of ``merged_spans``
    replaced by its kind in brackets."""
    t, spans = F.col(text), F.col(merged)
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(pieces: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            before = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
            return F.concat(part(pieces, before, s["start"] - before), F.element_at(kinds, s["kind"] + 1))

        last = F.element_at(spans, -1)["end"]
        return F.concat(F.array_join(F.transform(spans, one), ""), part(pieces, last, F.length(t) - last))

    return F.when(F.size(spans) > 0, let(pieces_of(t), cut)).otherwise(t)


def redact_documents(docs: DataFrame) -> DataFrame:
    """Documents with their personal data replaced; ``n_chars`` follows."""
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("pii_row"), "doc_id", F.col("text").alias("pii_own"))
    found = stage(find(rows, "pii_own"), "pii-found")
    models = train(found.select("doc_id", "pii_base", "pii_candidates"))
    out = (found.withColumn("pii_spans", merged_spans(all_spans(models)))
           .withColumn("pii_clean", redacted("pii_own", "pii_spans")))
    new = {"text": F.col("pii_clean")}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.size("pii_spans") > 0, F.length("pii_clean").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("pii_row.n_chars"))
    return out.select(*[new.get(c, F.col(f"pii_row.`{c}`")).alias(c) for c in names])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = stage(find(docs).drop("text"), "pii-found")
    models = train(found)
    number = lambda i: F.size(F.filter("pii_base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(as_text(F.col("pii_base")).cast("binary"), 256).alias("base_sha256"),
                        as_text(all_spans(models)).alias("spans"))
