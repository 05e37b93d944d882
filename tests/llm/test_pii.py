import hashlib
import random
import re

from conftest import multiset
from pyspark.sql import functions as F

from lakefold.llm import pii
from lakefold.llm.queries import QUERIES

op9 = QUERIES["op9_pii"]
# the rules as they are given
RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            hit = m.group(0)
            digits = re.sub("[^0-9]", "", hit)
            if (kind == "ip" and any(int(p) > 255 for p in hit.split(".")) or kind == "phone" and not 9 <= len(digits) <= 15
                    or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))):
                continue
            out.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(out)


def line(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(got, source):
    want = []
    for d, t in source:
        spans = base(t)
        want.append((d, *[sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(line(spans).encode()).hexdigest()))
    assert multiset((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == multiset(want)


def test_whole_table(spark, small_sf):
    source = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()]
    got = op9(spark, small_sf).collect()
    check(got, source)
    texts = dict(source)
    for r in got:
        assert set(filter(None, line(base(texts[r.doc_id])).split(","))) <= set(r.spans.split(","))  # base spans stay


def test_edges(spark, edge_sf, edge_rows):
    check(op9(spark, edge_sf).collect(), [r[:2] for r in edge_rows])


def test_empty(spark, empty_sf):
    assert op9(spark, empty_sf).collect() == []


def test_base_spans_of_odd_strings(spark):
    rng = random.Random(2)
    parts = ["a", "b.", "@", "1", "12", "255", "256", ".", " ", "-", "+", "(", ")", "4111 1111 1111 1111", "é", "😀", "x@y.z",
             "_", "00", "1.2.3.4", "%", "\n", "+1 (663) 555-6869", "0001.2.3.255"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))) for i in range(800)]
    rows += [(900, "1" * 30_000), (901, "a" * 30_000), (902, "1 " * 10_000), (903, "a." * 10_000 + "@"), (904, "1." * 10_000),
             (905, "x@y.z " * 3000), (906, "4111111111111111 " * 2000), (907, "+1" * 5000)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "text", "pii_base")
    for r in found.collect():
        assert [tuple(s) for s in r.pii_base] == base(r.text), r.text[:200]


def test_no_python_in_the_plan(spark, small_sf):
    plan = op9(spark, small_sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_prefix_sums(spark):
    rows = [(list(range(n)),) for n in (0, 1, 2, 255, 256, 257, 1000)]
    out = spark.createDataFrame(rows, "x array<int>").select("x", pii.prefix_sums(F.col("x")).alias("p")).collect()
    for r in out:
        assert r.p[:len(r.x)] == [sum(r.x[:i]) for i in range(len(r.x))]


def labelled_documents():
    """Phones mostly with the plus sign, some without: format and context
    are the same, so the method is to add the latter."""
    rng = random.Random(4)
    out = []
    for i in range(1500):
        number = f"{rng.randint(1, 9)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        if i % 150 == 7:
            out.append((i, f"please call {number} today"))
        elif i % 3:
            out.append((i, f"please call +{number} today"))
        else:
            out.append((i, f"order {rng.randint(10**7, 10**9)} shipped, {rng.randint(10, 99)} boxes"))
    return out


def test_candidates_like_base_spans_are_added(spark):
    docs = labelled_documents()
    found = pii.stage(pii.find(spark.createDataFrame(docs, "doc_id long, text string")), "t9")
    models = pii.train(found)
    rows = found.select("doc_id", "text", "pii_base", pii.all_spans(models).alias("s")).collect()
    added = {r.doc_id: [r.text[x.start:x.end] for x in r.s if x not in r.pii_base] for r in rows}
    bare = [i for i, t in docs if "call " in t and "+" not in t]
    assert sum(bool(added[i]) for i in bare) >= 0.9 * len(bare)
    assert not any(added[i] for i, t in docs if "order" in t)  # clean documents stay clean
    assert all(set(r.pii_base) <= set(r.s) for r in rows)


def test_boosting_separates_and_calibrates():
    rows = []
    for d in range(21):
        for q in (0, 1):
            x = {k: 0 for k in pii.FEATURES} | {"digits": d, "quad": q}
            p = 0.97 if q and d >= 8 else 0.02
            rows.append((x, 100 * p, 100 * (1 - p)))
    model = pii.boost(rows)
    pii.calibrate(model, rows)
    chosen = [(x["digits"], x["quad"]) for x, _, _ in rows if model.score(x) >= model.threshold]
    assert chosen and all(q and d >= 8 for d, q in chosen)
    pii.calibrate(model, [(x, 0.0, n) for x, _, n in rows])
    assert pii.boost([(rows[0][0], 5.0, 0.0)]).trees == []


def test_redaction(spark):
    text = "é😀 Mail joe@x.org or +1 (663) 555-6869, ip 10.0.0.1 é a@b.cd"
    df = pii.find(spark.createDataFrame([(text,), ("clean",), ("",)], "text string"))
    df = df.withColumn("m", pii.merged_spans(F.col("pii_base"))).withColumn("out", pii.redacted("text", "m"))
    assert [r.out for r in df.collect()] == ["é😀 Mail [EMAIL] or [PHONE], ip [IP] é [EMAIL]", "clean", ""]
    over = spark.createDataFrame([("0123456789", [(1, 2, 5), (3, 0, 7), (7, 1, 8)])], "text string, s " + pii.SPAN)
    over = over.withColumn("m", pii.merged_spans(F.col("s"))).withColumn("out", pii.redacted("text", "m"))
    assert over.first().out == "0[CARD][IP]89"


def test_redact_documents_keeps_columns(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet")
    out = pii.redact_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.filter("text is not null").collect():
        assert base(r.text) == []
    before = {r.doc_id: r for r in docs.filter("doc_id <> 24").collect()}
    for r in out.filter("doc_id <> 24").collect():
        if not base(before[r.doc_id].text):
            assert r == before[r.doc_id]


def added_spans(spark, docs):
    found = pii.stage(pii.find(spark.createDataFrame(docs, "doc_id long, text string")), "t9")
    rows = found.withColumn("s", pii.all_spans(pii.train(found))).select("doc_id", "text", "pii_base", "s").collect()
    return {r.doc_id: [(pii.KINDS[x.kind], r.text[x.start:x.end]) for x in r.s if x not in r.pii_base] for r in rows}


def test_frequent_forms_that_the_rules_miss_are_added(spark):
    """One source, a third of all rows, never writes what the rules insist on."""
    rng = random.Random(5)
    docs, want = [], {}
    for i in range(1800):
        number = f"{rng.randint(1, 9)} ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        name, host = rng.choice(["joe", "anna", "li.wei"]), rng.choice(["mail", "host", "web-site"])
        if i % 6 == 0:
            docs.append((i, f"please call {number} today"))
            want[i] = [("phone", number)]
        elif i % 6 == 1:
            address = f"{name} [at] {host} [dot] org"
            docs.append((i, f"please mail {address} today"))
            want[i] = [("email", address)]
        elif i % 6 < 4:
            docs.append((i, f"please call +{number} or mail {name}@{host}.org today"))
        else:
            docs.append((i, f"order {rng.randint(10**7, 10**9)} shipped on 2024-01-{rng.randint(10, 28)} by {name}@{host}, {rng.randint(10, 99)} boxes"))
    got = added_spans(spark, docs)
    assert {i: got[i] for i in want} == want
    assert not any(got[i] for i, _ in docs if i not in want)


def test_numbers_beside_others_are_added(spark):
    rng = random.Random(6)
    four = lambda: f"{rng.randint(1000, 9999)}"

    def card():
        while not luhn("".join(c := [four() for _ in range(4)])):
            pass
        return " ".join(c)

    phone = lambda: f"{rng.randint(200, 999)} {rng.randint(200, 999)} {four()}"
    docs, want = [], {}
    for i in range(1200):
        docs.append((i, f"paid {card()}, then called +1 {phone()} about it"))
    while len(want) < 40:
        i, c, p, q = 2000 + len(docs), card(), phone(), phone()
        text, found = [(f"paid {c} 12/27 now", [("card", c)]), (f"paid {c} 123 now", [("card", c)]),
                       (f"then called +1 {p} 4111 1111 about it", [("phone", f"+1 {p}")]),
                       (f"then called {p} {q} {p} about it", [("phone", p), ("phone", q), ("phone", p)])][len(want) % 4]
        groups = [m.span() for m in re.finditer("[0-9]+", text.replace("/", "x"))]
        cuts = [re.sub(" ", "", text[a:b]) for a, _ in groups for _, b in groups]
        if base(text) or any(12 <= len(x) <= 19 and x.isdigit() and luhn(x) and x != c.replace(" ", "") for x in cuts):
            continue  # a rule's span, or a chance card beside the planted number
        docs.append((i, text))
        want[i] = found
    got = added_spans(spark, docs)
    assert {i: got[i] for i in want} == want


def test_windows_are_bounded(spark):
    rows = [("1 " * 5000,), ("4111111111111111 " * 2000,), ("12-34.56 (78) 90",), ("1" * 40,), ("+1 (2) 3",)]
    out = pii.with_windows(spark.createDataFrame(rows, "t string"), "t", "w").collect()
    for r in out:
        groups = [m.span() for m in re.finditer("[0-9]+", r.t)]
        want = []
        for i, (a, _) in enumerate(groups):
            for j in range(i, min(i + 19, len(groups))):
                n = sum(y - x for x, y in groups[i:j + 1])
                if 7 <= n <= 19 and (i, j) != (0, len(groups) - 1):
                    start = 0 if i == 0 else a - (r.t[a - 1] == "(")
                    want.append((start, groups[j][1]))
        assert [(w.start, w.end) for w in r.w] == want
        assert all(w.hit == r.t[w.start:w.end] for w in r.w)
        assert all(w.before == r.t[max(0, w.start - 24):w.start] and w.after == r.t[w.end:w.end + 1] for w in r.w)


def slow_apart(spans):
    """Settled from the left: the best of those that overlap the one that
    ends first."""
    left, kept = sorted(spans), []
    while left:
        edge = min(e for _, e, *_ in left)
        best = max((s for s in left if s[0] < edge), key=lambda s: (s[2], s[3], s[1] - s[0], -s[0]))
        kept.append(best[:2])
        left = [s for s in left if s[0] >= best[1]]
    return kept


def test_survivors_never_overlap_across_any_boundary(spark):
    rng = random.Random(8)
    cases = [[(i * 3, i * 3 + 13, 1, 0.5) for i in range(600)], [], [(5, 9, 0, 0.0)]]
    for n in (2, 7, 130, 700):
        for _ in range(6):
            starts = [rng.randint(0, 4 * n) for _ in range(n)]
            cases.append([(s, s + rng.randint(1, 40), rng.randint(0, 3), rng.randint(0, 4) / 4) for s in starts])
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)],
                               "i int, c array<struct<start:int,end:int,typical:bigint,score:double>>")
    got = {r.i: [(s.start, s.end) for s in r.k] for r in df.select("i", pii.best_apart(F.col("c")).alias("k")).collect()}
    for i, c in enumerate(cases):
        assert got[i] == slow_apart(list(dict.fromkeys(c)))
        assert all(a[1] <= b[0] for a, b in zip(got[i], got[i][1:]))


def test_candidates_beside_base_spans_equal_brute_force(spark):
    rng = random.Random(9)
    cases = []
    for n in (0, 1, 5, 200, 400):
        base = []
        for kind in range(4):
            at = 0
            for _ in range(rng.randint(0, n)):
                at += rng.randint(0, 20)
                end = at + rng.randint(1, 25)
                base.append((at, kind, end))
                at = end
        cases.append((sorted(base), [(s, s + rng.randint(1, 30)) for s in (rng.randint(0, 12 * n + 5) for _ in range(n))]))
    df = spark.createDataFrame([(i, b, c) for i, (b, c) in enumerate(cases)],
                               "i int, b array<struct<start:int,kind:int,end:int>>, c array<struct<start:int,end:int>>")
    for r in df.select("i", pii.beside_base(F.col("c"), F.col("b")).alias("m")).collect():
        base, cands = cases[r.i]
        for m, (s, e) in zip(r.m, cands, strict=True):
            over = lambda b: min(e, b[2]) - max(s, b[0])
            agrees = sum({1 << b[1] for b in base if 10 * over(b) >= 8 * (max(e, b[2]) - min(s, b[0]))})
            assert (m.start, m.end, m.meets, m.agrees) == (s, e, any(over(b) > 0 for b in base), agrees)


def test_text_of_very_many_spans(spark):
    line = "Mail joe@x.org or 10.0.0.1, call 663 555 6869 4111 1111.\n"
    n = 2000
    docs = spark.createDataFrame([(1, line * n), (2, "x " + line)], "doc_id long, text string")
    found = pii.stage(pii.find(docs).drop("text"), "t9")
    models = pii.train(found)
    rows = {r.doc_id: r for r in found.select("doc_id", F.size("pii_base").alias("n"), F.size(pii.merged_spans(pii.all_spans(models))).alias("m")).collect()}
    assert rows[1].n == 2 * n and rows[2].n == 2 and rows[1].m >= 2 * n
    out = {r.doc_id: r.text for r in pii.redact_documents(docs).collect()}
    assert out[1].count("[EMAIL]") == n and out[1].count("[IP]") == n and "joe@" not in out[1]
