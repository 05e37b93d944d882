import zlib

import numpy as np
from conftest import multiset

from lakefold.llm import quality
from lakefold.llm.queries import QUERIES

op8 = QUERIES["op8_quality"]
SF = "/root/testdata/sf0.01"


def aside(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def test_held_out_accuracy_and_columns(spark):
    got = {r.doc_id: r for r in op8(spark, SF).collect()}
    assert all(r.held_out == aside(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    labels = [(r.quality, got[r.doc_id]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(y, r) for y, r in labels if r.held_out]
    pos, neg = [r.score for y, r in held if y == 1], [r.score for y, r in held if y == 0]
    assert np.mean([a > b for a in pos for b in neg]) > 0.97
    assert np.mean([r.predicted == y for y, r in held]) > 0.9


def test_held_out_labels_and_other_columns_are_no_inputs(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.train(docs, labels)
    b = quality.train(docs.withColumns({"lang": F.lit("zz"), "source": F.lit("zz")}).repartition(5), flipped)
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_edges(spark, edge_sf, edge_rows):
    got = op8(spark, edge_sf).collect()
    assert multiset((r.doc_id, r.held_out) for r in got) == multiset((r[0], aside(r[0])) for r in edge_rows)
    assert all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (0, 3)}  # null and empty text: the bias alone
    assert len(blank) == 1


def test_empty_and_one_class(spark, empty_sf):
    assert op8(spark, empty_sf).collect() == []
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert none.score("anything") == 0.5
    ones = quality.train(docs, spark.createDataFrame([(2, 1), (3, 1), (1, 1)], "doc_id long, quality int"))
    assert ones.score("x") == ones.score("") > 0.5


def test_accepted_keeps_rows_and_columns(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{edge_sf}/labels.parquet"))
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    want = [r for r in docs.collect() if model.score(r.text) >= 0.3]
    assert multiset(kept.collect()) == multiset(want)


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against plain subgradient descent on the primal objective."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    y = (x @ [1, -2, 0.5, 0, 1] + 0.3 * rng.normal(size=60) > 0).astype(int)
    xs = [np.arange(5) for _ in x]
    w, b = quality.dual_coordinate_descent(xs, list(x), y, penalty=0.5, passes=400)

    def cost(w, b):
        return 0.5 * (w @ w + b * b) + 0.5 * np.maximum(0, 1 - np.where(y, 1, -1) * (x @ w + b)).sum()

    v = np.zeros(6)
    z = np.c_[x, np.ones(60)] * np.where(y, 1, -1)[:, None]
    best = np.inf
    for t in range(1, 20000):
        grad = v - 0.5 * z[(z @ v) < 1].sum(axis=0)
        v = v - grad / (t + 10)
        best = min(best, cost(v[:5], v[5]))
    assert cost(w[:5], b) <= best * 1.001


def test_long_text_features_are_whole():
    text = "ab" * 200_000 + "Z9!"
    short = quality.features("ab" * 20 + "Z9!")
    assert (np.sort(quality.features(text)) == short).all()


def slow_buckets(text):
    """Buckets of a text's n-grams, one at a time, in Python's numbers."""
    mask = (1 << 64) - 1
    data = (text or "").encode()

    def shape(b):
        if 97 <= b <= 122 or b >= 128:
            return 97
        return 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b == 32 or 9 <= b <= 13 else b

    shapes = [shape(b) for b in data]
    shapes = [x for i, x in enumerate(shapes) if i == 0 or x != shapes[i - 1]]
    words = data.split()
    found = set()
    for kind, longest, items in ((1, 3, data), (2, 6, shapes), (3, 3, [int(a == b) for a, b in zip(words, words[1:])])):
        for n in range(1, longest + 1):
            for i in range(len(items) - n + 1):
                h = 100 * kind + n
                for x in items[i:i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + x + 1) & mask
                h ^= h >> 32
                h = h * 0xD6E8FEB86659FD93 & mask
                found.add((h >> 40) % quality.BUCKETS)
    return found


def test_scores_and_ratios_equal_brute_force(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{edge_sf}/labels.parquet")
    model = quality.train(docs, labels)

    def slow(text):
        own = slow_buckets(text)
        margin = sum(float(model.weights[b]) for b in own) / max(1, len(own)) ** .5 + model.bias
        return 1 / (1 + 2.718281828459045 ** -(model.slope * margin + model.offset))

    short = [r for r in docs.collect() if len(r.text or "") < 3000]
    got = {}
    for r in op8(spark, edge_sf).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    for r in short:
        assert min(abs(slow(r.text) - s) for s in got[r.doc_id]) < 1e-9
    texts, ys = [r.text for r in short], np.array([i % 2 for i in range(len(short))])
    share = []
    for label in (1, 0):
        count = [1] * quality.BUCKETS
        for t, y in zip(texts, ys):
            if y == label:
                for b in slow_buckets(t):
                    count[b] += 1
        share.append(np.array(count) / sum(count))
    assert np.allclose(quality.log_count_ratios([quality.features(t) for t in texts], ys), np.log(share[0] / share[1]))


def test_hot_labelled_id_and_any_partitioning(spark):
    """A labelled id of half the rows with many texts counts once, and rows
    dealt out otherwise give the same model."""
    rows = [(i, f"good words number {i} and more" if i % 2 else f"bad ### {i} *** $$$") for i in range(400)]
    rows += [(7, f"other text of the hot id {j}") for j in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    models = [quality.train(docs.repartition(n), labels.repartition(n), sample=200) for n in (1, 3, 7)]
    for m in models[1:]:
        assert (m.weights == models[0].weights).all() and (m.bias, m.slope, m.offset) == (models[0].bias, models[0].slope, models[0].offset)
    assert quality._examples(docs, labels, "quality", 200).count() == 200


def test_sample_is_bounded_by_features_too(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (1 + i % 50)) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    seen = []
    real = quality.fit
    try:
        quality.fit = lambda xs, ys, seed=0: seen.append(xs) or real(xs, ys, seed)
        quality.train(docs, labels, sample_features=1500)
    finally:
        quality.fit = real
    assert 0 < sum(map(len, seen[0])) <= 1500
