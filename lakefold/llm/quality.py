"""Quality classifier: naive Bayes support vectors.

A document is the set of its n-grams (indicators, not counts): bytes 1 to 3,
*shapes* 1 to 6 (letters, capitals, digits, white space and other signs, runs
collapsed) and word repetitions 1 to 3, hashed into ``BUCKETS``.  Indicators
are scaled by the log ratio of their smoothed shares in the two classes and
divided by the root of their number; a linear hinge-loss model is fitted by
dual coordinate descent, and its margin is turned into a probability by a
logistic curve fitted on labelled documents left out of the fit.

Fit: on at most ``SAMPLE`` labelled ids (those with the smallest hashes, one
text each) with at most ``SAMPLE_FEATURES`` features together, which are the
documented bounds; neither the language, the source nor the id is an input,
and the same rows give the same model however they are dealt out.  The
sampled ids are broadcast (their number is the bound), so only sampled texts
are shuffled; the features are fitted on the driver.  Scoring is row-local over every whole text with one weight
vector of ``BUCKETS`` floats.

Defined results: null and empty texts have no n-grams and get the score of
the bias alone; long texts are scored whole; of several labels of one id the
smallest holds, of several texts of one id the one with the smallest digest
is learnt from, null labels count as none; without labels of both classes
every score is the smoothed share of label 1; null ids are held out; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .bpe import text_slices
from .common import read, released, stage

BUCKETS = 1 << 18
SAMPLE = 8000
#: Features of the sample together, four bytes each.
SAMPLE_FEATURES = 1 << 24
FOLDS = 5
THRESHOLD = 0.3
#: Upper bound of a dual variable, and passes over the sample.
PENALTY, PASSES = 1.0, 10

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1] = _SHAPE[128:] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")
_SHAPE[9:14] = ord(" ")


def _grams(x: np.ndarray, longest: int, kind: int) -> list[np.ndarray]:
    x = x.astype(np.uint64) + np.uint64(1)
    out = []
    for n in range(1, min(longest, len(x)) + 1):
        h = np.full(len(x) - n + 1, 100 * kind + n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + x[i:len(x) - n + 1 + i]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out.append((h >> np.uint64(40)).astype(np.int32) % BUCKETS)
    return out


def features(text: str | None) -> np.ndarray:
    """Distinct buckets of a text's n-grams."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    shape = _SHAPE[raw]
    shape = shape[np.r_[True, shape[1:] != shape[:-1]]] if len(shape) else shape
    words = data.split()
    again = np.fromiter((a == b for a, b in zip(words, words[1:])), np.uint8, max(0, len(words) - 1))
    found = np.zeros(BUCKETS, bool) if len(raw) > BUCKETS else None
    parts = _grams(raw, 3, 1) + _grams(shape, 6, 2) + _grams(again, 3, 3)
    if found is not None:  # a very long text: mark instead of sorting
        for p in parts:
            found[p] = True
        return np.flatnonzero(found).astype(np.int32)
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int32)


@dataclass
class Model:
    weights: np.ndarray  # per bucket, the log-count ratio already multiplied in
    bias: float
    slope: float
    offset: float

    def margin(self, x: np.ndarray) -> float:
        return float(self.weights[x].sum(dtype=np.float64)) / math.sqrt(max(1, len(x))) + self.bias

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(features(text)) + self.offset
        return 1.0 / (1.0 + math.exp(-z)) if z >= 0 else math.exp(z) / (1.0 + math.exp(z))


def log_count_ratios(xs: list[np.ndarray], ys: np.ndarray) -> np.ndarray:
    share = []
    for label in (1, 0):
        own = [x for x, y in zip(xs, ys) if y == label]
        count = 1.0 + np.bincount(np.concatenate(own), minlength=BUCKETS)
        share.append(count / count.sum())
    return np.log(share[0] / share[1])


def dual_coordinate_descent(xs: list[np.ndarray], vs: list[np.ndarray], ys: np.ndarray, penalty: float = PENALTY,
                            passes: int = PASSES, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model: one dual variable per
    example, 0 to ``penalty``, updated in random order."""
    w, bias, rng = np.zeros(BUCKETS), 0.0, np.random.default_rng(seed)
    alpha = np.zeros(len(xs))
    sign = np.where(ys > 0, 1.0, -1.0)
    norm = [float(v @ v) + 1.0 for v in vs]
    for _ in range(passes):
        for i in rng.permutation(len(xs)):
            slack = sign[i] * (float(w[xs[i]] @ vs[i]) + bias) - 1.0
            new = min(max(alpha[i] - slack / norm[i], 0.0), penalty)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[xs[i]] += step * vs[i]
                bias += step
                alpha[i] = new
    return w, bias


def logistic_curve(margins: np.ndarray, ys: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, with smoothed targets (Newton
    steps, damped)."""
    pos, neg = int((ys == 1).sum()), int((ys == 0).sum())
    t = np.where(ys == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    beta, loss = np.array([1.0, 0.0]), np.inf

    def cost(b):
        z = x @ b
        return float((np.logaddexp(0, z) - t * z).sum())

    loss = cost(beta)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - t))
        size = 1.0
        while size > 1e-6 and cost(beta - size * step) > loss:
            size /= 2
        beta = beta - size * step
        if (new := cost(beta)) > loss - 1e-9:
            break
        loss = new
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def fit(xs: list[np.ndarray], ys: np.ndarray, seed: int = 0) -> Model:
    """Fit on four fifths of the examples, calibrate on the rest."""
    if len(set(ys.tolist())) < 2:
        p = ((ys == 1).sum() + 1) / (len(ys) + 2)
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, float(np.log(p / (1 - p))))
    part = np.random.default_rng(seed).permutation(len(xs)) % 5
    use = [part != 0, part == 0]
    if any(len(set(ys[u].tolist())) < 2 for u in use):
        use = [np.ones(len(xs), bool)] * 2  # too few examples to leave any out
    own = [x for x, u in zip(xs, use[0]) if u]
    ratio = log_count_ratios(own, ys[use[0]])
    w, bias = dual_coordinate_descent(own, [ratio[x] / math.sqrt(max(1, len(x))) for x in own], ys[use[0]], seed=seed)
    model = Model((w * ratio).astype(np.float32), bias, 1.0, 0.0)
    margins = np.array([model.margin(x) for x, u in zip(xs, use[1]) if u])
    model.slope, model.offset = logistic_curve(margins, ys[use[1]])
    return model


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _examples(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """``rank``, ``y``, ``x`` (features) and ``n`` (their number) of the
    ``sample`` labelled ids with the smallest hashes, one text each: that with
    the smallest digest, whatever the order of rows."""
    usable = (labels.filter(~held_out() & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))
    known = usable.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()  # rows of 12 bytes
    ranked = docs.sparkSession.createDataFrame([(r.doc_id, r.y, i) for i, r in enumerate(chosen)], "doc_id long, y int, rank int")
    own = docs.select("doc_id", "text").join(F.broadcast(ranked), "doc_id")
    texts = own.groupBy("rank", "y").agg(F.min(F.struct(F.xxhash64("text"), F.sha2("text", 256), "text"))["text"].alias("text"))

    def run(batches):
        for batch in batches:
            xs = [features(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("rank", "y")]
                + [pa.array([len(x) for x in xs], pa.int32()), pa.array(xs, pa.list_(pa.int32()))], ["rank", "y", "n", "x"])

    return stage(texts.mapInArrow(released(run), "rank int, y int, n int, x array<int>"), "quality-examples")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE,
          sample_features: int = SAMPLE_FEATURES) -> Model:
    """Fit from ``doc_id``, ``text`` and the labels of ids that are not held
    out: the first examples by hash, at most ``sample`` and together at most
    ``sample_features`` features, reach the driver."""
    examples = _examples(docs, labels, label, sample)
    held, ranks = 0, 0
    for r in examples.select("rank", "n").orderBy("rank").collect():  # at most ``sample`` rows
        held += r.n
        if held > sample_features and ranks:
            break
        ranks = r.rank + 1
    rows = examples.filter(F.col("rank") < ranks).orderBy("rank").select("y", "x").toArrow()
    xs = [x.values.to_numpy() if len(x) else np.empty(0, np.int32) for x in rows.column("x")]
    return fit(xs, rows.column("y").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Replace the text by ``score``; other columns stay."""
    keep = [c for c in docs.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            slices = text_slices(batch.column(batch.schema.get_field_index(text_col)))
            made = pa.array([shared.value.score(t) for _, _, texts in slices for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, made], [*keep, "score"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != text_col)
    return docs.mapInArrow(released(run), f"{kept}score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi, texts in text_slices(batch.column(batch.schema.get_field_index(text_col))):
                yield batch.slice(lo, hi - lo).filter(pa.array([shared.value.score(t) >= threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)


def predicted(threshold: float = THRESHOLD) -> Column:
    return (F.col("score") >= threshold).cast("int")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", predicted().alias("predicted"))
