"""Each stage on its predecessor's rows, against the operators' brute forms."""

from collections import Counter

import corpus_pipeline
import pytest
from conftest import multiset
from test_bpe import expected as bpe_expected
from test_minhash import brute, slow_set
from test_mixing import targets
from test_pii import base

from lakefold.llm import quality
from lakefold.session import stage


def run_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for name, f in corpus_pipeline.STAGES:
        frames.append(stage(f(spark, frames[-1], sf_dir), f"test-{name}"))
    return frames


@pytest.fixture(scope="module", params=["small", "edge"])
def frames(request, spark, small_sf, edge_sf):
    return run_stages(spark, small_sf if request.param == "small" else edge_sf), (small_sf if request.param == "small" else edge_sf)


def test_columns(frames):
    steps, _ = frames
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
        assert [t for _, t in df.dtypes] == [t for _, t in steps[0].dtypes]


def test_quality(spark, frames):
    (docs, kept, *_), sf_dir = frames
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert multiset(kept.collect()) == multiset(r for r in docs.collect() if model.score(r.text) >= 0.3)


def test_near_dedup(frames):
    (_, docs, kept, *_), _ = frames
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    brute(rows, 5)
    out = kept.collect()
    assert multiset(r.doc_id for r in out if slow_set(r.text, 5)) == multiset(brute.groups)
    assert sum(not slow_set(r.text, 5) for r in out) == sum(not slow_set(t, 5) for _, t in rows)
    assert not Counter(map(repr, out)) - Counter(map(repr, docs.collect()))


def test_pii(frames):
    (_, _, docs, out, *_), _ = frames
    assert out.count() == docs.count()
    for r in out.collect():
        assert not base(r.text)
    same = Counter(map(repr, (r for r in docs.collect() if not base(r.text))))
    changed = same - Counter(map(repr, out.collect()))
    assert sum(changed.values()) <= 0.02 * docs.count()  # spans beyond the base rules


def test_mixing(frames):
    (_, _, _, docs, out, _), _ = frames
    size = lambda r: len((r.text or "").encode().split())
    have = Counter()
    for r in docs.collect():
        have[r.source] += size(r)
    want = targets(dict(have))
    taken, largest = Counter(), Counter()
    for r in out.collect():
        taken[r.source] += size(r)
    for r in docs.collect():
        largest[r.source] = max(largest[r.source], size(r))
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in have)
    twice = Counter(map(repr, docs.collect()))
    assert all(n <= 2 * twice[r] for r, n in Counter(map(repr, out.collect())).items())


def test_bpe(frames):
    (*_, docs, out), _ = frames
    assert multiset((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()) == multiset(
        (r.doc_id, *bpe_expected(r.text)) for r in docs.collect())
    assert all(len(r.ids) == r.n_tokens for r in out.collect())


def test_run_and_empty(spark, small_sf, empty_sf):
    assert corpus_pipeline.run(spark, small_sf).count() > 0
    assert corpus_pipeline.run(spark, empty_sf).collect() == []
