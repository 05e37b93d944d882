import random
import zlib

import numpy as np
import public_tokenizers
from conftest import multiset
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lakefold.llm import token_files as tf
from lakefold.llm.queries import QUERIES
from lakefold.session import scratch_path

op4 = QUERIES["op4_token_files"]
LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(got, source):
    order = sorted(source, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [d for d, _ in order]
    want = []
    for d, t in source:
        ids = [*LIB.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert multiset((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == multiset(want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_whole_table(spark, small_sf):
    check(op4(spark, small_sf).collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()])


def test_edges(spark, edge_sf, edge_rows):
    check(op4(spark, edge_sf).collect(), [r[:2] for r in edge_rows])


def test_empty(spark, empty_sf):
    assert op4(spark, empty_sf).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 700), st.integers(0, 2**32 - 1))
def test_pack_round_trip(bits, n, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
    data = tf.pack(ids, bits)
    assert len(data) == -(-n // 64) * 8 * bits
    assert (tf.unpack(data, bits, n) == ids).all()


def test_bits():
    assert [tf.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_random_access_and_small_files(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet").select("doc_id", "text").filter("doc_id < 60 and doc_id <> 24")
    manifest = tf.write_token_files(docs, scratch_path(spark, "t4"), file_ids=5000)
    assert manifest.count() >= 2
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for row in manifest.collect():
        f = tf.TokenFile(row.path)
        whole = f.ids(0, f.n_ids)
        for i, d in enumerate(f.doc_ids):
            assert f.document(i).tolist() == [*LIB.encode(by_id[d] or "", add_special_tokens=False).ids, 0]
        rng = random.Random(1)
        for _ in range(20):
            a, b = sorted((rng.randint(0, f.n_ids), rng.randint(0, f.n_ids)))
            assert (f.ids(a, b) == whole[a:b]).all()
        f.close()
    got = tf.read_documents(manifest, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {d: [*LIB.encode(t or "", add_special_tokens=False).ids, 0] for d, t in by_id.items()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abe.,!' \n\t\r1é漢\xa0\x00\x1c|<>"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    texts = [*texts, *(t + "<|endoftext|>" + t for t in texts)]
    ids, at = tf.encoder(tf.VOCAB).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [LIB.encode(t, add_special_tokens=False).ids for t in texts]
